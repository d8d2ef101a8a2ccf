import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import language_id, nearest, quality, queries, url_filter
from daybook.llm.rows import held_out, read_table
from tests.llm.corpus import bag

LETTERS = {"aa": "abcde", "bb": "fghij", "cc": "éüñkl"}


def speech(rng, lang, words):
    return " ".join(
        "".join(rng.choice(LETTERS[lang]) for _ in range(rng.randrange(2, 7))) for _ in range(words)
    )


def spoken(spark, n=240):
    rng = random.Random(0)
    data = [(i, speech(rng, lang := sorted(LETTERS)[i % 3], rng.randrange(5, 200)), lang) for i in range(n)]
    return spark.createDataFrame(
        [(i, t, lang, "x", 0.1) for i, t, lang in data],
        "doc_id long, text string, lang string, has_letter string, score double",
    )


def brute_phrases(reference, text):
    """Longest matches one after the other, a new one at each piece."""
    total = 0
    for at in range(0, len(text), language_id.PIECE):
        piece, i = text[at : at + language_id.PIECE], 0
        while i < len(piece):
            n = 1
            while i + n < len(piece) and piece[i : i + n + 1] in reference:
                n += 1
            total, i = total + 1, i + n
    return total


def test_phrases_against_brute_force():
    rng = random.Random(1)
    texts = {lang: (speech(rng, lang, 60) + " " + speech(rng, "aa", 5)).encode() for lang in LETTERS}
    model = language_id.build(texts)
    asked = [
        speech(rng, "aa", 90).upper().encode(),
        b"",
        speech(rng, "cc", 20).encode(),
        b"zzz 12 !!",
        bytes(range(256)),
    ]
    ends = np.cumsum([0] + [len(t) for t in asked])
    got = language_id.phrases(model, np.frombuffer(b"".join(asked), np.uint8), ends)
    for k, lang in enumerate(model.languages):
        reference = model.classes[np.frombuffer(texts[lang], np.uint8)].tobytes()
        want = [
            brute_phrases(
                reference, model.classes[np.frombuffer(t, np.uint8)].tobytes() if t else b""
            ) for t in asked
        ]
        assert got[:, k].tolist() == want


def test_language_held_out_and_awkward(spark):
    docs = spoken(spark)
    model = language_id.train(docs.where(~held_out("doc_id")), reference_bytes=4096)
    found = language_id.identify(
        docs, model, keep={"held_out": held_out("doc_id"), "truth": F.col("lang")}
    ).collect()
    tested = [r for r in found if r.held_out]
    assert 20 < len(tested) < 90 and np.mean([r.lang_pred == r.truth for r in tested]) > 0.95
    assert all(0 <= r.score <= 1 for r in found)
    odd = spark.createDataFrame(
        [(1, None), (2, ""), (3, "12 !"), (None, "abc"), (5, "abc " * 50_000), (5, "abc " * 50_000)],
        "doc_id long, text string",
    )
    got = {(r.doc_id, r.lang_pred) for r in language_id.identify(odd, model).collect()}
    assert got == {(1, "und"), (2, "und"), (3, "und"), (None, "aa"), (5, "aa")}
    assert language_id.identify(odd.limit(0), model).collect() == []
    unlearned = language_id.train(docs.where("false"))
    assert {r.lang_pred for r in language_id.identify(odd, unlearned).collect()} == {"und"}


def test_every_language_is_learned(spark):
    rng = random.Random(4)
    vocabulary = {f"l{k:03}": ["".join(rng.choices("abcdefghij", k=7)) for _ in range(12)] for k in range(300)}
    data = [
        (i, " ".join(rng.choices(vocabulary[lang], k=20)), lang)
        for i, lang in enumerate(sorted(vocabulary) * 4)
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = language_id.train(docs.where("doc_id < 900"), total_bytes=300 * 700)
    assert model.languages == tuple(sorted(vocabulary))
    assert len(model.masks) <= 2 * 300 * 701
    found = language_id.identify(docs.where("doc_id >= 900"), model).collect()
    assert np.mean([r.lang_pred == data[r.doc_id][2] for r in found]) > 0.95


def test_excerpts_come_from_all_parts_of_texts(spark):
    head = "licence " * 400
    data = [(i, head + ("abc " if i % 2 else "xyz ") * 4000, "ab"[i % 2]) for i in range(60)]
    model = language_id.train(spark.createDataFrame(data, "doc_id long, text string, lang string"))
    found = language_id.identify(spark.createDataFrame([(1, "abc abc abc"), (2, "xyz xyz")], "doc_id long, text string"), model)
    assert {r.doc_id: r.lang_pred for r in found.collect()} == {1: "b", 2: "a"}
    few = language_id.train(spark.createDataFrame(data, "doc_id long, text string, lang string"), reference_bytes=64)
    assert few.languages == ("a", "b") and len(few.masks) > 2


def test_equal_needs_go_to_the_first_language(spark):
    model = language_id.build({"b": b"abc abc", "a": b"abc abc"})
    found = language_id.identify(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), model).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("a", 0.0)]


def graded(spark, n=400):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        text = speech(rng, "aa" if good else "bb", rng.randrange(20, 200))
        docs.append((i, text, 1.0, 2))
        labels.append((i, int(good), 0))
    labels += [(None, 1, 0), (5, None, 0), (1, 0, 0)] + [(0, 0, 0)] * 3
    return spark.createDataFrame(
        docs, "doc_id long, text string, score double, predicted int"
    ), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_held_out_and_awkward(spark):
    docs, labels = graded(spark)
    model = quality.train(docs, labels.where(~held_out("doc_id")), per_class=200)
    found = quality.score_quality(docs, model).withColumn("held_out", held_out("doc_id")).collect()
    tested = [r for r in found if r.held_out]
    assert np.mean([r.predicted == (r.doc_id % 4 != 0) for r in tested]) > 0.95
    assert all(r.predicted == (r.score >= 0.3) for r in found)
    kept = docs.where(quality.score_column(docs, model) >= 0.3)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(
        r.doc_id for r in found if r.predicted
    )
    odd = spark.createDataFrame(
        [(1, None), (2, ""), (2, ""), (None, "x" * 300_000)], "doc_id long, text string"
    )
    scores = quality.score_quality(odd, model).collect()
    assert len(scores) == 4 and all(0 <= r.score <= 1 for r in scores) and len(
        {r.score for r in scores if r.doc_id}
    ) == 1
    assert quality.score_quality(odd.limit(0), model).collect() == []


@pytest.mark.parametrize("keep", ["false", "quality = 1"])
def test_quality_without_examples(spark, keep):
    docs, labels = graded(spark, 40)
    model = quality.train(docs, labels.where(keep))
    scores = {r.score for r in quality.score_quality(docs, model).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 1


def test_quality_scores_follow_the_share_of_labels():
    rng = random.Random(4)
    good, bad = ([speech(rng, lang, 20).encode() for _ in range(100)] for lang in ("aa", "aa"))
    model = quality.fit(good, bad, odds=9.0)
    assert 0.8 < np.mean([quality.score(model, t) for t in good + bad]) < 0.97


URLS = [
    (1, "http://a.com/x", "a.com", "/x", "com/", "allow"),
    (2, "https://sub.EXAMPLE.com/en/1?q#f", "sub.example.com", "/en/1", "example.com/en/", "block"),
    (3, "https://www.example.com/en/2", "www.example.com", "/en/2", "www.example.com/en/", "allow"),
    (4, "https://x.www.example.com/en/", "x.www.example.com", "/en/", "www.example.com/en/", "allow"),
    (5, "http://b.net/es/1", "b.net", "/es/1", "net/es/", "block"),
    (6, "http://b.net/es", "b.net", "/es", None, None),
    (7, "http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    (8, "b.com/x", "", "", None, None),
    (9, None, "", "", None, None),
    (10, "http://com?x=1", "com", "", None, None),
    (11, "ftp://a.com#z/y", "a.com", "", None, None),
    (12, "http://a.com/\n?x", "a.com", "/\n", "com/", "allow"),
    (13, "x://y://c.net/fr/", "y:", "//c.net/fr/", None, None),
    (14, "", "", "", None, None),
    (15, "http:///p", "", "/p", None, None),
]


def test_url_rules_and_method(spark):
    rng = random.Random(0)
    more = [
        (
            100 + k, f"http://{speech(rng, 'aa', 1)}.{'com' if k % 2 else 'net'}/{'en' if k % 2 else 'es'}/{k}"
        ) for k in range(200)
    ]
    data = [
        (i, u, "h", "p", "r", "v") for i, u, *_ in URLS
    ] + [(i, u, "h", "p", "r", "v") for i, u in more] + [(None, "http://q.org/1", "h", "p", "r", "v")] * 2
    pages = spark.createDataFrame(
        data, "page_id long, url string, host string, path string, rule string, verdict string"
    )
    found = url_filter.judge(pages, trees=3, depth=2).collect()
    assert len(found) == len(data)
    by_id = {r.page_id: r for r in found if r.page_id}
    for i, _, host, path, rule, verdict in URLS:
        r = by_id[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), i
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert all(0 <= r.block_score <= 1 for r in found)
    assert len({(r.verdict, r.block_score) for r in found if r.page_id is None}) == 1
    assert by_id[6].verdict == "block" and by_id[11].verdict == "allow"  # the trees learned the suffix


def test_url_verdicts_on_urls_never_seen(spark):
    """Trees judge what rules judge, without the rules, and do not say the same of everything else."""
    rng = random.Random(3)
    data = []
    for k in range(3000):
        host = f"{speech(rng, 'aa', 1)}.example.{rng.choice(('com', 'com', 'net', 'org'))}"
        data.append((k, f"http://{host}/{rng.choice(('en', 'es', 'fr', 'de'))}/{k}"))
    data += [(3000 + k, data[5][1]) for k in range(1500)]  # one URL is a third of all rows
    pages = spark.createDataFrame(data, "page_id long, url string").repartition(3)
    found = url_filter.held_out_accuracy(pages, trees=5, depth=3)
    assert set(found) == {"allow", "block"} and sum(found.values()) / 2 >= 0.8
    rows = url_filter.judge(pages, trees=5, depth=3).collect()
    assert len(rows) == len(data) and {r.verdict for r in rows if r.rule is None} == {"allow", "block"}


def test_url_features(spark):
    host, path = url_filter.parse(F.col("url"))
    rows = spark.createDataFrame(
        [("http://a-b.c.com/x/1?u=1&v=2#f",), ("",)], "url string"
    ).withColumn("host", host).withColumn("path", path)
    first, empty = url_filter.lexical(rows).collect()
    text = "http://a-b.c.com/x/1?u=1&v=2#f"
    counts = [text.count(c) / len(text) for c in set(text)]
    assert first.entropy == pytest.approx(-sum(p * math.log2(p) for p in counts))
    assert (
        first.url_length,
        first.host_depth,
        first.path_depth,
        first.parameters,
        first.hyphens,
        first.has_fragment,
    ) == (30, 3, 2, 2, 1, 1)
    assert first.digit_ratio == pytest.approx(3 / 30) and empty.entropy == 0 and empty.url_length == 0


@pytest.mark.parametrize(
    "urls,verdict", [(["http://a.org/"], "allow"), (["http://a.net/es/", "http://a.org"], "block"), ([], None)]
)
def test_urls_without_both_verdicts(spark, urls, verdict):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert {r.verdict for r in url_filter.judge(pages).collect()} == ({verdict} if verdict else set())


def brute_nearest(vectors, query, k):
    q = np.array(vectors[query], np.float64)
    return sorted(
        (
            float(np.sqrt(((np.array(v, np.float64) - q) ** 2).sum())), i
        ) for i, v in vectors.items() if i != query
    )[:k]


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(0)
    centers = rng.standard_normal((20, 24))
    vectors = {
        i: (centers[i % 20] + 0.4 * rng.standard_normal(24)).astype(np.float32).tolist() for i in range(1500)
    }
    for i in range(0, 600, 2):
        vectors[i] = vectors[0]  # a vector that many share
    odd = [
        (2000, None),
        (2001, [0.0] * 24),
        (2002, [float("nan")] * 24),
        (2003, [None] + [1.0] * 23),
        (2004, [float("inf")] * 24),
        (2005, [1.0]),
        (2006, []),
        (None, vectors[5]),
        (7, vectors[7]),
    ]
    table_ = spark.createDataFrame(
        [(i, v, 1, 2) for i, v in [*vectors.items(), *odd]],
        "vec_id long, embedding array<float>, list int, rank int",
    )
    found = nearest.search(
        table_, F.col("vec_id") % 50 == 0, k=10, lists=16, recall=0.95, block_rows=100, block_queries=8
    ).collect()
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(by_query) == set(range(0, 1500, 50))
    hits = total = 0
    for query, rows in by_query.items():
        rows.sort()
        assert [r for r, _, _ in rows] == list(range(1, 11))
        want = brute_nearest(vectors, query, 10)
        assert all(
            s == pytest.approx(
                float(np.sqrt(((np.array(vectors[i]) - np.array(vectors[query])) ** 2).sum())), abs=1e-12
            ) for _, i, s in rows
        )
        hits += len({i for _, i, _ in rows} & {i for _, i in want})
        total += 10
        if query < 600:  # equal distances go to the smaller ids
            assert [i for _, i, _ in rows] == [i for _, i in want]
    assert hits / total >= 0.9


def test_nearest_few_rows(spark):
    schema = "vec_id long, embedding array<double>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.5])], schema)
    assert bag(
        (r.query_id, r.rank, r.vec_id) for r in nearest.search(few, F.col("vec_id") == 0).collect()
    ) == bag([(0, 1, 2), (0, 2, 1)])
    assert nearest.search(few.limit(0), F.lit(True)).collect() == []
    assert nearest.search(few.where("vec_id = 0"), F.lit(True)).collect() == []
    assert nearest.search(few, F.lit(False)).collect() == []


def test_scan_abandons_little_that_counts():
    rng = np.random.default_rng(1)
    data = rng.standard_normal((5000, 64))
    turn = nearest.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    turned = data @ turn
    columns = [np.ascontiguousarray(turned[:, c : c + nearest.COLUMNS]) for c in range(0, 64, nearest.COLUMNS)]
    hits = 0
    for _ in range(20):
        q = rng.standard_normal(64)
        ids, score = nearest.scan(q, q @ turn, data, columns, np.arange(5000), 10)
        want = np.sort(np.sqrt(((data - q) ** 2).sum(1)))[:10]
        hits += np.isclose(score[:, None], want[None]).any(1).sum()
    assert hits >= 0.97 * 200


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_recall_on_the_test_table(spark):
    found = queries.op10_nearest(spark, "/root/testdata/sf0.1").collect()
    rows = read_table(spark, "/root/testdata/sf0.1", "embeddings").select("vec_id", "embedding").collect()
    vectors = {r.vec_id: list(r.embedding) for r in rows}
    got = {}
    for r in found:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    asked = [i for i in vectors if i % 100 == 0]
    assert set(got) == set(asked)
    hits = sum(len(got[q] & {i for _, i in brute_nearest(vectors, q, 10)}) for q in asked)
    assert hits >= 0.9 * 10 * len(asked)

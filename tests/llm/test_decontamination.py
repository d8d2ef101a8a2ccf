import random
import re

import numpy as np
import pytest
import regex

from daybook.llm import decontamination as d
from tests.llm.corpus import VOCABULARY, bag, rows, sentence, table


def brute_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    alone = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}]"
    letter = r"[\p{L}\p{M}\p{N}]"
    return regex.findall(rf"(?=[\p{{L}}\p{{M}}\p{{N}}]){alone}|(?:(?!{alone}){letter})+", lowered)


def brute_distance(item, text):
    """Least number of word edits from the item to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, word in enumerate(item, 1):
        last, row = row, [i]
        for j, other in enumerate(text, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (word != other)))
    return min(row)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        k = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[k] = "zz%d" % rng.randrange(1000)
        elif kind == 1:
            del words[k]
        else:
            words.insert(k, "yy%d" % rng.randrange(1000))
    return words


def planted():
    rng = random.Random(11)
    items = [(i, sentence(rng, rng.randrange(12, 60))) for i in range(25)] + [
        (90, None), (None, "a b c d e f g"), (91, "one two"), (92, "")
    ]
    docs = rows(12, 20)
    for k in range(200):
        item, text = items[rng.randrange(25)]
        words = text.split()
        edits = rng.randrange(0, int(len(words) * 0.2) + 1)
        own = " ".join(edited(rng, words, edits))
        docs.append(
            (
                1000 + k,
                f"{sentence(rng, 40)}. {own.upper() if k % 5 == 0 else own}.&&& {
                    sentence(rng, rng.randrange(0, 30))
                }",
            )
        )
    return docs, items


def test_recall_and_precision_against_brute_force(spark):
    docs, items = planted()
    bench = spark.createDataFrame([(i, t, 1.0) for i, t in items], "item_id long, text string, distance double")
    found = d.contaminated(table(spark, docs), bench, block=10).collect()
    got = {(r.doc_id, r.item_id): r.distance for r in found}
    want = {}
    for i, t in items:
        item = brute_words(t)
        if i is None or not item:
            continue
        for doc, text in docs:
            distance = brute_distance(item, brute_words(text))
            if distance <= int(len(item) * 0.2 + 1e-9):
                want[doc, i] = distance
    assert set(got) <= set(want)  # nothing that the exact check refuses
    assert len(want) > 150 and len(got) >= 0.95 * len(want)
    assert all(want[k] <= v for k, v in got.items())
    assert np.mean([want[k] == v for k, v in got.items()]) > 0.95
    assert {k for k, v in want.items() if v == 0} <= set(got)  # an exact passage is always found
    for r in found:
        words = brute_words(dict(docs)[r.doc_id])[r.first_word : r.first_word + r.n_words]
        assert brute_distance(brute_words(dict(items)[r.item_id]), words) <= r.distance


def test_clean_documents_keep_all_columns(spark):
    docs, items = planted()
    frame = table(spark, docs)
    bench = spark.createDataFrame(items, "item_id long, text string")
    dirty = {r.doc_id for r in d.contaminated(frame, bench).collect()}
    clean = d.clean_documents(frame, bench)
    assert clean.columns == frame.columns
    assert bag(r.doc_id for r in clean.collect()) == bag(i for i, _ in docs if i not in dirty)


def test_awkward_rows(spark):
    item = " ".join(VOCABULARY[:20])
    docs = [
        (1, item), (1, item), (None, item), (2, None), (3, ""), (4, " ".join([item] * 400)), (5, "word " * 3000)
    ]
    bench = spark.createDataFrame([(7, item), (7, item)], "item_id long, text string")
    found = d.contaminated(table(spark, docs), bench).collect()
    assert bag(
        (r.doc_id, r.item_id, r.distance) for r in found
    ) == bag([(1, 7, 0), (1, 7, 0), (None, 7, 0), (4, 7, 0)])
    assert d.contaminated(table(spark, []), bench).collect() == []
    assert d.contaminated(table(spark, docs), bench.limit(0)).collect() == []
    assert d.clean_documents(table(spark, docs), bench.limit(0)).count() == len(docs)


@pytest.mark.parametrize("edits,least", [(1, 0.99), (3, 0.97), (7, 0.9)])
def test_recall_of_the_tables(edits, least):
    """Share of edited items of 38 words that meet their item in some table."""
    rng = random.Random(edits)
    met = 0
    for _ in range(150):
        item = sentence(rng, 38)
        index, pairs = d.build([(1, item)])
        text = " ".join(edited(rng, item.split(), edits) + ["end"] * 10).encode()
        met += bool(d.find(index, pairs, np.frombuffer(text, np.uint8), np.array([0, len(text)])))
    assert met >= least * 150


@pytest.mark.parametrize("size", [15, 40, 100, 200])
def test_recall_at_the_full_allowance(size):
    """Of items edited as often as allowed, nearly all are found, whatever their length."""
    rng = random.Random(size)
    n, met = 100, 0
    for _ in range(n):
        item = [f"w{rng.randrange(10**9)}" for _ in range(size)]
        index, pairs = d.build([(1, " ".join(item))])
        around = [f"v{rng.randrange(10**9)}" for _ in range(2 * size)]
        text = " ".join(around[:size] + edited(rng, item, size // 5) + around[size:]).encode()
        met += bool(d.find(index, pairs, np.frombuffer(text, np.uint8), np.array([0, len(text)])))
    assert met >= 0.97 * n


def test_items_that_no_walks_suffice_for_are_compared(monkeypatch):
    """Where the walks do not reach the recall, every window with enough pairs is compared with every item."""
    monkeypatch.setattr(d, "MOST_WALKS", 0)
    d.walks_needed.cache_clear()
    rng = random.Random(3)
    items = [[f"w{rng.randrange(10**9)}" for _ in range(100)] for _ in range(3)]
    index, pairs = d.build([(k, " ".join(item)) for k, item in enumerate(items)])
    d.walks_needed.cache_clear()
    assert [g.walks for g in index] == [0]
    for k, item in enumerate(items):
        text = " ".join(["a", "b", *edited(rng, item, 20), "c"]).encode()
        found = d.find(index, pairs, np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert [(i, distance <= 20) for _, i, distance, *_ in found] == [(k, True)]


def answers(items, texts, **options):
    index, pairs = d.build(items, **options)
    data = "".join(texts).encode()
    ends = np.cumsum([0] + [len(t.encode()) for t in texts])
    return d.find(index, pairs, np.frombuffer(data, np.uint8), ends)


ODD_TEXTS = [
    "caf\u00e9 na\u00efve \u2018quoted\u2019\u2014dashed\u00a0space \u4e2d\u6587\u5b57a\u4e2d1",
    "\u0e44\u0e17\u0e22 \u3072\u3089\u30ab\u30bf\ud55c\uad6d\uc5b4 \U0001f600x\U00020000y e\u0301t\u00e9",
    "", "\u00a0", "\u4e2d", "x", "\U00020000", "A\u2028b\u0085c \u0130Z",
]


def test_words_of_any_script_by_brute_force():
    data = "".join(ODD_TEXTS).encode()
    ends = np.cumsum([0] + [len(t.encode()) for t in ODD_TEXTS])
    raw = np.frombuffer(data, np.uint8)
    start, end = d._word_bounds(raw, ends)
    got = [data[a:b].decode() for a, b in zip(start.tolist(), end.tolist())]
    want = [brute_words(t) for t in ODD_TEXTS]
    assert [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in got] == [w for text in want for w in text]
    _, first = d.tokenize(raw, ends)
    assert np.diff(first).tolist() == [len(w) for w in want]


def test_items_in_scripts_without_spaces_and_with_other_punctuation():
    rng = random.Random(5)
    chinese = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(47))
    other = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(400))
    plain = sentence(rng, 30)
    fancy = "\u201c" + plain.replace(" ", "\u00a0") + "\u201d\u2014"
    edited_copy = chinese[:10] + "\u4e00" + chinese[11:30] + chinese[31:]
    found = answers(
        [(1, chinese), (2, plain)],
        [other[:100] + chinese + other[100:], other, fancy, other[:50] + "\u3002" + edited_copy + other[50:]],
    )
    assert [(t, i) for t, i, *_ in found] == [(0, 1), (2, 2), (3, 1)]
    assert [x[2] for x in found][:2] == [0, 0] and found[2][2] <= 2
    assert found[0][3:] == (100, 47, 47)


@pytest.mark.parametrize("size", [1, 2, 3, 4])
def test_short_items_are_looked_up(size):
    words_ = [f"w{k}" for k in range(size)]
    item = " ".join(words_)
    changed = " ".join(words_[:-1] + ["other"])
    texts = [f"a {item} b", item.upper(), changed, "", " ".join(words_[:-1]), f"{item} {item}"]
    found = answers([(3, item)], texts)
    assert [(t, i, n, at) for t, i, n, at, *_ in found] == [(0, 3, 0, 1), (1, 3, 0, 0), (5, 3, 0, 0)]
    assert answers([(3, item)], texts, min_words=size + 1) == []
    assert answers([(3, item)], texts, min_words=size) == found


@pytest.mark.parametrize("size,n", [(61, 60), (600, 20), (1000, 12)])
def test_long_items_are_found_by_their_parts(size, n):
    """Edited as often as allowed, whether the edits are spread or lie together."""
    rng = random.Random(size)
    items = [[f"w{rng.randrange(10**9)}" for _ in range(size)] for _ in range(n)]
    index, pairs = d.build([(k, " ".join(item)) for k, item in enumerate(items)])
    assert all(g.walks and g.size <= d.PART_WORDS for g in index)
    met, texts = 0, []
    for k, item in enumerate(items):
        around = [f"v{rng.randrange(10**9)}" for _ in range(300)]
        if k % 3:
            own = edited(rng, item, size // 5)
        else:
            own = [f"x{j}" for j in range(size // 5)] + item[size // 5 :]
        texts.append(" ".join(around[:150] + own + around[150:]) + " ")
    found = answers([(k, " ".join(item)) for k, item in enumerate(items)], texts)
    assert all(t == i and distance <= size // 5 for t, i, distance, *_ in found)
    assert len(found) >= 0.98 * n
    for t, i, distance, at, count, _ in found[:3]:
        words_ = brute_words(texts[t])
        assert brute_distance(brute_words(" ".join(items[i])), words_) == distance
        assert brute_distance(brute_words(" ".join(items[i])), words_[at : at + count]) == distance


def test_best_match_by_brute_force():
    rng = random.Random(8)
    for _ in range(300):
        item = np.array([rng.randrange(4) for _ in range(rng.randrange(1, 8))], np.uint64)
        text = np.array([rng.randrange(4) for _ in range(rng.randrange(0, 14))], np.uint64)
        distance, start, n = d.best_match(item, text)
        assert distance == brute_distance(item.tolist(), text.tolist())
        part = text[start : start + n].tolist()
        row = list(range(len(part) + 1))
        for a, word in enumerate(item.tolist(), 1):
            last, row = row, [a]
            for b, other in enumerate(part, 1):
                row.append(min(last[b] + 1, row[b - 1] + 1, last[b - 1] + (word != other)))
        assert row[-1] == distance

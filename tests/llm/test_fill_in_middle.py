import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from daybook.llm import fill_in_middle as fim
from tests.llm.corpus import bag, rows, table

UNITS = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
ODD = [
    (600, "holds <P> a sign"), (601, "<S>"), (602, "tail <M>"), (603, "<P <S <M> <"), (604, "a<"), (605, "P> <"),
    (606, " x \u0085 y z"), (607, "😀 😀\t\x0b\x0c\r"), (608, " lead"), (609, "\n\n"), (610, "one"),
]


def by_hand(doc_id, text, percent=50, spm_percent=80, seed=42):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return doc_id, len(units), "plain", None, None, text, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, None)))
    form = "spm" if h[3] % 100 < spm_percent else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(units), form, len(p), len(m), out, text


def found(spark, pairs, **how):
    df = fim.fill_in_middle(table(spark, pairs), **how)
    back = fim.restored(fim.F.col("output"), fim.F.col("form")).alias("text")
    return df.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", back).collect()


def test_against_brute_force(spark):
    pairs = rows(11, n=200) + ODD
    assert bag(map(tuple, found(spark, pairs))) == bag(by_hand(*p) for p in pairs)


def test_other_shares_and_seeds(spark):
    pairs = rows(12) + ODD
    for how in ({"percent": 100, "spm_percent": 0}, {"percent": 100, "spm_percent": 100, "seed": 7}, {"percent": 0}):
        assert bag(map(tuple, found(spark, pairs, **how))) == bag(by_hand(*p, **how) for p in pairs)


def test_very_long_texts_and_no_rows(spark):
    long = [(1, "wörd  漢字\n" * 600_000), (2, "x" * 5_000_000), (3, " " * 3_000_000), (4, "a b"), (5, None)]
    assert bag(map(tuple, found(spark, long, percent=100))) == bag(by_hand(*p, percent=100) for p in long)
    assert found(spark, []) == []


@settings(max_examples=500, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.text(st.sampled_from("ab é漢😀\t\n\x0b\r\x1c\x85 ") | st.characters(codec="utf-8"), max_size=40),
            st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1),
        ),
        max_size=6,
    )
)
def test_cuts_of_many_texts_at_once(drawn):
    raw = [t.encode() for t, _, _ in drawn]
    ends = np.cumsum([0] + [len(x) for x in raw])
    first, second = (np.array([d[k] for d in drawn], np.int64) for k in (1, 2))
    got = fim.cuts(np.frombuffer(b"".join(raw), np.uint8), ends, first, second)
    for i, (text, h1, h2) in enumerate(drawn):
        units = UNITS.findall(text)
        a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        prefix, middle = "".join(units[:a]), "".join(units[a:b])
        cut = len(prefix.encode())
        want = len(units), len(prefix), len(middle), ends[i] + cut, ends[i] + cut + len(middle.encode())
        assert tuple(x[i] for x in got) == want


def test_select_finds_what_rank_counts():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 2**63, 400, dtype=np.uint64) & fim.HIGH
    marks = fim.Marks(words)
    at = np.flatnonzero(words.view(np.uint8))
    assert (marks.select(np.arange(len(at))) == at).all()
    assert (marks.rank(at) == np.arange(len(at))).all()

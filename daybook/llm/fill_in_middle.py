"""Fill-in-middle: the middle of a text moves behind its beginning and its end.

A text is cut between units, a word with the white space before it. Units are
found on the UTF-8 bytes of many texts at once, seen as 64-bit words: arithmetic
on a word marks the bytes that end a unit, `bitwise_count` counts the marks, the
running count is searched for the word that holds the k-th mark, and the place
within the word comes from prefix sums of its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import id_and_text, text_blocks

ONES = np.uint64(0x0101010101010101)
HIGH = np.uint64(0x8080808080808080)
LOW = ~HIGH
#: Signs that open the prefix, the suffix and the middle. None begins within another.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
DDL = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
    "prefix_bytes long, middle_bytes long, output string"
)
SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("form", pa.string()),
        ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()),
        ("prefix_bytes", pa.int64()),
        ("middle_bytes", pa.int64()),
        ("output", pa.string()),
    ]
)


def as_words(data: np.ndarray) -> np.ndarray:
    """The bytes as little-endian 64-bit words, filled up with zeros."""
    padded = np.zeros(len(data) // 8 * 8 + 8, np.uint8)
    padded[: len(data)] = data
    return padded.view("<u8")


def spaces(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is a blank or one of the bytes 9 to 13."""
    other = words ^ (ONES * np.uint64(0x20))
    blank = ~(((other & LOW) + LOW) | other) & HIGH  # the high bit of a byte that is zero; no carry leaves a byte
    seven = words & LOW
    from_9, from_14 = seven + ONES * np.uint64(0x80 - 9), seven + ONES * np.uint64(0x80 - 14)
    return blank | (from_9 & ~from_14 & ~words & HIGH)


def unit_ends(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The high bit of each byte that ends a unit; texts lie between the offsets `ends`.

    That is a byte of a word before white space, and the last byte of a text.
    """
    space = spaces(words)
    following = space >> np.uint64(8)
    following[:-1] |= space[1:] << np.uint64(56)
    marks = ~space & HIGH & following
    last = ends[1:][np.diff(ends) > 0] - 1
    np.bitwise_or.at(marks, last >> 3, np.uint64(0x80) << (np.uint64(8) * (last & 7).astype(np.uint64)))
    return marks


def first_bytes(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that begins a code point."""
    return HIGH & ~(words & ~(words << np.uint64(1)))


class Marks:
    """Rank and select over bytes that carry a mark in their high bit."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks before each byte offset."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        below = (np.uint64(1) << (np.uint64(8) * byte)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte offset of each k-th mark, from 0."""
        word = np.searchsorted(self.before, k, side="right") - 1
        wanted = (k - self.before[word] + 1).astype(np.uint64)
        up_to = ((self.words[word] >> np.uint64(7)) & ONES) * ONES  # byte i holds the marks in bytes 0 to i
        reached = ((up_to | HIGH) - wanted * ONES) & HIGH
        return 8 * word + 8 - np.bitwise_count(reached)


def cuts(data: np.ndarray, ends: np.ndarray, first: np.ndarray, second: np.ndarray):
    """(units, code points of prefix and middle, byte offsets of both cuts) of each text.

    `first` and `second` are any whole numbers; modulo the units and one more they say after how many units to cut.
    """
    words = as_words(data)
    units, points = Marks(unit_ends(words, ends)), Marks(first_bytes(words))
    begin = units.rank(ends[:-1])
    n = units.rank(ends[1:]) - begin
    a, b = first % (n + 1), second % (n + 1)
    places = []
    for k in (np.minimum(a, b), np.maximum(a, b)):
        at = ends[:-1].copy()
        some = k > 0
        at[some] = units.select((begin + k - 1)[some]) + 1
        places.append(at)
    ranks = [points.rank(x) for x in (ends[:-1], *places)]
    return n, ranks[1] - ranks[0], ranks[2] - ranks[1], *places


def _transform(percent: int, spm_percent: int):
    signs = tuple(s.encode() for s in (PREFIX, SUFFIX, MIDDLE))
    p, s, m = signs

    def run(batches):
        for rows, data, ends in text_blocks(batches):
            h = [rows.column(f"h{k}").to_numpy() for k in range(1, 5)]
            n, prefix, middle, low, high = cuts(data, ends, h[0], h[1])
            raw = data.tobytes()
            out, form = [], []
            for a, x, y, b, third, fourth in zip(
                ends.tolist(), low.tolist(), high.tolist(), ends[1:].tolist(), h[2].tolist(), h[3].tolist()
            ):
                if a == b or third % 100 >= percent or any(raw.find(sign, a, b) >= 0 for sign in signs):
                    form.append("plain")
                    out.append(raw[a:b])
                elif fourth % 100 < spm_percent:
                    form.append("spm")
                    out.append(b"".join((s, raw[y:b], p, raw[a:x], m, raw[x:y])))
                else:
                    form.append("psm")
                    out.append(b"".join((p, raw[a:x], s, raw[y:b], m, raw[x:y])))
            kind = pa.array(form, pa.string())
            plain = np.array([f == "plain" for f in form], bool)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array(n),
                    kind,
                    *(pa.array(x, mask=plain) for x in (prefix, middle, low - ends[:-1], high - low)),
                    pa.array(out, pa.binary()).view(pa.string()),
                ],
                schema=SCHEMA,
            )

    return run


def fill_in_middle(
    docs: DataFrame,
    percent: int = 50,
    spm_percent: int = 80,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`doc_id, n, form, prefix_chars, middle_chars, prefix_bytes, middle_bytes, output` per row: a narrow pass.

    `percent` of the texts are rearranged, `spm_percent` of those with the suffix
    first (form `spm`), the others with the prefix first (`psm`); the rest stay
    (`plain`), and so do texts that hold one of the three signs. Where a text is
    cut depends on `seed` and its id alone, so repeated ids are cut alike.

    A null text is empty: no units, plain. A text of white space is one unit. A
    null id stays null and draws as an empty id would. Lengths are null in plain
    rows. Repeated rows are answered each, no rows give no rows, other columns
    are ignored. A text needs about four times its size in memory.
    """
    drawn = F.sha2(
        F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256
    )
    texts = id_and_text(docs, id_col, text_col)
    hashed = texts.withColumns(
        {f"h{k + 1}": F.conv(F.substring(drawn, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)}
    )
    return hashed.mapInArrow(_transform(percent, spm_percent), DDL)


def restored(output: Column, form: Column) -> Column:
    """The text that was rearranged. Each sign occurs once in an output that is not plain."""

    def before(text: Column, sign: str) -> Column:
        return F.substring_index(text, sign, 1)

    def after(text: Column, sign: str) -> Column:
        return F.substring_index(text, sign, -1)

    in_psm, in_spm = after(output, PREFIX), after(output, SUFFIX)
    psm = F.concat(
        before(in_psm, SUFFIX), after(output, MIDDLE), before(after(output, SUFFIX), MIDDLE)
    )
    spm = F.concat(before(after(output, PREFIX), MIDDLE), after(output, MIDDLE), before(in_spm, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)

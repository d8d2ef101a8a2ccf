"""Repeated passages of words, found with a compressed FM-index per shard.

A shard holds the stretches of text whose anchors fell to it (see `repeats`).
Its words are numbered, its suffixes sorted, and the last column of the sorted
rotations is kept in a wavelet matrix of packed bits. Stretches are then
streamed through the index: backward search extends a match word by word while
what it matches occurs at least twice, and windows that a match covers repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.repeats import Rule, without_repeats
from daybook.llm.rows import id_and_text
from daybook.llm.units import U

GRAM = 8


def sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of suffixes in order of their first `depth` symbols, by doubling."""
    rank, width = text.astype(np.int64), 1
    while True:
        key = rank * (int(rank.max(initial=0)) + 2)
        key[:-width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        if 2 * width >= depth:
            return order
        ranked = key[order]
        rank = np.empty(len(text), np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]]))
        if rank[order[-1]] == len(text) - 1:
            return order
        width *= 2


class WaveletMatrix:
    """How often a symbol occurs before a place, from packed bits: one level per bit of a symbol."""

    def __init__(self, symbols: np.ndarray):
        self.levels = max(1, int(symbols.max(initial=0)).bit_length())
        words_ = len(symbols) // 64 + 1
        self.bits = np.zeros((self.levels, words_), U)
        self.before = np.zeros((self.levels, words_), np.int64)
        self.zeros = np.zeros(self.levels, np.int64)
        now = symbols
        for level in range(self.levels):
            bit = (now >> (self.levels - 1 - level)) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            self.bits[level].view(np.uint8)[: len(packed)] = packed
            self.before[level, 1:] = np.cumsum(np.bitwise_count(self.bits[level]))[:-1]
            self.zeros[level] = len(now) - int(bit.sum())
            now = np.concatenate([now[bit == 0], now[bit == 1]])

    def descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where the place falls after sorting by all bits of the symbol."""
        for level in range(self.levels):
            word = place >> 6
            mask = (U(1) << (place & 63).astype(U)) - U(1)
            ones = self.before[level][word] + np.bitwise_count(self.bits[level][word] & mask)
            bit = (symbol >> (self.levels - 1 - level)) & 1
            place = np.where(bit == 1, self.zeros[level] + ones, place - ones)
        return place


class FMIndex:
    """Occurrences of word sequences in a text of numbers from 1; 0 parts the texts."""

    def __init__(self, text: np.ndarray, depth: int, weight: np.ndarray | None = None):
        order = sorted_suffixes(text, depth)
        last = text[order - 1]
        self.matrix = WaveletMatrix(last)
        self.size = len(text)
        symbols = int(text.max(initial=0)) + 1
        counts = np.bincount(text, minlength=symbols)
        self.first = np.cumsum(counts) - counts
        self.base = self.matrix.descend(np.arange(symbols), np.zeros(symbols, np.int64))
        self.weight = np.concatenate(
            [[0], np.cumsum((np.ones(len(text), np.int64) if weight is None else weight)[order])]
        )

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of `symbol` followed by what the rows from `low` to `high` begin with."""
        both = self.matrix.descend(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        shift = self.first[symbol] - self.base[symbol]
        return both[: len(low)] + shift, both[len(low) :] + shift

    def occurrences(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return self.weight[high] - self.weight[low]


def repeated_windows(
    index: FMIndex, text: np.ndarray, start: np.ndarray, size: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, first window, windows) that occur at least twice; stretches are text[start : start + size].

    All stretches advance together. Each holds a range of windows not yet
    decided. A match is grown backwards from the end of the last one; if it
    covers the range, all repeat. Otherwise what it covers repeats, and the
    first window is tried: the place where its match breaks off rules out every
    window that holds the broken part.
    """
    n = len(start)
    low_window, high_window = np.zeros(n, np.int64), size - window
    from_right = np.ones(n, bool)
    live = np.flatnonzero(high_window >= 0)
    end = np.zeros(n, np.int64)
    at = np.zeros(n, np.int64)
    low, high = np.zeros(n, np.int64), np.full(n, index.size)
    found = []

    def begin(k):
        end[k] = np.where(from_right[k], high_window[k], low_window[k]) + window - 1
        at[k] = end[k]
        low[k], high[k] = 0, index.size

    begin(live)
    while len(live):
        lo, hi = index.extend(text[start[live] + at[live]], low[live], high[live])
        broken, is_right = index.occurrences(lo, hi) < 2, from_right[live]
        low[live], high[live] = lo, hi
        done = ~broken & (at[live] <= low_window[live])  # the match reaches the first open window
        on = live[~broken & ~done]
        at[on] -= 1
        # the whole range, or just the first window, repeats
        whole = live[done & is_right]
        found.append((whole, low_window[whole], high_window[whole] - low_window[whole] + 1))
        low_window[whole] = high_window[whole] + 1
        one = live[done & ~is_right]
        found.append((one, low_window[one], np.ones(len(one), np.int64)))
        low_window[one] += 1
        from_right[one] = True
        # broken off at `at`
        right = live[broken & is_right]
        some = right[at[right] < high_window[right]]
        found.append((some, at[some] + 1, high_window[some] - at[some]))
        high_window[right] = np.minimum(at[right], high_window[right] - 1)
        from_right[right] = False
        left = live[broken & ~is_right]
        low_window[left] = at[left] + 1
        fresh = np.concatenate([one, right, left])
        fresh = fresh[low_window[fresh] <= high_window[fresh]]
        begin(fresh)
        live = np.concatenate([on, fresh])
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def shard_of(window: int):
    """Index of a shard and the windows of its own stretches that repeat."""

    def shard(data: np.ndarray, ends: np.ndarray, ids: np.ndarray, weights: np.ndarray):
        raw = data.tobytes()
        numbers: dict[bytes, int] = {}
        pieces, size = [], np.zeros(len(ends) - 1, np.int64)
        for k, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            own = raw[a:b].split()
            size[k] = len(own)
            pieces.append([numbers.setdefault(w, len(numbers) + 1) for w in own])
        start = np.cumsum(size + 1) - size - 1
        text = np.zeros(int((size + 1).sum()), np.int64)
        mine = np.repeat(np.arange(len(size)), size)
        text[np.arange(len(mine)) + mine] = np.fromiter((x for p in pieces for x in p), np.int64, len(mine))
        weight = np.repeat(weights.astype(np.int64), size + 1)
        index = FMIndex(text, int(size.max(initial=1)) + 1, weight)
        return repeated_windows(index, text, start, size, window)

    return shard


def _runs(start: np.ndarray, length: np.ndarray, first: np.ndarray) -> pa.Array:
    """Runs of units as one list of (start, length) per text, starts counted within the text."""
    cuts = np.searchsorted(start, first)
    cuts[-1] = len(start)
    of = np.searchsorted(first, start, side="right") - 1
    values = pa.StructArray.from_arrays(
        [pa.array(start - first[of]), pa.array(length)], names=["start", "length"]
    )
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), values)


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
SPANS_DDL = "array<struct<start: bigint, length: bigint>>"


def _kept_texts(data, ends, start, end, first, a, b) -> list[bytes]:
    """Texts without the words a to b of each run, cut from the first removed word to the next kept one."""
    raw, out, k = data.tobytes(), [], 0
    for t in range(len(ends) - 1):
        at, parts = int(ends[t]), []
        while k < len(a) and a[k] < first[t + 1]:
            low, high = int(a[k]), int(b[k])
            last = high == first[t + 1]
            # at the end of a text, the white space before the run goes with it
            parts.append(raw[at : int(end[low - 1]) if last and low > first[t] else int(start[low])])
            at = int(ends[t + 1]) if last else int(start[high])
            k += 1
        parts.append(raw[at : int(ends[t + 1])])
        out.append(b"".join(parts))
    return out


def remove_repeats(
    docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id, n_words, removed, kept` per row of `docs`.

    A word (a run of bytes other than ASCII white space) is removed if it lies
    in a run of `window` words that also starts anywhere else, in the same text
    too. `removed` lists the removed runs by first word and number of words,
    `kept` is the text without them; a text without removals stays as it is.

    A null or empty text has no words and is empty. Repeated rows are texts of
    their own and so repeat each other. A null id stays null; no rows give no
    rows; other columns are ignored. All occurrences count, in whole texts.
    """
    texts = id_and_text(docs, id_col, text_col)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("removed", SPANS), ("kept", pa.string())]
    )

    def finish(rows, data, ends, start, end, first, a, b):
        return pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id"),
                pa.array(np.diff(first)),
                _runs(a, b - a, first),
                pa.array(_kept_texts(data, ends, start, end, first, a, b), pa.binary()).cast(pa.string()),
            ],
            names=schema.names,
        )

    return without_repeats(
        texts, Rule("word", window, min(GRAM, _power(window)), False), shard_of(window), finish,
        f"doc_id long, n_words long, removed {SPANS_DDL}, kept string", schema, "doc_id", "text",
    )


def cut_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of `docs`, the text column without repeated passages; a null text stays null if nothing else holds it."""
    from pyspark.sql.pandas.types import to_arrow_schema

    texts = docs.withColumn(text_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    plain = pa.schema([pa.field(f.name, f.type) for f in to_arrow_schema(texts.schema)])

    def finish(rows, data, ends, start, end, first, a, b):
        kept = pa.array(_kept_texts(data, ends, start, end, first, a, b), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [kept if n == text_col else rows.column(n) for n in plain.names], names=plain.names
        )

    return without_repeats(
        texts,
        Rule("word", window, min(GRAM, _power(window)), False),
        shard_of(window),
        finish,
        texts.schema,
        plain,
        id_col,
        text_col,
    )


def _power(window: int) -> int:
    return 1 << max(0, int(window).bit_length() - 2)


def kept_words(kept: Column) -> Column:
    """Words of a text joined by one space."""
    return F.regexp_replace(F.regexp_replace(kept, r"[\x20\x09-\x0D]+", " "), r"\A | \z", "")

"""Benchmark decontamination by edit distance over words.

A random walk over a window of words turns edit distance into Hamming distance:
the walk writes the word it stands on and moves on or stays, by a random bit of
step and word. Tables of sampled steps of several walks are looked up with the
same samples of the benchmark's items. What meets there is verified by the
edit distance itself.

Windows as long as an item are taken at every word. Those that share fewer
word pairs with the items than the edit distance allows are left out before the
walk; no window within the distance is lost by that.

The longer an item, the rarer a walk keeps pace with an edited copy. So each
length gets as many walks as edited copies of random items need to be found, and
items of more than 60 words are cut into parts: of a copy within the distance, some
part is within its share of it. What a part finds is verified against the whole item.
Items so short that no edit is allowed are looked up by the hash of their words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import text_blocks
from daybook.llm.units import U, PrefixHash, grams, mix, table, word_hashes

#: Bytes that may be part of a word: ASCII letters and digits, and what other characters are made of.
WORD_BYTES = table(bytes(b for b in range(128) if not chr(b).isalnum()))
SEPARATOR, LETTER, ALONE = 0, 1, 2
_LETTERS = regex.compile(r"[\p{L}\p{M}\p{N}]+")
#: Scripts that are written without spaces: each character is a word.
_ALONE = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}]+")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
TABLES, SAMPLES = 8, 4  # per walk, per table
LEAST_WALKS, MOST_WALKS = 4, 256
#: Share of trial items, edited as often as allowed, that the walks must find; above the 0.99 that is promised.
TRIALS, TRIAL_RECALL = 400, 0.995
PART_WORDS = 60
ITEM_BYTES = 600
PAD = U(0xD1B54A32D192ED03)


@dataclass(frozen=True)
class Items:
    """The items of a block."""

    ids: np.ndarray
    words: list[np.ndarray]
    heads: np.ndarray  # first words
    allowed: np.ndarray  # edits


@dataclass(frozen=True)
class ItemIndex:
    """Parts of one length: where they lie in their items, and the keys of their walks."""

    size: int
    allowed: int
    walks: int  # 0: no number of walks will do, all parts are compared
    items: Items
    item: np.ndarray  # of each part
    offset: np.ndarray  # of each part within its item
    keys: np.ndarray  # sorted
    owner: np.ndarray  # part of each key


@lru_cache(1)
def _character_kinds() -> np.ndarray:
    """Whether each code point separates words, is a part of one, or is one alone."""
    every = "".join(map(chr, range(0x110000)))
    out = np.zeros(len(every), np.uint8)
    for run in _LETTERS.finditer(every):
        out[run.start() : run.end()] = LETTER
    for run in _ALONE.finditer(every):
        out[run.start() : run.end()][out[run.start() : run.end()] == LETTER] = ALONE
    return out


def _word_bounds(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word. Only characters beyond ASCII are decoded."""
    inside = WORD_BYTES[data]
    cut = np.zeros(len(data) + 1, bool)  # no word runs over these places
    cut[ends] = True
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        bytes_ = [data[np.minimum(lead + k, len(data) - 1)].astype(np.int64) for k in range(4)]
        width = 2 + (bytes_[0] >= 0xE0) + (bytes_[0] >= 0xF0)
        code = bytes_[0] & (0x7F >> width)
        for k in range(1, 4):
            code = np.where(width > k, (code << 6) | (bytes_[k] & 0x3F), code)
        kind = _character_kinds()[np.minimum(code, 0x10FFFF)]
        no_letter = np.flatnonzero(kind == SEPARATOR)
        for k in range(4):
            some = no_letter[width[no_letter] > k]
            inside[np.minimum(lead[some] + k, len(data) - 1)] = False
        alone = kind == ALONE
        cut[lead[alone]] = True
        cut[np.minimum(lead[alone] + width[alone], len(data))] = True
    start, end = inside.copy(), inside
    start[1:] &= ~inside[:-1] | cut[1:-1]
    end[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def tokenize(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the first word of each text (with the end)."""
    start, end = _word_bounds(data, ends)
    return word_hashes(_LOWER[data], start, end), np.searchsorted(start, ends)


@lru_cache(4096)
def _samples(size: int, walk: int) -> np.ndarray:
    """Sampled steps of each table of a walk; steps lie in the part of the walk that crosses the window."""
    rng = np.random.default_rng((size, walk))
    return np.sort(rng.integers(0, 2 * size, (TABLES, SAMPLES)), axis=1)


def walk_keys(
    hashes: np.ndarray, start: np.ndarray, stop: np.ndarray, size: int, low: int, high: int
) -> np.ndarray:
    """Keys (window, walk * table) of walks `low` up to `high` over the windows of `size` words from `start`.

    Windows end at `stop` at the latest.
    """
    picks = np.concatenate([_samples(size, w) for w in range(low, high)])
    column = np.arange(low * TABLES, high * TABLES, dtype=U)[:, None]
    turn = np.arange(low, high, dtype=U)[:, None] * U(100_003)
    keys = np.zeros((len(picks), len(start)), U)
    at = np.tile(start, (high - low, 1))
    end = np.minimum(start + size, stop)
    for step in range(int(picks.max()) + 1):
        on = at < end
        here = np.where(on, hashes[np.minimum(at, len(hashes) - 1)], PAD)
        for k in range(SAMPLES):
            own = np.flatnonzero(picks[:, k] == step)
            if len(own):
                keys[own] = mix(keys[own] * U(3) + here[own // TABLES] + (column[own] + U(1)))
        move = (mix(here + (turn + U(step + 1)) * U(0x9E3779B97F4A7C15)) >> U(63)).astype(np.int64)
        at += move & on
    return mix(keys + (column << U(8))).T


def _edited(rng: np.random.Generator, words: list, edits: int) -> list:
    """Words with so many random substitutions, deletions and insertions."""
    words = list(words)
    for kind, place, word in zip(
        rng.integers(0, 3, edits).tolist(), rng.random(edits).tolist(),
        rng.integers(0, 1 << 64, edits, U).tolist(),
    ):
        at = int(place * len(words))
        words[at : at + (kind != 2)] = [] if kind == 1 else [word]
    return words


@lru_cache(4096)
def walks_needed(size: int, allowed: int) -> int:
    """Walks that find items of `size` words after `allowed` edits, from trials; 0 if no number up to the most does.

    A trial counts the window at the start of the copy alone; its neighbours find some more.
    """
    if not allowed:
        return 1
    rng = np.random.default_rng((size, allowed))
    items = rng.integers(0, 1 << 64, (TRIALS, size), U)
    copies = [
        (_edited(rng, item, allowed) + rng.integers(0, 1 << 64, size, U).tolist())[:size] for item in items.tolist()
    ]
    copies, missed, low, high = np.array(copies, U), np.arange(TRIALS), 0, LEAST_WALKS
    while high <= MOST_WALKS:
        start = np.arange(len(missed)) * size
        own, other = (
            walk_keys(h[missed].reshape(-1), start, start + size, size, low, high) for h in (items, copies)
        )
        missed = missed[~(own == other).any(axis=1)]
        if len(missed) <= TRIALS * (1 - TRIAL_RECALL):
            return high
        low, high = high, high * 2
    return 0


@dataclass(frozen=True)
class Pairs:
    """Word pairs of the items, and the lengths of the items that hold each."""

    hashes: np.ndarray  # sorted
    seen: np.ndarray  # whether a pair may be there, by the first bits of its hash
    first: np.ndarray  # where the lengths of each pair start, with the end
    groups: np.ndarray

    def hits(self, both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, group) of each pair that an item holds, by group and place."""
        place = np.flatnonzero(self.seen[(both >> U(44)).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.hashes, both[place]), max(0, len(self.hashes) - 1))
        real = self.hashes[found] == both[place] if len(self.hashes) else np.zeros(0, bool)
        place, found = place[real], found[real]
        count = self.first[found + 1] - self.first[found]
        slot = np.repeat(self.first[found] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        group, place = self.groups[slot], np.repeat(place, count)
        order = np.argsort(group, kind="stable")
        return place[order], group[order]


def _parts(n_words: int) -> list[tuple[int, int]]:
    """(offset, size) of the parts of an item: as few as possible of at most PART_WORDS words, alike in size."""
    count = -(-n_words // PART_WORDS)
    cuts = [n_words * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def build(
    items: list[tuple[int, str]], similarity: float = 0.8, min_words: int = 1
) -> tuple[list[ItemIndex], Pairs]:
    """Index per length of the items' parts, and their word pairs."""
    ids, item_words, by_size = [], [], {}
    for item_id, text in items:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        hashes, _ = tokenize(raw, np.array([0, len(raw)]))
        if len(hashes) >= max(1, min_words):
            for offset, size in _parts(len(hashes)):
                by_size.setdefault(size, []).append((len(ids), offset))
            ids.append(item_id)
            item_words.append(hashes)
    allowed_edits = np.array([math.floor(len(w) * (1 - similarity) + 1e-9) for w in item_words], np.int64)
    shared = Items(np.array(ids), item_words, np.array([w[0] for w in item_words], U), allowed_edits)
    out, pairs, groups = [], [np.zeros(0, U)], [np.zeros(0, np.int64)]
    for size, found in sorted(by_size.items()):
        item, offset = np.array(found).T
        matrix = np.stack([item_words[i][o : o + size] for i, o in found])
        # an item within its distance has a part within this one
        allowed = math.floor(size * (1 - similarity) + 1e-9)
        walks = walks_needed(size, allowed)
        keys, n_keys = np.zeros(0, U), 0
        if not allowed:
            keys, n_keys = _run_keys(matrix.reshape(-1), size)[::size], 1
        elif walks:
            start, n_keys = np.arange(len(found)) * size, walks * TABLES
            keys = walk_keys(matrix.reshape(-1), start, start + size, size, 0, walks).reshape(-1)
        owner = np.repeat(np.arange(len(found), dtype=np.int32), n_keys)
        order = np.argsort(keys, kind="stable")
        own = np.unique(np.concatenate([grams(h, 2) for h in matrix]))
        pairs.append(own)
        groups.append(np.full(len(own), len(out)))
        out.append(ItemIndex(size, allowed, walks, shared, item, offset, keys[order], owner[order]))
    pair, group = np.concatenate(pairs), np.concatenate(groups)
    order = np.lexsort((group, pair))
    pair, group = pair[order], group[order]
    distinct, first = np.unique(pair, return_index=True)
    seen = np.zeros(1 << 20, bool)
    seen[(distinct >> U(44)).astype(np.int64)] = True
    return out, Pairs(distinct, seen, np.concatenate([first, [len(pair)]]), group)


def _run_keys(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` words, as many as fit."""
    return mix(PrefixHash(hashes).runs(size))


def _starts(places: np.ndarray, size: int, need: int, total: int) -> np.ndarray:
    """Starts of windows of `size` words with at least `need` of the pairs at sorted `places`."""
    if need <= 0:
        return np.arange(total)
    if len(places) < need:
        return np.zeros(0, np.int64)
    low = np.maximum(places[need - 1 :] - (size - 2), 0)
    high = places[: len(places) - need + 1]
    fits = low <= high
    change = np.bincount(low[fits], minlength=total + 1) - np.bincount(
        high[fits] + 1, minlength=total + 1
    ) if fits.any() else np.zeros(1, np.int64)
    return np.flatnonzero(np.cumsum(change) > 0)


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, length) of the part of `text` that is nearest to `item` by edits of words.

    Ties go to the part that ends first, then to the longest. A cell holds its
    distance and its start in one number; a row is computed at once, as words
    that only the text has are a running least value.
    """
    one = len(text) + 1  # an edit; what is below is the start
    row, only_text = np.arange(one), np.arange(one) * one
    for word in item:
        now = row + one
        np.minimum(now[1:], row[:-1] + (text != word) * one, out=now[1:])
        row = np.minimum.accumulate(now - only_text) + only_text
    end = int((row // one).argmin())
    distance, start = divmod(int(row[end]), one)
    return distance, start, end - start


def find(
    index: list[ItemIndex], pairs: Pairs, data: np.ndarray, ends: np.ndarray
) -> list[tuple[int, int, int, int, int, int]]:
    """The best match of each text and item within the distance.

    Each is (text, item id, distance, first word, words, words of the item).
    """
    hashes, first = tokenize(data, ends)
    if not len(hashes) or not index:
        return []
    text_of = np.repeat(np.arange(len(ends) - 1), np.diff(first))
    both = grams(hashes, 2)
    place, group_of = pairs.hits(both) if len(both) else (np.zeros(0, np.int64),) * 2
    inside = text_of[place] == text_of[np.minimum(place + 1, len(hashes) - 1)]
    place, group_of = place[inside], group_of[inside]
    cuts = np.searchsorted(group_of, np.arange(len(index) + 1))
    out: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    stop_of = first[1:]
    for k, group in enumerate(index):
        need = group.size - 1 - 2 * group.allowed
        start = _starts(place[cuts[k] : cuts[k + 1]], group.size, need, len(hashes))
        # words that the text must have left for a match
        start = start[stop_of[text_of[start]] - start >= group.size - group.allowed]
        # what a step holds per window: keys, or all parts
        wide = group.walks * TABLES or len(group.item)
        some_at_once = max(1, (1 << 22) // wide)
        for at in range(0, len(start), some_at_once):
            some = start[at : at + some_at_once]
            _verify(group, _meet(group, hashes, some, stop_of[text_of[some]]), hashes, text_of, first, out)
    return [(t, i, *x) for (t, i), x in sorted(out.items())]


def _meet(group: ItemIndex, hashes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """(part, start) of the windows that share a key with a part, in order."""
    if not len(start):
        return np.zeros((0, 2), np.int64)
    if not group.allowed:
        keys = _run_keys(hashes, group.size)[start][:, None]
    elif not group.walks:
        part, window = np.divmod(np.arange(len(group.item) * len(start)), len(start))
        return np.stack([part, start[window]], axis=1)
    else:
        keys = walk_keys(hashes, start, stop, group.size, 0, group.walks)
    low = np.searchsorted(group.keys, keys.reshape(-1), "left")
    count = np.searchsorted(group.keys, keys.reshape(-1), "right") - low
    window = np.repeat(np.repeat(np.arange(len(start)), keys.shape[1]), count)
    slot = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    return np.unique(np.stack([group.owner[slot], start[window]], axis=1), axis=0)


def _verify(group: ItemIndex, met: np.ndarray, hashes, text_of, first, out) -> None:
    """Whole items are verified where their parts met; what lies close together in a text is one stretch."""
    if not len(met):
        return
    items = group.items
    item, text = group.item[met[:, 0]], text_of[met[:, 1]]
    start = met[:, 1] - group.offset[met[:, 0]]  # of the whole item
    order = np.lexsort((start, text, item))
    item, text, start = item[order], text[order], start[order]
    same_head = (start >= first[text]) & (hashes[np.maximum(start, 0)] == items.heads[item])
    cuts = np.flatnonzero(
        (np.diff(item) != 0) | (np.diff(text) != 0) | (np.diff(start) > items.allowed[item[1:]] + 1)
    ) + 1
    for a, b in zip(np.concatenate([[0], cuts]).tolist(), np.concatenate([cuts, [len(item)]]).tolist()):
        t, words, allowed = int(text[a]), items.words[item[a]], int(items.allowed[item[a]])
        key, n_words, begin, stop = (t, int(items.ids[item[a]])), len(words), int(first[t]), int(first[t + 1])
        exact = next(
            (
                s for s in start[a:b][same_head[a:b]].tolist()
                if s + n_words <= stop and np.array_equal(hashes[s : s + n_words], words)
            ),
            None,
        )
        if exact is not None:
            best = (0, exact - begin, n_words, n_words)
        elif key in out and not out[key][0]:
            continue
        else:
            low = max(begin, int(start[a]) - allowed)
            high = min(stop, int(start[b - 1]) + n_words + allowed)
            distance, at, n = best_match(words, hashes[low:high])
            best = (distance, at + low - begin, n, n_words)
        if best[0] <= allowed:
            out[key] = min(out.get(key, best), best)


def item_blocks(
    benchmark: DataFrame, block: int, id_col: str, text_col: str
) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in parts of about `block` items, read one at a time: a benchmark of any size is a loop over blocks.

    Longer items have more keys, so a part has no more than about `block` times ITEM_BYTES of text either.
    """
    items = benchmark.select(
        F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")
    ).where("item_id is not null and text is not null")
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-n // block), -(-size // (block * ITEM_BYTES)))
    for part in range(parts):
        yield [
            (r["item_id"], r["text"]) for r in items.where(
                F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part
            ).orderBy("item_id", "text").collect()
        ]


def contaminated(
    docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, block: int = 20_000, min_words: int = 1,
    id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """`doc_id, item_id, distance, similarity, first_word, n_words` per document row and item that it holds.

    A document holds an item if some part of it is within
    floor((1 - similarity) * words) word edits of the item. Words are runs of
    letters, digits and marks, without regard to the case of A-Z; of scripts
    without spaces, such as Han or Thai, each character is a word. All else
    separates words. Items that allow no edit, those of up to four words at 0.8, are
    looked up exactly; `min_words` leaves shorter items out. Of the items edited
    as often as allowed, the walks find 0.99 at any length.

    Null or empty texts hold nothing; null item ids and texts are left out; a
    null doc_id stays null. Repeated documents are answered each, items with
    one id count as one. No rows on either side give no rows. Whole texts are
    read in one narrow pass per block of `block` items, whose index is broadcast.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    out = None
    for items in item_blocks(benchmark, block, item_id_col, item_text_col):
        shared = spark.sparkContext.broadcast(build(items, similarity, min_words))

        def run(batches, shared=shared):
            index, pairs = shared.value
            for rows, data, ends in text_blocks(batches):
                found = find(index, pairs, data, ends)
                if found:
                    text, item, distance, first, n, size = map(np.array, zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [
                            rows.column("doc_id").take(pa.array(text)),
                            pa.array(item),
                            pa.array(distance.astype(np.int32)),
                            pa.array(1 - distance / size),
                            pa.array(first),
                            pa.array(n),
                        ],
                        names=["doc_id", "item_id", "distance", "similarity", "first_word", "n_words"],
                    )

        part = texts.mapInArrow(
            run, "doc_id long, item_id long, distance int, similarity double, first_word long, n_words long"
        )
        out = part if out is None else out.union(part)
    return out


def clean_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = 0.8,
    block: int = 20_000,
    min_words: int = 1,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of `docs`, with all columns, that hold no item as `contaminated` finds them.

    Rows with a null or empty text stay, repeated rows are kept or dropped alike.
    """
    for items in item_blocks(benchmark, block, item_id_col, item_text_col):
        docs = docs.where(~_holds(docs, build(items, similarity, min_words), text_col))
    return docs


def _holds(docs: DataFrame, index, text_col: str) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf("boolean")
    def holds(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts), bool)
        column = pa.RecordBatch.from_arrays([texts, pa.array(np.arange(len(texts)))], names=["text", "at"])
        for rows, data, ends in text_blocks([column]):
            hit = {t for t, *_ in find(*shared.value, data, ends)}
            out[rows.column("at").to_numpy()[sorted(hit)]] = True
        return pa.array(out)

    return holds(F.coalesce(F.col(text_col).cast("string"), F.lit("")))

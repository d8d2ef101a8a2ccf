"""Cost-balanced packing of documents into sequences of tokens.

A document costs its length plus a share of its squared length, as attention
does. Documents go in descending order to the sequence of the lowest cost that
still has room for them; what fits nowhere whole is cut over the free places.

Rows are packed in blocks of about `block_tokens` tokens within a task, so that
memory is bounded whatever the partition holds. The sequences of a block are
filled exactly: as many whole ones as its tokens fill, the rest in sequences
whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from daybook.llm.rows import id_and_text, text_blocks

SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("sequence_tokens", pa.int64()),
        ("sequence_cost", pa.float64()),
    ]
)
DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_tokens long, sequence_cost double"
)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_SMALL = np.isin(np.arange(256), list(range(97, 123)))


class WordIds:
    """Token ids of texts, one lookup per word.

    The tokenizer splits at white space and never joins across it, so the ids of
    a text are those of its words in turn. Words are cut at ASCII white space
    only; unknown ones are encoded together, parted by a special token. The
    table of known words starts anew beyond `room` words.

    The tokenizer lower-cases and splits runs of letters from runs of other
    signs. So that fewer words are distinct, A-Z is lower-cased here first, and
    a comma or full stop between a letter and white space is set apart. Texts
    with a special token's opening, or with combining accents, stay as they are.
    """

    def __init__(self, path: str, room: int = 500_000):
        from tokenizers import Tokenizer, normalizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content.encode() for t in special.values()]
        self.mark_id, mark = next(iter(special.items()))
        self.mark = mark.content
        self.lowers = '"Lowercase"' in self.tokenizer.to_str()
        self.ends_word = self.bare = None
        if self.lowers and getattr(self.tokenizer.model, "end_of_word_suffix", None):
            suffix = self.tokenizer.model.end_of_word_suffix
            self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.ends_word[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
            # for words that normalisation does not change
            self.bare = Tokenizer.from_file(path)
            self.bare.no_truncation()
            self.bare.no_padding()
            self.bare.normalizer = normalizers.Sequence([])
        self.room = room
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 20, np.uint32)
        self.start = np.zeros(1, np.int64)

    def _parted(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of words, with the special token between them."""
        text = self.mark.join([w.decode() for w in words])
        (one,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        out = np.array(one.ids, np.uint32)
        cuts = np.flatnonzero(out == self.mark_id)
        if len(cuts) != len(words) - 1:
            raise ValueError("the tokenizer does not keep the mark between words")
        return np.delete(out, cuts), np.diff(cuts, prepend=-1, append=len(out)) - 1

    def _of_letters(self, words: list[str], tokenizer) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters alone: each is one run, whose last id ends a word."""
        (one,) = tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        out = np.array(one.ids, np.uint32)
        ends = np.flatnonzero(self.ends_word[out]) + 1
        if len(ends) != len(words):  # some word is more than one run after all
            return self._parted([w.encode() for w in words])
        return out, np.diff(ends, prepend=0)

    def _add(self, words: list[bytes]) -> None:
        special = any(s in b" ".join(words) for s in self.special)
        small, letters, other, odd = [], [], [], []
        for word in words:
            if self.ends_word is not None and word.isascii() and word.isalpha() and word.islower():
                small.append(word)
            elif special and any(s in word for s in self.special):
                odd.append(word)
            elif self.ends_word is not None and word.decode().isalpha():
                letters.append(word)
            else:
                other.append(word)
        found = []
        for group, size, encode in (
            (small, 2000, lambda part: self._of_letters([w.decode() for w in part], self.bare)),
            (letters, 500, lambda part: self._of_letters([w.decode() for w in part], self.tokenizer)),
            (other, 100, self._parted),
        ):
            found += [encode(group[at : at + size]) for at in range(0, len(group), size)]
        for word in odd:
            ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
            found.append((np.array(ids, np.uint32), np.array([len(ids)])))
        base = len(self.known)
        self.known.update(zip(small + letters + other + odd, range(base, base + len(words))))
        end = int(self.start[-1])
        need = end + sum(len(ids) for ids, _ in found)
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(need - end, len(self.flat)), np.uint32)])
        self.flat[end:need] = np.concatenate([ids for ids, _ in found])
        self.start = np.concatenate([self.start, end + np.cumsum(np.concatenate([n for _, n in found]))])

    def _plainer(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same texts with fewer distinct words and the same ids."""
        if not len(data):
            return data, ends
        odd = np.flatnonzero((data == 0xCC) | (data == 0xCD) | (data == ord("<")))
        change = np.ones(len(ends) - 1, bool)
        change[np.searchsorted(ends, odd, side="right") - 1] = False
        inside = np.repeat(change, np.diff(ends))
        low = np.where(inside, _LOWER[data], data)
        apart = np.zeros(len(data), bool)
        apart[1:] = ((low[1:] == ord(",")) | (low[1:] == ord("."))) & _SMALL[low[:-1]] & inside[1:]
        apart[:-1] &= _SPACE[low[1:]]
        first = ends[:-1][ends[:-1] < len(data)]
        apart[first] = False
        apart[first[first > 0] - 1] = False
        at = np.flatnonzero(apart)
        return np.insert(low, at, ord(" ")), ends + np.searchsorted(at, ends)

    def encode(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in turn, and where each text starts, with the end."""
        if len(self.known) > self.room:
            self._clear()
        if self.lowers:
            data, ends = self._plainer(data, ends)
        raw = data.tobytes()
        words = [raw[a:b].split() for a, b in zip(ends.tolist(), ends[1:].tolist())]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        flat = list(itertools.chain.from_iterable(words))
        missing = set(flat).difference(self.known)
        if missing:
            self._add(list(missing))
        index = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        begin, n = self.start[index], self.start[index + 1] - self.start[index]
        stop = np.cumsum(n)
        total = int(stop[-1]) if len(stop) else 0
        ids = self.flat[np.repeat(begin - (stop - n), n) + np.arange(total)]
        bounds = np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, bounds


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def capacities(total: int, size: int) -> list[int]:
    """Whole sequences, then powers of two for what is left."""
    rest = total % size
    return [size] * (total // size) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(lengths: list[int], size: int, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of documents of these lengths.

    Ties in length go to the earlier document, ties in cost to the earlier sequence.
    """
    pieces, rests = [], []
    room = capacities(sum(lengths), size)
    at = 0
    for d, n in enumerate(lengths):
        whole = n // size
        for k in range(whole):  # a document longer than a sequence fills whole ones
            pieces.append((d, k * size, size, at, 0))
            at += 1
        if n % size:
            rests.append((-(n % size), d, whole * size))
    rests.sort()
    used, cost = [0] * len(room), [0.0] * len(room)
    open_, closed = [(0.0, s) for s in range(at, len(room))], []  # by cost; by room, for documents shorter than now
    heapq.heapify(open_)
    late = []

    def put(d, start, n, s):
        pieces.append((d, start, n, s, used[s]))
        used[s] += n
        cost[s] += n + quadratic * n * n

    for minus, d, start in rests:
        n = -minus
        while closed and -closed[0][0] >= n:
            s = heapq.heappop(closed)[1]
            heapq.heappush(open_, (cost[s], s))
        while open_ and room[open_[0][1]] - used[open_[0][1]] < n:
            s = heapq.heappop(open_)[1]
            if room[s] > used[s]:
                heapq.heappush(closed, (used[s] - room[s], s))
        if open_:
            s = heapq.heappop(open_)[1]
            put(d, start, n, s)
            heapq.heappush(open_, (cost[s], s))
        else:
            late.append((d, start, n))
    free = sorted((cost[s], s) for s in range(at, len(room)) if room[s] > used[s])
    k = 0
    for d, start, n in late:
        while n:
            s = free[k][1]
            part = min(n, room[s] - used[s])
            put(d, start, part, s)
            start, n = start + part, n - part
            k += used[s] == room[s]
    return pieces


def _pack(path: str, size: int, end_id: int, quadratic: float, block_tokens: int):
    def flush(doc_ids, ids, bounds, task, first):
        lengths = np.diff(bounds)
        pieces = assign(lengths.tolist(), size, quadratic)
        filled, cost = {}, {}
        for _, _, n, s, _ in pieces:
            filled[s] = filled.get(s, 0) + n
            cost[s] = cost.get(s, 0.0) + n + quadratic * n * n
        raw = ids.astype("<u4").tobytes()
        crc = [zlib.crc32(raw[4 * (a := int(bounds[d]) + start) : 4 * (a + n)]) for d, start, n, _, _ in pieces]
        columns = list(zip(*pieces))
        docs, seq = np.array(columns[0]), np.array(columns[3])
        return (
            pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids).take(pa.array(docs)),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array(lengths[docs], pa.int64()),
                    pa.array((task << 32) + first + seq, pa.int64()),
                    pa.array(columns[4], pa.int64()),
                    pa.array([filled[s] for s in columns[3]], pa.int64()),
                    pa.array([cost[s] for s in columns[3]], pa.float64()),
                ],
                schema=SCHEMA,
            ),
            first + len(filled),
        )

    def run(batches):
        encoder, task, first = word_ids(path), TaskContext.get().partitionId(), 0
        doc_ids, parts, lengths, have = [], [], [], 0
        for rows, data, ends in text_blocks(batches):
            ids, bounds = encoder.encode(data, ends)
            # the end id after each document
            closed = np.insert(ids, bounds[1:], end_id)
            doc_ids += rows.column("doc_id").to_pylist()
            parts.append(closed.astype(np.uint16 if closed.max(initial=0) < 65536 else np.uint32))
            lengths.append(np.diff(bounds) + 1)
            have += len(closed)
            if have >= block_tokens:
                batch, first = flush(
                    doc_ids,
                    np.concatenate(parts),
                    np.concatenate([[0], np.cumsum(np.concatenate(lengths))]),
                    task,
                    first,
                )
                yield batch
                doc_ids, parts, lengths, have = [], [], [], 0
        if doc_ids:
            yield flush(
                doc_ids,
                np.concatenate(parts),
                np.concatenate([[0], np.cumsum(np.concatenate(lengths))]),
                task,
                first,
            )[0]

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    size: int = 2048,
    end_id: int = 1,
    quadratic: float = 1 / 2048,
    block_tokens: int = 8 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents with their place: one narrow pass, no shuffle.

    A null or empty text is one token, the end id. Repeated rows are packed
    each. A null id stays null. No rows give no rows. Other columns are ignored.
    A single text longer than `block_tokens` makes its block as long as it is.
    Sequence ids are the task's number and a counter, the same if the task is run again.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(
        _pack(tokenizer, size, end_id, quadratic, block_tokens), DDL
    )

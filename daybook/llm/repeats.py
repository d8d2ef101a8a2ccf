"""Where windows of texts repeat: the distributed frame that both substring operators share.

A window is a run of units (words or bytes). Every window has an anchor, a
short run inside it that depends on its content alone, so equal windows have
equal anchors. Consecutive windows of one anchor make a stretch.

1. Each block of texts asks, per distinct stretch, with the anchor's hash and a
   digest of the stretch. Copies within a block ask once.
2. Whoever gathers the requests of an anchor answers: the anchor is unique (no
   window of the stretch repeats), the whole stretch is a copy of one that
   counts, and which stretches must be compared.
3. Those are sent, one of each content, to the shard of their anchor. An index
   of the shard finds which of their windows repeat.
4. Answers return to the blocks, which remove what is covered.

An anchor that a third of all texts hold would gather all of their stretches in
one shard. Such anchors are known beforehand from a sample; their windows are
asked and sent one by one, by their own hash, and what differs spreads out.

Blocks travel compressed, as one row each. What they ask and send travels as a
row per bucket of anchors, and buckets grow in number with the texts. So several
blocks of a task make a load, which sends one row per bucket: loads grow with
the number of buckets, else rows would grow with the square of the input.

Answers refer to a load by its task and number and carry a check of its content:
a block that is computed anew must be the same. An input whose plan has a
shuffle is written first.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import partitions_for, spread, text_blocks, uniform, written
from daybook.llm.units import U, PrefixHash, byte_values, grams, mix, stretches, word_hashes, words

NO_ID = np.iinfo(np.int64).max
BLOCK = 2 << 20
#: Text per bucket that a load holds, some hundred requests, so that a row costs little beside what it carries.
BUCKET_SHARE = 16 << 10
#: Text that a load holds at most; its requests are in memory together.
LOAD = 64 << 20


@dataclass(frozen=True)
class Rule:
    """What repeats and when it counts.

    unit: "word" or "byte". smaller_id: a window counts if it starts in a text
    of a smaller id; otherwise if it starts anywhere else.
    """

    unit: str
    window: int
    gram: int
    smaller_id: bool


@dataclass
class Units:
    """The units of a block of texts."""

    start: np.ndarray | None  # first byte of each word
    end: np.ndarray | None
    first: np.ndarray  # first unit of each text, with the end
    g: np.ndarray
    content: PrefixHash
    anchors: tuple = field(default=())

    def digest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix(self.content.raw(a, b) + (b - a).astype(U))


def units_of(rule: Rule, data: np.ndarray, ends: np.ndarray) -> Units:
    if rule.unit == "byte":
        g = mix(PrefixHash(byte_values(data)).runs(rule.gram))
        return Units(None, None, ends, g, PrefixHash(byte_values(data, 1)))
    start, end, first = words(data, ends)
    h = word_hashes(data, start, end)
    return Units(start, end, first, grams(h, rule.gram), PrefixHash(h))


@dataclass
class Requests:
    """Stretches of a block, and the distinct ones that ask."""

    first: np.ndarray  # first unit of each stretch
    windows: np.ndarray
    text: np.ndarray
    lead: np.ndarray  # the request that asks for each stretch
    later: np.ndarray  # its text has a larger id than the request's
    route: np.ndarray  # per request from here on
    content: np.ndarray
    least: np.ndarray  # least id of its texts
    count: np.ndarray
    bucket: np.ndarray
    head: np.ndarray  # the stretch that stands for it


def requests_of(rule: Rule, units: Units, ids: np.ndarray, hot: np.ndarray, buckets: int) -> Requests:
    first, windows, anchor = stretches(units.g, units.first, rule.window, rule.gram)
    route = units.g[anchor] if len(anchor) else np.zeros(0, U)
    if len(hot) and len(route):
        place = np.minimum(np.searchsorted(hot, route), len(hot) - 1)
        single = hot[place] == route
        if single.any():
            many = windows[single]
            own = np.repeat(first[single], many) + np.arange(many.sum()) - np.repeat(
                np.cumsum(many) - many, many
            )
            first = np.concatenate([first[~single], own])
            windows = np.concatenate([windows[~single], np.ones(len(own), np.int64)])
            route = np.concatenate([route[~single], mix(units.digest(own, own + rule.window) + U(1))])
    text = np.searchsorted(units.first, first, side="right") - 1
    content = units.digest(first, first + windows + rule.window - 1)
    key = ids[text] if rule.smaller_id else np.zeros(len(text), np.int64)
    # one sort brings equal stretches together; should two kinds of stretch share
    # a sort key, they ask more than once, which changes no answer
    order = np.argsort(route ^ mix(content), kind="stable")
    r, c = route[order], content[order]
    new = np.ones(len(order), bool)
    new[1:] = (r[1:] != r[:-1]) | (c[1:] != c[:-1])
    group = np.cumsum(new) - 1
    lead = np.empty(len(order), np.int64)
    lead[order] = group
    heads = order[new]
    count = np.bincount(group, minlength=len(heads)) if len(order) else np.zeros(0, np.int64)
    least = np.minimum.reduceat(key[order], np.flatnonzero(new)) if len(order) else key
    bucket = ((route[heads] >> U(40)) % U(buckets)).astype(np.int64)
    return Requests(
        first,
        windows,
        text,
        lead,
        key > least[lead] if len(lead) else np.zeros(0, bool),
        route[heads],
        content[heads],
        least,
        count,
        bucket,
        heads,
    )


def pack(value) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(value, protocol=5))


def unpack(data: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def _small(x: np.ndarray) -> np.ndarray:
    """Differences of whole numbers in the narrowest type, which compress well."""
    if len(x) == 0:
        return x.astype(np.int8)
    step = np.diff(x, prepend=x.dtype.type(0))
    for kind in (np.int8, np.int16, np.int32):
        if step.min() >= np.iinfo(kind).min and step.max() <= np.iinfo(kind).max:
            return step.astype(kind)
    return step


def _wide(x: np.ndarray) -> np.ndarray:
    return np.cumsum(x, dtype=np.int64)


def _ids(rows: pa.RecordBatch, name: str) -> np.ndarray:
    return rows.column(name).cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _check(ids: np.ndarray, data: np.ndarray, ends: np.ndarray) -> int:
    seed = xxhash.xxh64_intdigest(ids.tobytes() + ends.tobytes())
    return xxhash.xxh64_intdigest(np.ascontiguousarray(data).data, seed) >> 1


def _check_of_load(checks: list[int]) -> int:
    return xxhash.xxh64_intdigest(np.array(checks, np.int64).tobytes()) >> 1


#: (destination, load, check, kind, payload): rows that travel. Blocks have their number within the load as destination.
ROWS = "bucket int, block long, digest long, kind int, payload binary"
_SCHEMA = pa.schema(
    [
        ("bucket", pa.int32()),
        ("block", pa.int64()),
        ("digest", pa.int64()),
        ("kind", pa.int32()),
        ("payload", pa.binary()),
    ]
)


def _row(*values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _SCHEMA)], schema=_SCHEMA)


def _rows(values: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([v[k] for v in values], f.type) for k, f in enumerate(_SCHEMA)], schema=_SCHEMA
    )


def _sized(values: Iterator[tuple], size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of rows with payloads of about `size` bytes."""
    held, have = [], 0
    for value in values:
        held.append(value)
        have += len(value[-1])
        if have >= size:
            yield _rows(held)
            held, have = [], 0
    if held:
        yield _rows(held)


def load_bytes(buckets: int) -> int:
    """Text of the blocks of a load, one block at least."""
    return min(LOAD, buckets * BUCKET_SHARE)


def _numbered_blocks(batches, id_name: str, text_name: str, block: int, load: int) -> Iterator:
    """(load, number within it, check, rows, ids, bytes, offsets) of each block; a load ends with the block that fills it."""
    task = TaskContext.get().partitionId()
    nth, number, have = 0, 0, 0
    for rows, data, ends in text_blocks(batches, size=block, text=text_name):
        ids = _ids(rows, id_name)
        yield (task << 32) + nth, number, _check(ids, data, ends), rows, ids, data, ends
        number, have = number + 1, have + len(data)
        if have >= load:
            nth, number, have = nth + 1, 0, 0


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    if len(order):
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]])
        for a, b in zip(cuts, cuts[1:]):
            yield int(bucket[order[a]]), order[a:b]


def _ask(rule: Rule, hot, buckets: int, id_name: str, text_name: str):
    block, load_size = BLOCK, load_bytes(buckets)

    def load_rows(load, blocks):
        checks, parts = [], []
        for _, _, check, _, ids, data, ends in blocks:
            asked = requests_of(rule, units_of(rule, data, ends), ids, hot.value, buckets)
            checks.append(check)
            route = np.ascontiguousarray(asked.route).view(np.uint8).reshape(-1, 8)[:, :6]
            parts.append(
                (
                    asked.bucket.astype(np.int32),
                    np.ascontiguousarray(route),
                    asked.content,
                    asked.least if rule.smaller_id else asked.least[:0],
                    asked.count.astype(np.int32),
                )
            )
        check = _check_of_load(checks)
        bucket, route, content, least, count = map(np.concatenate, zip(*parts))
        parts.clear()
        for k, own in by_bucket(bucket):
            extra = _small(least[own]) if rule.smaller_id else None
            yield k, load, check, 0, pack((route[own], content[own], extra, _small(count[own])))

    def run(batches):
        numbered = _numbered_blocks(batches, id_name, text_name, block, load_size)
        for load, blocks in groupby(numbered, key=itemgetter(0)):
            yield from _sized(load_rows(load, blocks))

    return run


REMOVED, SENT = 1, 2


def _answer(rule: Rule):
    """Per request: REMOVED if its whole stretch counts as repeated, SENT if it goes to the shard."""

    def bucket_answers(rows):
        sizes, routes, contents, keys, counts = [], [], [], [], []
        for _, _, payload in rows:
            route, content, extra, count = unpack(payload)
            wide = np.zeros((len(route), 8), np.uint8)
            wide[:, :6] = route
            sizes.append(len(route))
            routes.append(wide.view(U).ravel())
            contents.append(content)
            keys.append(_wide(extra) if extra is not None else np.zeros(len(route), np.int64))
            counts.append(_wide(count))
        route, content, key, count = map(np.concatenate, (routes, contents, keys, counts))
        order = np.lexsort((key, content, route))
        r, c, k, n = route[order], content[order], key[order], count[order]
        new_route = np.ones(len(order), bool)
        new_route[1:] = r[1:] != r[:-1]
        new = new_route.copy()
        new[1:] |= c[1:] != c[:-1]
        of_route, of_content = np.cumsum(new_route) - 1, np.cumsum(new) - 1
        whole = np.add.reduceat(n, np.flatnonzero(new_route))[of_route]
        alike = np.add.reduceat(n, np.flatnonzero(new))[of_content]
        if rule.smaller_id:
            least = k[new][of_content]
            # stretches that are all alike have nothing to be compared with
            kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_route))[of_route]
            removed, sent = k > least, (k == least) & (kinds > 1)
        else:
            removed, sent = alike > 1, new
        out = np.empty(len(order), np.uint8)
        out[order] = np.where(whole > 1, removed * REMOVED + sent * SENT, 0)
        at = 0
        for (block, check, _), size in zip(rows, sizes):
            yield block, check, out[at : at + size]
            at += size

    def run(batches):
        for bucket, rows in _gathered(batches):
            found = [
                (bucket, block, check, 0, pack(out)) for block, check, out in bucket_answers(rows) if out.any()
            ]
            if found:
                yield _rows(found)

    return run


def _gathered(batches) -> Iterator[tuple[int, list]]:
    """The rows of a task by bucket; payloads stay packed until their bucket's turn."""
    held: dict[int, list] = {}
    for batch in batches:
        for bucket, block, check, payload in zip(
            *(batch.column(c).to_pylist() for c in ("bucket", "block", "digest", "payload"))
        ):
            held.setdefault(bucket, []).append((block, check, payload))
    for bucket in sorted(held):
        yield bucket, held.pop(bucket)


def _ipc(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _from_ipc(payload: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(payload) as reader:
        return reader.read_next_batch()


def _blocks(buckets: int, id_name: str, text_name: str):
    block, load_size = BLOCK, load_bytes(buckets)

    def run(batches):
        for load, number, check, rows, _, _, _ in _numbered_blocks(batches, id_name, text_name, block, load_size):
            yield _row(number, load, check, 0, _ipc(rows))

    return run


def _one_load(blocks: pa.Table, others: pa.Table, id_name: str, text_name: str) -> Iterator[tuple]:
    """The rows of each block of a load with its ids and text, if what others say is about the same content."""
    blocks = blocks.sort_by("bucket")
    if not blocks.num_rows or blocks.column("bucket").to_pylist() != list(range(blocks.num_rows)):
        raise ValueError(
            "answers for a block that is not there: the input changed between two reads; write it first"
        )
    check = _check_of_load(blocks.column("digest").to_pylist())
    if any(x != check for x in others.column("digest").to_pylist()):
        raise ValueError("a block differs between two reads of the input; write it first")
    for payload in blocks.column("payload"):
        rows = _from_ipc(payload.as_py())
        _, data, ends = next(text_blocks([rows], size=1 << 62, text=text_name))
        yield rows, _ids(rows, id_name), data, ends


def _send(rule: Rule, hot, buckets: int, id_name: str, text_name: str):
    def states_of(answers: pa.Table):
        """A function that gives the states of a block's requests; blocks take theirs in order."""
        start, states, have = np.full(buckets, -1), [], 0
        for bucket, payload in zip(answers.column("bucket").to_pylist(), answers.column("payload")):
            states.append(unpack(payload.as_py()))
            start[bucket] = have
            have += len(states[-1])
        states = np.concatenate(states)

        def take(bucket: np.ndarray) -> np.ndarray:
            order = np.argsort(bucket, kind="stable")
            ordered = bucket[order]
            place = start[ordered]
            place[place >= 0] += (np.arange(len(order)) - np.searchsorted(ordered, ordered))[place >= 0]
            state = np.zeros(len(order), np.uint8)
            state[order] = np.where(place >= 0, states[place], 0)
            start[start >= 0] += np.bincount(bucket, minlength=buckets)[start >= 0]
            return state

        return take

    def sent_rows(load, check, parts):
        """The stretches of all blocks of the load, by bucket."""
        texts = b"".join(part[0] for part in parts)
        bucket, size, first, id_, weight = map(np.concatenate, zip(*(part[1:] for part in parts)))
        parts.clear()
        high = np.cumsum(size)
        low = high - size
        for k, own in by_bucket(bucket):
            a, b = low[own], high[own]
            cut = np.flatnonzero(a[1:] != b[:-1])  # stretches of one block and bucket lie side by side
            runs = zip(a[np.concatenate([[0], cut + 1])].tolist(), b[np.concatenate([cut, [len(b) - 1]])].tolist())
            own_texts = b"".join([texts[x:y] for x, y in runs])
            yield k, load, check, 0, pack((_small(size[own]), own_texts, first[own], id_[own], weight[own]))

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        if not answers.num_rows:
            return _SCHEMA.empty_table()
        load, check = answers.column("block")[0].as_py(), answers.column("digest")[0].as_py()
        state_of, covered, parts, before = states_of(answers), [], [], 0
        for _, ids, data, ends in _one_load(blocks, answers, id_name, text_name):
            units = units_of(rule, data, ends)
            asked = requests_of(rule, units, ids, hot.value, buckets)
            state = state_of(asked.bucket)
            mine = state[asked.lead]
            gone = ((mine & REMOVED) > 0) | asked.later
            covered.append((asked.first[gone] + before, asked.windows[gone]))
            raw = data.tobytes()
            if rule.smaller_id:  # each stretch of the least id asks for itself
                go = np.flatnonzero(((mine & SENT) > 0) & ~asked.later)
            else:
                go = asked.head[np.flatnonzero((state & SENT) > 0)]
            bucket = asked.bucket[asked.lead[go]]
            order = np.argsort(bucket, kind="stable")
            go, bucket = go[order], bucket[order]
            weight = np.where(state & REMOVED, 2, 1)[asked.lead[go]].astype(np.uint8)
            last = asked.first[go] + asked.windows[go] + rule.window - 2
            if rule.unit == "byte":
                low, high = asked.first[go], last + 1
            else:
                low, high = units.start[asked.first[go]], units.end[last]
            texts = b"".join([raw[a:b] for a, b in zip(low.tolist(), high.tolist())])
            first = asked.first[go].astype(np.int64) + before
            parts.append((texts, bucket, high - low, first, ids[asked.text[go]], weight))
            before += int(units.first[-1])
        first, windows = map(np.concatenate, zip(*covered))
        rows = list(_sized(sent_rows(load, check, parts)))
        if len(first):
            rows.append(_row(load % buckets, load, check, 1, pack(_spans(first, windows, rule.window))))
        return pa.Table.from_batches(rows) if rows else _SCHEMA.empty_table()

    return run


def _spans(first: np.ndarray, windows: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Merged runs of units that windows cover, as differences of starts and ends."""
    order = np.argsort(first, kind="stable")
    a, b = first[order], first[order] + windows[order] + window - 1
    b = np.maximum.accumulate(b) if len(b) else b
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > b[:-1]
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(a) - 1]]) if len(a) else np.zeros(0, np.int64)
    return _small(a[new]), _small(b[last])


#: (bytes, ends of stretches, ids, weights) -> (stretch, first window in it, windows) that repeat
Shard = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _compare(rule: Rule, buckets: int, shard: Shard):
    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            passed = batch.filter(pc.equal(batch.column("kind"), 1))
            if passed.num_rows:
                yield passed
            sent = batch.filter(pc.equal(batch.column("kind"), 0))
            for bucket, block, check, payload in zip(
                *(sent.column(c).to_pylist() for c in ("bucket", "block", "digest", "payload"))
            ):
                held.setdefault(bucket, []).append((block, check, payload))
        for bucket in sorted(held):
            rows = held.pop(bucket)
            sizes, texts, firsts, ids, weights = zip(*(unpack(p) for _, _, p in rows))
            owner = np.repeat(np.arange(len(rows)), [len(x) for x in sizes])
            ends = np.concatenate([[0], np.cumsum(np.concatenate([_wide(x) for x in sizes]))])
            first = np.concatenate(firsts)
            stretch, at, windows = shard(
                np.frombuffer(b"".join(texts), np.uint8), ends, np.concatenate(ids), np.concatenate(weights)
            )
            start, of = first[stretch] + at, owner[stretch]
            out = []
            for k, own in by_bucket(of):
                out.append(
                    (
                        rows[k][0] % buckets,
                        rows[k][0],
                        rows[k][1],
                        1,
                        pack(_spans(start[own], windows[own], rule.window)),
                    )
                )
            if out:
                yield _rows(out)

    return run


#: (rows, bytes, ends, starts and ends of words, first units of texts, starts and ends of removed runs) -> rows of the result
Finish = Callable[..., pa.RecordBatch]


def _finish(rule: Rule, id_name: str, text_name: str, schema: pa.Schema, finish: Finish):
    def run(blocks: pa.Table, spans: pa.Table) -> pa.Table:
        parts = [unpack(p) for p in spans.column("payload").to_pylist()]
        a = np.concatenate([_wide(x) for x, _ in parts]) if parts else np.zeros(0, np.int64)
        b = np.concatenate([_wide(x) for _, x in parts]) if parts else np.zeros(0, np.int64)
        merged = _spans(a, b - a, 1)
        from_, to = _wide(merged[0]), _wide(merged[1])
        before, out = 0, []
        for rows, _, data, ends in _one_load(blocks, spans, id_name, text_name):
            if rule.unit == "byte":
                start, end, first = None, None, ends
            else:
                start, end, first = words(data, ends)
            size = int(first[-1])
            own = slice(np.searchsorted(to, before, "right"), np.searchsorted(from_, before + size))
            # spans of one text never reach into the next, but may touch it; so with blocks
            a, b = np.maximum(from_[own] - before, 0), np.minimum(to[own] - before, size)
            a, b = a[a < b], b[a < b]  # a block without units may lie within a run
            before += size
            cut = first[1:-1]
            cut = cut[np.searchsorted(a, cut, "right") - 1 >= 0] if len(a) else cut[:0]
            at = np.searchsorted(a, cut, "right") - 1
            inside = (a[at] < cut) & (cut < b[at]) if len(cut) else np.zeros(0, bool)
            extra = np.unique(cut[inside])
            a, b = np.sort(np.concatenate([a, extra])), np.sort(np.concatenate([b, extra]))
            out.append(finish(rows, data, ends, start, end, first, a, b).cast(schema))
        return pa.Table.from_batches(out)

    return run


def hot_anchors(rule: Rule, texts: DataFrame, id_name: str, text_name: str, sample_texts: int) -> np.ndarray:
    """Anchors that many of a sample of texts hold, sorted; only their route depends on it, no result.

    The sample is of about max(sample_texts, 64 per shuffle partition) texts
    and an anchor is hot if 32 of them hold it: about half a partition's share.
    """
    spark = texts.sparkSession
    total = texts.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(sample_texts, 64 * parts)
    if not total:
        return np.zeros(0, U)

    def run(batches):
        for rows, data, ends in text_blocks(batches, size=BLOCK, text=text_name):
            units = units_of(rule, data, ends)
            first, _, anchor = stretches(units.g, units.first, rule.window, rule.gram)
            text = np.searchsorted(units.first, first, side="right") - 1
            pairs = np.unique(
                np.stack([units.g[anchor].view(np.int64), text], axis=1), axis=0
            ) if len(anchor) else np.zeros((0, 2), np.int64)
            anchor, count = np.unique(pairs[:, 0], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor, pa.int64()), pa.array(count, pa.int64())], names=["anchor", "n"]
            )

    some = texts.where(uniform(F.struct(F.col(id_name), F.length(text_name))) < min(1.0, wanted / total))
    found = some.mapInArrow(
        run, "anchor long, n long"
    ).groupBy("anchor").agg(F.sum("n").alias("n")).where("n >= 32").select("anchor").collect()
    return np.sort(np.array([r["anchor"] for r in found], np.int64).view(U))


#: Bytes of requests per byte of text, at most; measured at 1.6 for bytes, less for words.
REQUEST_SHARE = 1.6


def without_repeats(
    texts: DataFrame,
    rule: Rule,
    shard: Shard,
    finish: Finish,
    result: str,
    schema: pa.Schema,
    id_name: str,
    text_name: str,
    sample_texts: int = 5000,
) -> DataFrame:
    """The result of `finish` for all rows of `texts`, whose text column must not be null."""
    spark = texts.sparkSession
    if "Exchange" in texts._jdf.queryExecution().executedPlan().toString():
        texts = written(texts, "repeats")
    text_bytes = texts.agg(F.sum(F.octet_length(text_name))).first()[0] or 0
    parts = partitions_for(spark, int(text_bytes * REQUEST_SHARE))
    buckets = max(64, 4 * parts)
    hot = spark.sparkContext.broadcast(hot_anchors(rule, texts, id_name, text_name, sample_texts))
    blocks = texts.mapInArrow(_blocks(buckets, id_name, text_name), ROWS)
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        blocks = spread(blocks, parts, "block")  # the other sides of the joins follow
    keyed = texts.select(F.col(id_name), F.col(text_name))
    asked = keyed.mapInArrow(_ask(rule, hot, buckets, id_name, text_name), ROWS)
    answers = spread(asked, parts, "bucket").mapInArrow(_answer(rule), ROWS)
    sent = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _send(rule, hot, buckets, id_name, text_name), ROWS
    )
    spans = spread(sent, parts, "bucket").mapInArrow(_compare(rule, buckets, shard), ROWS)
    return blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(
        _finish(rule, id_name, text_name, schema, finish), result
    )

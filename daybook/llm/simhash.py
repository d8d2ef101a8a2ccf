"""Near duplicates by SimHash, found through variants of half fingerprints.

Two fingerprints that differ in at most three bits differ in at most one bit in
one of their halves. Each half is indexed exactly and once with each of its bits
left out; equal variants meet, and the whole fingerprints are then compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.components import connected_components
from daybook.llm.rows import id_and_digest, id_and_text, partitions_for, spread, text_blocks, written
from daybook.operators.joins import join_on_key

SEED = 42
HASHES_AT_ONCE = 1 << 16
KEY = "struct<doc_id: bigint, digest: bigint>"


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of the words of a text, in lower case A-Z; 0 without a word."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(shingle, len(words))
    first, last = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(first), HASHES_AT_ONCE):
        part = zip(first[at : at + HASHES_AT_ONCE], last[at : at + HASHES_AT_ONCE])
        h = np.array([digest(joined[a:b], SEED) for a, b in part], np.dtype("<u8"))
        counts += np.unpackbits(
            h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        ).sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(first)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id, digest, print` per row: the text's xxhash64 and its SimHash, each 64 bits as a long."""

    def run(batches):
        for rows, data, ends in text_blocks(batches, size=1 << 20):
            raw = data.tobytes()
            prints = np.array([fingerprint(raw[a:b], shingle) for a, b in zip(ends, ends[1:])], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"), rows.column("digest"), pa.array(prints.view(np.int64))
                ], names=["doc_id", "digest", "print"]
            )

    texts = id_and_text(docs, id_col, text_col).withColumn("digest", F.xxhash64("text"))
    return texts.mapInArrow(run, "doc_id long, digest long, print long")


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of the fewest segments of which one differs in at most one bit."""
    n = distance // 2 + 1
    cuts = [64 * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _variant_keys(prints: np.ndarray, distance: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(code, left-out bit or -1, masked segment) of every variant."""
    code = 0
    for first, width in segments(distance):
        part = (prints >> np.uint64(first)) & np.uint64((1 << width) - 1)
        yield code, -1, part
        code += 1
        for bit in range(width):
            yield code, first + bit, part & ~np.uint64(1 << bit)
            code += 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _index(distance: int, buckets: int):
    """Variants of distinct fingerprints as one row per batch and bucket, code and print packed."""

    def run(batches):
        for batch in batches:
            prints = batch.column("print").to_numpy().view(np.uint64)
            codes, copies, places = [], [], []
            for code, _, masked in _variant_keys(prints, distance):
                codes.append(np.full(len(prints), code, np.uint8))
                copies.append(prints)
                places.append(
                    (
                        _mix(masked + (np.uint64(code + 1) << np.uint64(40))) % np.uint64(buckets)
                    ).astype(np.int32)
                )
            if not len(prints):
                continue
            code, copy, place = np.concatenate(codes), np.concatenate(copies), np.concatenate(places)
            order = np.argsort(place, kind="stable")
            code, copy, place = code[order], copy[order], place[order]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1, [len(place)]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(place[cuts[:-1]]),
                    pa.array([code[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    pa.array([copy[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                ],
                names=["bucket", "codes", "prints"],
            )

    return run


def spanning_links(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what the links within `distance` connect, at most one less than the prints.

    A print found once is not compared again as a target, so a crowd of close
    prints costs little more than its size.
    """
    links, rest = [], prints
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            v = frontier.pop()
            near = np.bitwise_count(rest ^ v) <= distance
            if near.any():
                found = rest[near]
                links += [(int(v), int(u)) for u in found]
                frontier.extend(found)
                rest = rest[~near]
    return links


def _verify(distance: int):
    def run(batches):
        codes, prints = [], []
        for batch in batches:
            codes += [np.frombuffer(x, np.uint8) for x in batch.column("codes").to_pylist()]
            prints += [np.frombuffer(x, np.uint64) for x in batch.column("prints").to_pylist()]
        if not codes:
            return
        code, p = np.concatenate(codes), np.concatenate(prints)
        left_out, key = np.full(int(code.max()) + 1, -1), np.zeros(len(p), np.uint64)
        by_code = np.argsort(code, kind="stable")
        edges = np.searchsorted(code[by_code], np.arange(len(left_out) + 1))
        for k, bit, _ in _variant_keys(p[:0], distance):
            if k < len(left_out):
                left_out[k] = bit
        for k, (first, width) in _layout(distance).items():
            if k < len(left_out):
                own = by_code[edges[k] : edges[k + 1]]
                part = (p[own] >> np.uint64(first)) & np.uint64((1 << width) - 1)
                if left_out[k] >= 0:
                    part &= ~np.uint64(1 << (int(left_out[k]) - first))
                key[own] = part
        order = np.lexsort((p, key, code))
        code, key, p = code[order], key[order], p[order]
        cuts = np.flatnonzero((code[1:] != code[:-1]) | (key[1:] != key[:-1])) + 1
        cuts = np.concatenate([[0], cuts, [len(p)]])
        sizes = np.diff(cuts)
        two = cuts[:-1][sizes == 2]
        close = np.bitwise_count(p[two] ^ p[two + 1]) <= distance
        found = set(zip(p[two[close]].tolist(), p[two[close] + 1].tolist()))
        for at, n in zip(cuts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            group, bit = p[at : at + n], left_out[code[at]]
            if bit >= 0:
                ones = (group >> np.uint64(bit)) & np.uint64(1)
                if ones.all() or not ones.any():
                    continue  # the exact variant has these
            found.update(spanning_links(group, distance))
        links = np.array(sorted(found), np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

    return run


def _layout(distance: int) -> dict[int, tuple[int, int]]:
    """Segment of each code."""
    out, code = {}, 0
    for first, width in segments(distance):
        for _ in range(width + 1):
            out[code] = (first, width)
            code += 1
    return out


def links(distinct: DataFrame, distance: int = 3) -> DataFrame:
    """`a, b`: links between distinct prints that connect all prints within `distance`, verified.

    One shuffle of 9 bytes per variant, in as many partitions as keep them at
    `PARTITION_BYTES` or less. A task holds its share of the variants: distinct
    prints only, so copies of one text never meet as rows.
    """
    if not 0 <= distance <= 7:
        raise ValueError("distance must be from 0 to 7")
    variants = sum(width + 1 for _, width in segments(distance))
    parts = partitions_for(distinct.sparkSession, distinct.count() * variants * 9)
    index = distinct.select("print").mapInArrow(
        _index(distance, max(1024, 4 * parts)), "bucket int, codes binary, prints binary"
    )
    return spread(index, parts, "bucket").mapInArrow(_verify(distance), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id, digest, print, component_id, root` per row of `docs`.

    `component_id` is the smallest id that links reach, `root` a print that
    stands for the component. A null or empty text has print 0 and links like
    any other. Null ids stay null and are never the smallest; a component of
    null ids alone has a null `component_id`. Repeated rows are answered each.
    No rows give no rows; other columns are ignored.
    """
    prints = written(fingerprints(docs, shingle, id_col, text_col), "prints")
    distinct = written(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "prints")
    roots = connected_components(links(distinct, distance)).withColumnRenamed("node", "print")
    labelled = distinct.join(roots, "print", "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    named = join_on_key(labelled.select("print", "root"), least, "root", "inner")
    return join_on_key(prints, named, "print", "inner").select(
        "doc_id", "digest", "print", "component_id", "root"
    )


def one_per_group(
    docs: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All columns of one row of each component: that of its smallest id.

    Null ids come last; of equal ids with different texts, or of repeated rows, one stays.
    A null id in a struct equals another, and one key for both steps means that rows move once.
    """
    best = near_duplicates(docs, shingle, distance, id_col, text_col).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("best")
    )
    # one type on both sides, so that Spark compares the keys as they are
    kept = best.select(F.struct("best.doc_id", "best.digest").cast(KEY).alias("key"))
    key = F.struct(*id_and_digest(docs, id_col, text_col)).cast(KEY)
    rows = docs.select(F.struct("*").alias("row"), key.alias("key"))
    return rows.join(kept, "key", "left_semi").dropDuplicates(["key"]).select("row.*")

"""Language identification by cross-parsing.

A suffix automaton of labelled text per language finds the longest match of a
text at a place. Taking longest matches one after the other parses the text into
phrases; the language whose reference needs the fewest, normalised by the bits
of a phrase and the length of the text, wins.

Texts are parsed as bytes mapped to at most 64 classes (letters without regard
to ASCII case, the frequent other bytes of the references, one class for all
else), in pieces of `PIECE` bytes that no phrase crosses. All pieces of a block
of texts step through all automata at once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.rows import text_blocks, uniform

PIECE = 256
CLASSES = 64
#: Languages that step at once, and entries of the table of needs held at once.
GROUP = 64
NEEDS = 1 << 20
UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    classes: np.ndarray  # of each byte
    masks: np.ndarray  # of each state, the classes that lead on
    starts: np.ndarray  # of each state, the place of its first target
    targets: np.ndarray  # states by state and class
    roots: np.ndarray  # first state of each language
    bits: np.ndarray  # of one phrase in each language


def byte_classes(sample: bytes) -> np.ndarray:
    """Class of each byte: separators 0, letters 1 to 26, frequent high bytes, all else the last class."""
    classes = np.zeros(256, np.uint8)
    for k in range(26):
        classes[65 + k] = classes[97 + k] = 1 + k
    high = np.bincount(np.frombuffer(sample, np.uint8), minlength=256)[128:]
    classes[128:] = CLASSES - 1
    order = sorted(np.flatnonzero(high), key=lambda b: (-high[b], b))
    for k, b in enumerate(order[: CLASSES - 28]):
        classes[128 + b] = 27 + k
    return classes


def suffix_automaton(text: np.ndarray) -> np.ndarray:
    """Transitions of the suffix automaton of a sequence of classes, one row per state, -1 for none."""
    size = 2 * len(text) + 1
    step = np.full((size, CLASSES), -1, np.int32)
    link, length = [-1] * size, [0] * size
    n, last = 1, 0
    for c in text.tolist():
        cur, p = n, last
        n += 1
        length[cur] = length[last] + 1
        while p != -1 and step[p, c] == -1:
            step[p, c] = cur
            p = link[p]
        if p == -1:
            link[cur] = 0
        else:
            q = step[p, c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = n
                n += 1
                length[twin] = length[p] + 1
                step[twin] = step[q]
                link[twin] = link[q]
                while p != -1 and step[p, c] == q:
                    step[p, c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return step[:n]


def build(texts: dict[str, bytes]) -> LanguageModel:
    """A model of one reference text per language."""
    names = tuple(sorted(texts))
    classes = byte_classes(b"".join(texts[x] for x in names))
    masks, starts, targets, roots = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], []
    at = used = 0
    for name in names:
        step = suffix_automaton(classes[np.frombuffer(texts[name], np.uint8)])
        leads = step >= 0
        masks.append(np.packbits(leads, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64))
        sizes = leads.sum(axis=1)
        starts.append(used + np.cumsum(sizes) - sizes)
        targets.append((step[leads] + at).astype(np.int32))
        roots.append(at)
        at += len(step)
        used += int(sizes.sum())
    bits = np.array([math.log2(2 + len(texts[x])) for x in names])
    return LanguageModel(
        names, classes, np.concatenate(masks), np.concatenate(starts), np.concatenate(targets),
        np.array(roots, np.int64), bits,
    )


def _step(model: LanguageModel, state: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The states that classes lead to, or -1."""
    mask, bit = model.masks[state], np.uint64(1) << c
    at = model.starts[state] + np.bitwise_count(mask & (bit - np.uint64(1)))
    to = model.targets[np.minimum(at, len(model.targets) - 1)]
    return np.where(mask & bit, to, -1)


def train(
    docs: DataFrame, reference_bytes: int = 32 << 10, excerpt_bytes: int = 1024, total_bytes: int = 8 << 20,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> LanguageModel:
    """References from excerpts of rows with a non-null `lang`, taken by a hash of id and text.

    Every language is learned. Bounds: `reference_bytes` per language, or an equal
    share of `total_bytes` where that is less, from excerpts of `excerpt_bytes`
    letters at hashed places of the texts. A language with less text gets all it
    has. A null id, a null or an empty text teaches nothing.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where("id is not null and lang is not null and length(text) > 0")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not counts:
        return build({})
    size = max(1, min(reference_bytes, total_bytes // len(counts)))
    wanted = -(-8 * size // excerpt_bytes)
    # an Arrow table has a size that Spark knows, so it broadcasts it below its own threshold
    shares = docs.sparkSession.createDataFrame(
        pa.table({"lang": [r["lang"] for r in counts], "share": [min(1.0, wanted / r["n"]) for r in counts]})
    )
    place = F.pmod(F.xxhash64(F.lit("place"), "id"), F.greatest(F.length("text") - excerpt_bytes + 1, F.lit(1))) + 1
    order = ["rank", "id", "text"]
    before = Window.partitionBy("lang").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    excerpts = (
        rows.join(shares, "lang")
        .where(uniform(F.struct("id", "text")) < F.col("share"))
        .select("lang", "id", F.substr("text", place.cast("int"), F.lit(excerpt_bytes)).alias("text"))
        .distinct()
        .withColumn("rank", F.xxhash64("id", "text"))
        .withColumn("before", F.coalesce(F.sum(F.octet_length("text") + 1).over(before), F.lit(0)))
        .where(F.col("before") < size)
        .orderBy("lang", *order)
        .collect()
    )
    texts: dict[str, bytes] = {}
    for row in excerpts:
        have = texts.get(row["lang"], b"")
        texts[row["lang"]] = (have + b"\n" + row["text"].encode())[:size]
    return build(texts)


def phrases(model: LanguageModel, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of phrases of each text (row) in each language (column)."""
    sizes = np.diff(ends)
    parts = -(-sizes // PIECE)
    owner = np.repeat(np.arange(len(sizes)), parts)
    n, langs = len(owner), len(model.languages)
    out = np.zeros((len(sizes), langs))
    if not n:
        return out
    first = np.concatenate([[0], np.cumsum(parts)])[:-1]
    begin = ends[:-1][owner] + (np.arange(n) - first[owner]) * PIECE
    length = np.minimum(ends[1:][owner] - begin, PIECE)
    order = np.argsort(-length, kind="stable")
    begin, length, owner = begin[order], length[order], owner[order]
    longer = [int(np.searchsorted(-length, -k, side="left")) for k in range(int(length[0]))]
    for at in range(0, langs, GROUP):
        root = model.roots[at : at + GROUP, None]
        alone = _step(model, np.repeat(root, CLASSES, axis=1), np.arange(CLASSES, dtype=np.uint64)[None, :])
        found = np.zeros((len(root), n), np.int32)
        state = np.repeat(root, n, axis=1)
        for k, m in enumerate(longer):
            c = model.classes[data[begin[:m] + k]].astype(np.uint64)
            now = state[:, :m]
            to = _step(model, now, c[None, :])
            lost = to < 0
            if lost.any():
                again = alone[:, c.astype(np.int64)]
                unseen = lost & (again < 0)
                found[:, :m] += lost & (now != root)
                found[:, :m] += unseen
                to = np.where(lost, np.where(unseen, root, again), to)
            state[:, :m] = to
        found += state != root
        for k, row in enumerate(found):
            out[:, at + k] = np.bincount(owner, weights=row, minlength=len(sizes))
    return out


def classify(model: LanguageModel, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the best language and the score of each text: how much fewer bits it needs than the next."""
    langs, n = len(model.languages), len(ends) - 1
    best, score = np.zeros(n, np.int64), np.ones(n)
    if not langs:
        return best, score
    step = max(1, NEEDS // langs)
    for at in range(0, n, step):
        need = phrases(model, data, ends[at : at + step + 1]) * model.bits
        best[at : at + step] = need.argmin(axis=1)
        if langs > 1:
            least = np.partition(need, 1, axis=1)
            score[at : at + step] = 1 - least[:, 0] / np.maximum(least[:, 1], 1e-9)
    return best, score


def identify(
    docs: DataFrame,
    model: LanguageModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """`doc_id, lang_pred, score` per row, and the columns in `keep`.

    A null text, one without a letter and any text under a model without a
    language are `und` with score 0. Equal needs go to the first language in
    text order, with score 0. Repeated rows are answered each, a null id stays
    null, no rows give no rows. The model is broadcast: its size is bounded by
    the parameters of `train`, at most 44 bytes per byte of reference, so 350 MB
    for any number of languages, and 6 MB for four.
    """
    keep = keep or {}
    shared = docs.sparkSession.sparkContext.broadcast(model)
    chosen = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        *[c.alias(name) for name, c in keep.items()],
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("has_letter", F.col("text").rlike(r"\p{L}"))
    extras = list(keep)
    kinds = {f.name: f.dataType.simpleString() for f in chosen.schema.fields}

    def run(batches):
        model = shared.value
        names = [*model.languages, UNDETERMINED]
        for rows, data, ends in text_blocks(batches):
            best, score = classify(model, data, ends)
            sure = rows.column("has_letter").to_numpy(zero_copy_only=False).astype(bool) & bool(model.languages)
            best = np.where(sure, best, len(model.languages))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    *[rows.column(x) for x in extras],
                    pa.array(names).take(pa.array(best)),
                    pa.array(np.where(sure, score, 0.0)),
                ],
                names=["doc_id", *extras, "lang_pred", "score"],
            )

    extra = "".join(f", {name} {kinds[name]}" for name in extras)
    return chosen.mapInArrow(run, f"doc_id long{extra}, lang_pred string, score double")

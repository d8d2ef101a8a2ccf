import json
import pathlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daybook.llm import token_files
from tests.llm.corpus import bag, rows, table

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [(500, "A <|endoftext|>b<|startoftext|> c</s>"), (501, "ΑΣ é   \x85 漢字"), (502, "1. 2, ... a.b, c")]


def by_hand(pairs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    return [(d, library.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in pairs]


def in_order(pairs):
    return sorted(by_hand(pairs), key=lambda p: (p[0] is not None, p[0]))


@pytest.mark.parametrize("segment_ids", [1, 500, 4 << 20])
def test_round_trip(spark, tmp_path, segment_ids):
    pairs, folder = rows(21) + ODD, str(tmp_path / "ids")
    token_files.write_tokens(table(spark, pairs), WORDS, folder, segment_ids=segment_ids)
    found = sorted(token_files.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    want = by_hand(pairs)
    got = [(r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in found]
    assert bag(got) == bag(want)
    assert [d for d, _ in got] == [d for d, _ in in_order(pairs)]
    at = 0
    for r, (_, ids) in zip(found, got):
        assert (r.start, r.n_tokens) == (at, len(ids))
        at += len(ids)
    listed = token_files.manifest(folder)
    assert listed["ids"] == at and sum(f["docs"] for f in listed["files"]) == len(pairs)
    assert listed["files"][1]["before"] == listed["files"][0]["ids"]


def test_any_token_is_found(spark, tmp_path):
    folder = str(tmp_path / "ids")
    token_files.write_tokens(table(spark, rows(22)), WORDS, folder, segment_ids=300)
    read = sorted(token_files.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    flat = np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in read]).tolist()
    asked = [None, -1, len(flat), 0, 0, len(flat) - 1, *range(0, len(flat), 97)]
    positions = spark.createDataFrame([(p, 1) for p in asked], "position long, token int").repartition(3)
    want = [(p, flat[p] if p is not None and 0 <= p < len(flat) else None) for p in asked]
    assert bag(map(tuple, token_files.tokens_at(positions, folder).collect())) == bag(want)


def test_empty_and_very_long(spark, tmp_path):
    folder = str(tmp_path / "none")
    token_files.write_tokens(table(spark, []), WORDS, folder)
    assert token_files.read_tokens(spark, folder).collect() == []
    nothing = spark.createDataFrame([(0,)], "position long")
    assert token_files.tokens_at(nothing, folder).collect()[0].token is None
    long = [(2, "one two " * 400_000), (1, None), (1, None), (0, "x" * 300_000)]
    token_files.write_tokens(table(spark, long), WORDS, str(tmp_path / "long"))
    found = token_files.read_tokens(spark, str(tmp_path / "long")).collect()
    want = [(d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, ids in by_hand(long)]
    assert bag((r.doc_id, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in found) == bag(want)


def test_one_id_fills_many_files(spark, tmp_path):
    pairs = [(7, f"text {k}") for k in range(100)] + [(7, "same")] * 100 + [(k, "other") for k in range(100)]
    token_files.write_tokens(table(spark, pairs), WORDS, str(tmp_path / "ids"))
    files = token_files.manifest(str(tmp_path / "ids"))["files"]
    assert max(f["docs"] for f in files) < 100 and sum(f["docs"] for f in files) == 300


def test_files_of_failed_attempts_do_not_count(spark, tmp_path):
    folder = tmp_path / "ids"
    token_files.write_tokens(table(spark, rows(23)), WORDS, str(folder))
    before = bag(map(tuple, token_files.read_tokens(spark, str(folder)).collect()))
    (folder / "part-000000-broken.tok").write_bytes(b"half a file")
    assert bag(map(tuple, token_files.read_tokens(spark, str(folder)).collect())) == before
    with pytest.raises(Exception, match="holds token ids already"):
        token_files.write_tokens(table(spark, rows(23)), WORDS, str(folder))


def test_changed_bytes_are_noticed(spark, tmp_path):
    folder = tmp_path / "ids"
    token_files.write_tokens(table(spark, rows(24)), WORDS, str(folder))
    name = json.loads((folder / token_files.MANIFEST).read_text())["files"][0]["name"]
    raw = bytearray((folder / name).read_bytes())
    raw[40] ^= 1
    pathlib.Path(folder / name).write_bytes(raw)
    with pytest.raises(ValueError, match="checksum"):
        token_files.TokenFile(str(folder / name)).whole_segment(0)


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_levels_give_any_range(data):
    n = data.draw(st.sampled_from([0, 1, 8, 511, 512, 513, 1500]))
    rng = np.random.default_rng(data.draw(st.integers(0, 1000)))
    top = data.draw(st.sampled_from([1, 256, 257, 65536, 1 << 24, 1 << 32]))
    ids = (rng.integers(0, top, n, dtype=np.uint64) >> rng.integers(0, 17, n, dtype=np.uint64)).astype(np.uint32)
    raw, record = token_files.segment([None, -5], np.array([n // 3, n - n // 3]), ids)
    reads = []

    def read(at, size):
        reads.append(size)
        return raw[at : at + size]

    part = token_files.Segment(record[0], read)
    numbers, starts = part.documents()
    assert numbers == [None, -5] and starts.tolist() == [0, n // 3, n]
    a = data.draw(st.integers(0, n))
    b = data.draw(st.integers(a, n))
    assert part.ids(a, b).tolist() == ids[a:b].tolist() and part.ids(0, n).tolist() == ids.tolist()
    if n:
        reads.clear()
        at = data.draw(st.integers(0, n - 1))
        assert part.ids(at, at + 1).tolist() == [ids[at]]
        assert sum(reads) <= 4 * (1 + 1 + 4 + 64)  # a chunk, its mark, an entry and a block of marks per level

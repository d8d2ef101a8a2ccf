import os
import subprocess
import sys

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from daybook.llm import decontamination, packing, queries, simhash, substring_dedup
from daybook.llm.rows import read_table
from tests.llm.corpus import bag
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_queries_are_registered():
    numbers = [name.split("_")[0] for name in queries.QUERIES]
    assert numbers == [f"op{n}" for n in range(1, 14)]
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(queries.ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, name):
    assert compare(spark, connect(SF), queries.QUERIES[name], queries.ORACLES[name], SF) == []


@pytest.mark.parametrize("name,columns", [
    (
        "op1_substring_dedup",
        {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    ),
    ("op2_simhash_dedup", {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}),
    (
        "op3_token_counts",
        {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    ),
    ("op4_language_id", {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}),
    ("op5_quality", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    (
        "op6_packing",
        {
            "doc_id": "bigint",
            "start": "bigint",
            "length": "bigint",
            "ids_crc32": "bigint",
            "doc_tokens": "bigint",
            "sequence_id": "bigint",
            "offset": "bigint",
        },
    ),
    ("op7_decontamination", {"doc_id": "bigint", "item_id": "bigint", "distance": "int"}),
    (
        "op8_suffix_dedup",
        {
            "doc_id": "bigint",
            "n_bytes": "bigint",
            "n_removed": "bigint",
            "n_spans": "bigint",
            "kept_sha256": "string",
        },
    ),
    (
        "op9_url_filter",
        {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    ),
    ("op10_nearest", {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}),
    (
        "op11_fill_in_middle",
        {
            "doc_id": "bigint",
            "n": "bigint",
            "form": "string",
            "prefix_chars": "bigint",
            "middle_chars": "bigint",
            "output_sha256": "string",
            "restored_sha256": "string",
        },
    ),
    (
        "op12_whitening",
        {
            "vec_id": "bigint",
            "component": "int",
            "n": "bigint",
            "deviation": "bigint",
            "whitened": "double",
            "explained": "double",
            "identity_error": "double",
        },
    ),
    (
        "op13_token_files",
        {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    ),
])
def test_query_columns_and_rows(spark, name, columns):
    found = queries.QUERIES[name](spark, SF)
    kinds = dict(found.dtypes)
    assert {c: kinds[c] for c in columns} == columns
    rows = found.collect()
    documents = read_table(spark, SF, "documents").count()
    if "doc_id" in columns and name not in ("op6_packing", "op7_decontamination"):
        assert len(rows) == documents == len({r.doc_id for r in rows})
    assert rows


def test_pipeline_takes_effect(spark):
    """Each stage against its operator applied by hand to what the one before it kept."""
    docs = read_table(spark, SF, "documents").cache()
    columns = docs.columns
    good = corpus_pipeline.good_documents(spark, docs, SF).cache()
    assert good.columns == columns and 0.8 * docs.count() < good.count() < docs.count()
    single = corpus_pipeline.one_of_near_copies(spark, good, SF).cache()
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(good).collect()}
    assert bag(r.doc_id for r in single.collect()) == bag(set(groups.values()))
    cut = corpus_pipeline.without_repeated_passages(spark, single, SF).cache()
    removed = {r.doc_id: r.kept for r in substring_dedup.remove_repeats(single).collect()}
    assert cut.columns == columns and {r.doc_id: r.text for r in cut.collect()} == removed
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    clean = corpus_pipeline.without_benchmark(spark, cut, SF).cache()
    leaks = {r.doc_id for r in decontamination.contaminated(cut, read_table(spark, SF, "benchmark")).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in cut.collect()} - leaks
    final = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in final} == {r.doc_id for r in clean.collect()}
    by_hand = corpus_pipeline.packed(spark, clean, SF).collect()
    assert sum(p.length for p in final) == sum(p.length for p in by_hand)
    assert {p.doc_id: p.doc_tokens for p in final} == {p.doc_id: p.doc_tokens for p in by_hand}
    assert packing.DDL.startswith("doc_id long")


def test_rest_works_without_the_subpackage():
    code = (
        "import sys\n"
        "class Missing:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('daybook.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Missing())\n"
        "import __spark_entry__ as e\n"
        "assert not [n for n in e.queries() if n.startswith('op') or n == 'pipeline']\n"
        "assert 'category_daily_kpi' in e.queries() and e.oracle_sql()\n"
    )
    top = os.path.dirname(os.path.abspath(contract.__file__))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=top, timeout=120)

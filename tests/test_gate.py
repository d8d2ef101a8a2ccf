import csv
import datetime as dt
import functools
import io
import json
import pathlib
import random
import urllib.parse

import pytest
from pyspark.sql import functions as F

from daybook.operators.gate import HIDDEN
from daybook.plans import gate_run
from daybook.plans.gate_run import file_endings, judge, list_incoming, quarantine, run_gate
from daybook.plans.workspace import Workspace
from daybook.sources import files
from daybook.operators.records import OPEN_QUOTE, TOO_LONG
from daybook.sources.files import record_problems, stored_records, write_records
from daybook.schemas import CLEAN_ROWS, GATE_LOG
from tests.conftest import as_rows
from tests.landing import golden_workspace, put
from tests.planning import final_tree

DAY = dt.date(2025, 7, 6)
HEADER = "order_id,user_id,created_at,status,num_of_item"
ROW = "{},10,2025-07-06 09:00:00,complete,2"
FILES = {
    "good": f"{HEADER}\n{ROW.format(1)}\n{ROW.format(2)}\n",
    "reordered_extra": "status,note,num_of_item,created_at,user_id,order_id\n"
    "complete,hi,4,2025-07-06,11,3\n",
    "missing": "order_id,created_at,status,num_of_item\n1,2025-07-06,complete,2\n",
    "header_only": f"{HEADER}\n",
    "zero": "",
    "blank": "\n  \n",
    "too_many_fields": f"{HEADER}\n{ROW.format(1)}\n{ROW.format(1)},extra\n",
    "wide_first_row": f"{HEADER}\n{ROW.format(11)},extra\n{ROW.format(12)}\n",
    "wide_first_and_wider": f"{HEADER}\n{ROW.format(11)},extra\n{ROW.format(12)},extra,more\n",
    "trailing_commas": f"{HEADER}\n{ROW.format(4)},\n{ROW.format(5)},\n",
    "too_few_fields": f"{HEADER}\n6,10,2025-07-06,complete\n",
    "quoted_newline": f'{HEADER}\n7,"1\n0",2025-07-06,complete,1\n',
    "quoted_newline_ragged": f'{HEADER}\n7,"1\n0",2025-07-06,complete,1\n8,1,2025-07-06,c,1,9\n',
    "quoted_comma": f'{HEADER}\n8,"1,0",2025-07-06,complete,1\n',
    "bom": b"\xef\xbb\xbf" + f"{HEADER}\r\n{ROW.format(9)}\r\n".encode(),
    "bad_utf8": HEADER.encode() + b"\n1,\xff\xfe,2025-07-06,complete,1\n",
    "bad_utf8_quoted": HEADER.encode() + b'\n1,"\n\xff\xfe",2025-07-06,complete,1\n',
    "case": f"{HEADER.replace('order_id', 'Order_ID')}\n{ROW.format(1)}\n",
    "space": f"{HEADER.replace('order_id', ' order_id ')}\n{ROW.format(1)}\n",
    "dup_header": f"{HEADER},order_id\n{ROW.format(1)},1\n",
    "names [1]{a} 50% + more": f"{HEADER}\n{ROW.format(10)}\n",
    "blank_inside": f'{HEADER}\r\n\r\n13,"u\r\n\r\nv",2025-07-06,complete,1\r\n   \r\n\r\n14,10,2025-07-06,complete,1',
    "open_quote": f'{HEADER}\n15,10,2025-07-06,complete,1\n16,"10,2025-07-06,complete,1\n17,10,x,y,1\n',
    "_late": f"{HEADER}\n{ROW.format(1)}\n",
    ".dotted": "",
}
VERDICTS = {
    "good": ("valid", None, 2),
    "reordered_extra": ("valid", None, 1),
    "missing": ("missing_columns", ["user_id"], 1),
    "header_only": ("empty", None, 0),
    "zero": ("unreadable", None, 0),
    "blank": ("unreadable", None, 0),
    "too_many_fields": ("unreadable", None, 2),
    "wide_first_row": ("valid", None, 2),
    "wide_first_and_wider": ("unreadable", None, 2),
    "trailing_commas": ("valid", None, 2),
    "too_few_fields": ("valid", None, 1),
    "quoted_newline": ("valid", None, 1),
    "quoted_newline_ragged": ("unreadable", None, 2),
    "quoted_comma": ("valid", None, 1),
    "bom": ("valid", None, 1),
    "bad_utf8": ("unreadable", None, 1),
    "bad_utf8_quoted": ("unreadable", None, 1),
    "case": ("missing_columns", ["order_id"], 1),
    "space": ("missing_columns", ["order_id"], 1),
    "dup_header": ("missing_columns", ["order_id"], 1),
    "names [1]{a} 50% + more": ("valid", None, 1),
    "blank_inside": ("valid", None, 2),
    "open_quote": ("unreadable", None, 1),
    "_late": ("unreadable", None, 0),
    ".dotted": ("unreadable", None, 0),
}


def file_stem(uri):
    return pathlib.Path(urllib.parse.unquote(uri)).stem


@pytest.fixture(scope="module")
def gated(spark, tmp_path_factory):
    workspace = Workspace(str(tmp_path_factory.mktemp("gate")))
    for name, content in FILES.items():
        put(workspace, f"incoming/orders/deep/{name}.csv", content)
    put(workspace, "incoming/orders/notes.txt", "not a csv")
    verdicts = run_gate(spark, workspace, DAY, "run1").collect()
    return workspace, {file_stem(v["path"]): v for v in verdicts}


def test_every_csv_is_judged(gated):
    assert set(gated[1]) == set(FILES)


@pytest.mark.parametrize("name", FILES)
def test_verdict(gated, name):
    row = gated[1][name]
    assert (row["verdict"], row["missing"], row["n_rows"]) == VERDICTS[name]


def test_problems_are_named(gated):
    problems = {name: sorted(row["problems"]) for name, row in gated[1].items()}
    assert problems["too_many_fields"] == ["too many fields"]
    assert problems["bad_utf8"] == problems["bad_utf8_quoted"] == ["not utf-8"]
    assert problems["zero"] == problems["blank"] == ["no lines"]
    assert problems["_late"] == problems[".dotted"] == ["hidden from readers by its name"]
    assert problems["good"] == []


def test_rows_of_valid_files_are_kept(spark, gated):
    workspace, _ = gated
    rows = spark.read.schema(CLEAN_ROWS["orders"]).parquet(workspace.clean("orders"))
    assert as_rows(rows, "order_id", "user_id", "order_date", "status", "num_of_item") == [
        ("1", "10", DAY, "complete", 2),
        ("10", "10", DAY, "complete", 2),
        ("11", "10", DAY, "complete", 2),
        ("12", "10", DAY, "complete", 2),
        ("13", "u\n\nv", DAY, "complete", 1),
        ("14", "10", DAY, "complete", 1),
        ("2", "10", DAY, "complete", 2),
        ("3", "11", DAY, "complete", 4),
        ("4", "10", DAY, "complete", 2),
        ("5", "10", DAY, "complete", 2),
        ("6", "10", DAY, "complete", None),
        ("7", "1\n0", DAY, "complete", 1),
        ("8", "1,0", DAY, "complete", 1),
        ("9", "10", DAY, "complete", 2),
    ]
    keys = rows.select("dt", "run_id", "order_month").distinct().collect()
    assert [tuple(k) for k in keys] == [(DAY, "run1", "2025-07")]


def test_archive_gives_files_back(spark, gated):
    workspace, _ = gated
    archive = spark.read.parquet(workspace.archive)
    stored = {}
    ordered = archive.orderBy("source_file", "block_start", "line_id").collect()
    for row in ordered:
        stored.setdefault(file_stem(row["source_file"]), []).append(row["value"])
    judged = {n for n, v in VERDICTS.items() if v[0] in ("valid", "missing_columns")}
    assert set(stored) == judged
    log = spark.read.schema(GATE_LOG).parquet(workspace.gate_log)
    for row in file_endings(archive, log).collect():
        name = file_stem(row["source_file"])
        content = "\n".join(stored.pop(name)) + "\n" * row["ends_with_break"]
        given_back = b"\xef\xbb\xbf" * row["has_mark"] + content.encode()
        original = FILES[name]
        assert given_back == (original if isinstance(original, bytes) else original.encode())
    assert not stored
    files, lines = quarantine(spark, workspace)
    failed = {n for n, v in VERDICTS.items() if v[0] == "missing_columns"}
    assert {file_stem(r["path"]) for r in files.collect()} == failed
    assert {file_stem(r["source_file"]) for r in lines.collect()} == failed
    verdicts = {r["verdict"] for r in archive.select("verdict").distinct().collect()}
    assert verdicts == {"valid", "missing_columns"}


def test_manifest(gated):
    workspace, verdicts = gated
    folder = pathlib.Path(workspace.manifests) / f"dt={DAY}"
    lines = "".join(p.read_text() for p in folder.glob("part-*")).splitlines()
    entries = [json.loads(line) for line in lines]
    valid = sorted(n for n, v in VERDICTS.items() if v[0] == "valid")
    assert {entry["file_type"] for entry in entries} == {"orders"}
    keys = sorted(entry["file_key"] for entry in entries)
    assert keys == sorted(f"validated/orders/dt={DAY}/{n}.csv" for n in valid)


@pytest.mark.parametrize("seed", range(4))
def test_records_of_split_files(spark, tmp_path, seed):
    """Records with line breaks are those of Python's reader, however the file is cut into blocks."""
    rng = random.Random(seed)
    values = ["a", "", '"x\ny"', '"\n"', '"p ""q"" \n\n r"', '"\n""\n"', 'in"side', '""', '"z, w"', '"one\ntwo\nthree"']
    text = "".join(",".join(rng.choice(values) for _ in range(3)) + "\n" for _ in range(400))
    path = put(Workspace(str(tmp_path)), "r.csv", text)
    limits = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "0"}
    before = {key: spark.conf.get(key) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        write_records(spark, [str(path)], str(tmp_path / "out"))
        records = stored_records(spark, str(tmp_path / "out")).orderBy("block_start", "line_id").collect()
        blocks = len({r["block_start"] for r in records})
        assert record_problems(spark, str(tmp_path / "out")).count() == 0
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert blocks > 5
    wanted = [row for row in csv.reader(io.StringIO(text)) if any(field.strip() for field in row) or len(row) > 1]
    assert [next(csv.reader(io.StringIO(r["value"], newline=""))) for r in records] == wanted


def test_hidden_folders_are_listed(spark, tmp_path):
    workspace = Workspace(str(tmp_path))
    for name in ("a.csv", "_x/b.csv", "p/q/_c.csv", "p/.r/s/d.csv", "p/_e.txt"):
        put(workspace, f"incoming/orders/{name}", FILES["good"])
    verdicts = run_gate(spark, workspace, DAY, "run1").collect()
    found = {row["path"].rsplit("/orders/", 1)[1]: (row["verdict"], row["problems"]) for row in verdicts}
    hidden = ("unreadable", [HIDDEN])
    assert found == {"a.csv": ("valid", []), "_x/b.csv": hidden, "p/q/_c.csv": hidden, "p/.r/s/d.csv": hidden}


def test_a_file_that_goes_does_not_stop_the_others(spark, tmp_path):
    workspace = golden_workspace(tmp_path)
    gone = put(workspace, "incoming/orders/gone.csv", FILES["good"])
    put(workspace, "incoming/orders/gone2.csv", FILES["good"])
    listed = list_incoming(spark, workspace)
    listed.write.parquet(str(tmp_path / "listed"))
    gone.unlink()
    verdicts = judge(spark, spark.read.parquet(str(tmp_path / "listed")), DAY, "r", workspace.staging("r"))
    found = {pathlib.Path(r["path"]).name: r["verdict"] for r in verdicts.collect()}
    assert found == {"batch1.csv": "valid", "gone.csv": "unreadable", "gone2.csv": "valid"}


def test_the_archive_shuffles_nothing(spark, tmp_path):
    workspace = golden_workspace(tmp_path)
    lines = gate_run.read_raw_lines(spark, [str(tmp_path / "incoming/orders/batch1.csv")])
    assert "Exchange" not in lines._jdf.queryExecution().executedPlan().toString()
    run_gate(spark, workspace, DAY, "run1")
    stored = spark.read.parquet(workspace.archive)
    assert stored.where("file_type = 'orders'").count() == 5


def test_landed_files_stay(gated):
    workspace, _ = gated
    landed = pathlib.Path(workspace.incoming("orders"))
    assert len([p for p in landed.rglob("*") if p.suffix == ".csv"]) == len(FILES)


def test_judged_files_are_not_judged_again(spark, tmp_path):
    workspace = golden_workspace(tmp_path)
    put(workspace, "incoming/orders/later.csv", "")
    first = run_gate(spark, workspace, DAY, "run1")
    assert as_rows(first, "verdict", "file_type") == [
        ("unreadable", "orders"),
        ("valid", "order_items"),
        ("valid", "orders"),
    ]
    put(workspace, "incoming/orders/later.csv", FILES["good"])
    second = run_gate(spark, workspace, DAY, "run2")
    assert [pathlib.Path(r["path"]).name for r in second.collect()] == ["later.csv"]
    assert second.first()["verdict"] == "valid"
    assert run_gate(spark, workspace, DAY, "run3").count() == 0


def test_nothing_landed(spark, tmp_path):
    workspace = Workspace(str(tmp_path))
    assert run_gate(spark, workspace, DAY, "run1").count() == 0
    assert not pathlib.Path(workspace.manifests).exists()


def test_no_manifest_without_a_valid_file(spark, tmp_path):
    workspace = Workspace(str(tmp_path))
    put(workspace, "incoming/orders/a.csv", FILES["missing"])
    run_gate(spark, workspace, DAY, "run1")
    assert not pathlib.Path(workspace.manifests).exists()
    log = spark.read.schema(GATE_LOG).parquet(workspace.gate_log)
    assert as_rows(log, "verdict", "missing") == [("missing_columns", ["user_id"])]


def test_header_is_found_in_split_files(spark, tmp_path):
    """A file read in many pieces has the same profile as one read whole."""
    workspace = Workspace(str(tmp_path))
    rows = "\n".join(ROW.format(i) for i in range(20_000))
    put(workspace, "incoming/orders/big.csv", f"{HEADER}\n{rows}\n")
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        verdict = run_gate(spark, workspace, DAY, "run1").first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    assert (verdict["verdict"], verdict["n_rows"]) == ("valid", 20_000)
    assert verdict["header"] == HEADER.split(",")
    kept = spark.read.schema(CLEAN_ROWS["orders"]).parquet(workspace.clean("orders"))
    assert kept.agg(F.countDistinct("order_id")).first()[0] == 20_000


def test_lines_of_an_open_quote_are_not_gathered(spark, tmp_path, monkeypatch):
    """A quote that is never closed may reach over the rest of a large file, which must not become one row."""
    path = tmp_path / "open.csv"
    rows = [ROW.format(i) for i in range(30)] + ['30,"1\n0",2025-07-06,complete,1'] * 5
    swallowed = [f"{i},swallowed,2025-07-06,complete,1" for i in range(200)]
    path.write_text("\n".join([HEADER, *rows, '99,"never closed', *swallowed]))
    gather = F.collect_list
    monkeypatch.setattr(
        F,
        "collect_list",
        lambda line: gather(
            F.when(F.contains(line["value"], F.lit("swallowed")), F.raise_error(F.lit("gathered"))).otherwise(line)
        ),
    )
    limits = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in limits}
    for name, limit in limits.items():
        spark.conf.set(name, limit)
    try:
        write_records(spark, [str(path)], str(tmp_path / "out"))
        records = stored_records(spark, str(tmp_path / "out")).orderBy("block_start", "line_id").collect()
        assert [r["value"] for r in records] == [HEADER, *rows]
        assert [r["found"] for r in record_problems(spark, str(tmp_path / "out")).collect()] == [[OPEN_QUOTE]]
    finally:
        for name, limit in before.items():
            spark.conf.set(name, limit)


def test_a_record_that_is_too_long_makes_its_file_unreadable(spark, tmp_path, monkeypatch):
    """A closed record over the limit is not put together; other files and records are."""
    workspace = Workspace(str(tmp_path))
    long = '1,"' + "\n".join(["x" * 90] * 50) + '",2025-07-06,complete,1'
    both = [ROW.format(2), long, '3,"a\nb",2025-07-06,complete,1', long, '4,"never closed']
    put(workspace, "incoming/orders/long.csv", "\n".join([HEADER, ROW.format(2), long, ROW.format(3)]) + "\n")
    put(workspace, "incoming/orders/both.csv", "\n".join([HEADER, *both]) + "\n")
    put(workspace, "incoming/orders/short.csv", f'{HEADER}\n5,"a\nb",2025-07-06,complete,1\n')
    monkeypatch.setattr(gate_run, "write_records", functools.partial(write_records, limit=4000))
    limits = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in limits}
    for name, limit in limits.items():
        spark.conf.set(name, limit)
    try:
        found = {file_stem(r["path"]): r for r in run_gate(spark, workspace, DAY, "run1").collect()}
    finally:
        for name, limit in before.items():
            spark.conf.set(name, limit)
    assert {n: (r["verdict"], r["problems"]) for n, r in found.items()} == {
        "long": ("unreadable", [TOO_LONG]),
        "both": ("unreadable", [OPEN_QUOTE, TOO_LONG]),
        "short": ("valid", []),
    }
    kept = spark.read.parquet(workspace.clean("orders"))
    assert [(r["order_id"], r["user_id"]) for r in kept.collect()] == [("5", "a\nb")]


def test_files_with_line_breaks_are_scanned_twice_for_their_records(spark, tmp_path, monkeypatch):
    """Whatever needs records reads the written ones: profile, rows of uneven files and typing."""
    workspace = Workspace(str(tmp_path))
    put(workspace, "incoming/orders/a.csv", FILES["quoted_newline"])
    put(workspace, "incoming/orders/b.csv", FILES["quoted_newline_ragged"])
    read, scanned = files.read_all_lines, []
    monkeypatch.setattr(files, "read_all_lines", lambda spark, paths: scanned.append(len(paths)) or read(spark, paths))
    run_gate(spark, workspace, DAY, "run1")
    assert scanned == [2]
    work = f"{workspace.staging('run1')}/gate/multiline"
    lines = read(spark, [f"{tmp_path}/incoming/orders/a.csv"])
    tree = final_tree(files.assemble_records(lines, spark.read.parquet(f"{work}/states"), 4000))
    assert tree.count("Scan text") == 1 and "Reused" in tree

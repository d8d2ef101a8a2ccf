"""Verdicts of random small files against pandas, which sees each file whole."""

import datetime as dt
import io
import random

import pandas as pd
import pytest

from daybook.plans.gate_run import run_gate
from daybook.plans.workspace import Workspace
from daybook.schemas import REQUIRED_COLUMNS
from tests.landing import put
from tests.test_gate import file_stem

REQUIRED = REQUIRED_COLUMNS["orders"]
# Leaves out a required column given twice: there the gate is stricter on purpose.
VALUES = ["1", "", "2025-07-06", "a b", '"x,y"', '"say ""hi"""', '5" wide', "é", " ", '""']


def random_file(rng: random.Random) -> bytes:
    header = REQUIRED.copy()
    rng.shuffle(header)
    for _ in range(rng.choice([0, 0, 0, 1, 2])):
        header.insert(rng.randrange(len(header) + 1), f"extra{rng.randrange(99)}")
    change = rng.random()
    if change < 0.1:
        header.pop(rng.randrange(len(header)))
    elif change < 0.15:
        header[0] = header[0].upper()
    elif change < 0.2:
        header[0] = f" {header[0]}"
    elif change < 0.3:
        header = [f'"{name}"' for name in header]
    lines = [",".join(header)]
    trailing = rng.random() < 0.05
    for number in range(rng.choice([0, 1, 1, 2, 3, 8])):
        row = ["7"] + [rng.choice(VALUES) for _ in header[1:]]
        if rng.random() < 0.05:
            row[rng.randrange(len(row))] = '"two\nlines"'
        if rng.random() < 0.05:
            row = row[: rng.randrange(1, len(row))]
        if rng.random() < 0.05:
            row.append("more")
        lines.append(",".join(row) + ("," if trailing else ""))
        if rng.random() < 0.1:
            lines.append(rng.choice(["", "  "]))
    text = rng.choice(["\n", "\n", "\r\n"]).join(lines)
    if rng.random() < 0.8:
        text += "\n"
    content = text.encode()
    if rng.random() < 0.05:
        content = b"\xef\xbb\xbf" + content
    if rng.random() < 0.05:
        content += b"\xff,1\n"
    return rng.choice([content] * 20 + [b"", b"\n\n"])


def expected(content: bytes) -> str:
    try:
        frame = pd.read_csv(io.StringIO(content.decode("utf-8")))
    except Exception:
        return "unreadable"
    if frame.empty:
        return "empty"
    return "valid" if set(REQUIRED) <= set(frame.columns) else "missing_columns"


@pytest.mark.parametrize("seed", [1, 2, 4])
def test_verdicts_agree(spark, tmp_path, seed):
    rng = random.Random(seed)
    contents = {f"f{i:03}": random_file(rng) for i in range(250)}
    workspace = Workspace(str(tmp_path))
    for name, content in contents.items():
        put(workspace, f"incoming/orders/{name}.csv", content)
    verdicts = run_gate(spark, workspace, dt.date(2025, 7, 6), "r")
    found = {file_stem(row["path"]): row["verdict"] for row in verdicts.collect()}
    wanted = {name: expected(content) for name, content in contents.items()}
    assert len(set(wanted.values())) == 4
    different = {n: (found[n], wanted[n], contents[n]) for n in contents if found[n] != wanted[n]}
    assert different == {}


@pytest.mark.parametrize("seed", [3, 5])
def test_rows_agree(spark, tmp_path, seed):
    """The kept rows of the valid files are those pandas reads."""
    rng = random.Random(seed)
    workspace = Workspace(str(tmp_path))
    wanted = []
    for i in range(150):
        content = random_file(rng)
        put(workspace, f"incoming/orders/f{i:03}.csv", content)
        if expected(content) == "valid":
            text = content.decode()
            frame = pd.read_csv(
                io.StringIO(text), dtype=str, keep_default_na=False, index_col=False
            )
            wanted += [
                (f"f{i:03}", *(value.replace("\r\n", "\n") or None for value in row))
                for row in frame[["order_id", "user_id", "status"]].fillna("").values
            ]
    run_gate(spark, workspace, dt.date(2025, 7, 6), "r")
    rows = spark.read.parquet(workspace.clean("orders"))
    found = [
        (file_stem(r["source_file"]), r["order_id"], r["user_id"], r["status"])
        for r in rows.collect()
    ]
    assert sorted(found, key=str) == sorted(wanted, key=str)

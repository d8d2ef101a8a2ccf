"""Reading executed plans."""

import re


def executed_plan(df) -> str:
    """Formatted plan; for adaptive plans the final one if `df` was run before."""
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return text


def final_tree(df) -> str:
    """The operator tree after adaptive execution."""
    df.collect()
    text = executed_plan(df)
    start = text.find("== Final Plan ==")
    end = text.find("== Initial Plan ==")
    return text[start:end] if start >= 0 else text


def scans(df) -> list[dict[str, str]]:
    """The properties of every file scan."""
    found = []
    for block in re.split(r"\n\(\d+\) ", executed_plan(df)):
        if block.startswith("Scan parquet"):
            lines = (line.split(": ", 1) for line in block.splitlines() if ": " in line)
            properties = {key: value for key, value in lines}
            found.append(
                {
                    key: properties.get(key, "")
                    for key in ("PartitionFilters", "PushedFilters", "ReadSchema")
                }
            )
    return found

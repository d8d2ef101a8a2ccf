"""The JSON manifest of the files that passed the gate on a day."""

from pyspark.sql import DataFrame

MANIFEST = "file_type string, file_key string, path string"


def write_manifest(valid: DataFrame, folder: str, dt: str) -> str | None:
    """Write `<folder>/dt=<day>`, replacing an earlier one; nothing without valid files.

    One line per file, whatever their number.
    """
    if valid.isEmpty():
        return None
    path = f"{folder}/dt={dt}"
    entries = valid.select("file_type", "file_key", "path")
    entries.hint("rebalance").write.mode("overwrite").json(path)
    return path

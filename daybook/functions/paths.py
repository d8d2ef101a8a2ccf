"""Expressions on file paths and keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.schemas import PROCESSED, VALIDATED


def reported_path(path) -> Column:
    """A listed path in the form in which a scan reports the file of a row.

    That form is a percent-encoded URI. It is what rows, profiles and verdicts
    carry, because it costs nothing per row; `plain_path` decodes it once per file.
    """
    return F.regexp_replace(path, "^file:/+", "file:/")


def plain_path(reported) -> Column:
    """The path as a reader takes it, from the reported form."""
    reported = F.col(reported) if isinstance(reported, str) else reported
    return F.url_decode(F.replace(reported, F.lit("+"), F.lit("%2B")))


def base_name(path) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dated_key(stage: str, file_type, dt, path) -> Column:
    """`<stage><type>/dt=<day>/<file name>`."""
    return F.concat(
        F.lit(stage),
        file_type,
        F.lit("/dt="),
        F.date_format(dt, "yyyy-MM-dd"),
        F.lit("/"),
        base_name(path),
    )


def processed_key(key) -> Column:
    """Key of a file once its KPIs are written: every `validated/` becomes `processed/`."""
    return F.replace(key, F.lit(VALIDATED), F.lit(PROCESSED))

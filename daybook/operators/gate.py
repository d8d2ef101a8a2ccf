"""File profiles and verdicts."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.csv_lines import field_count, has_open_quote, header_names
from daybook.functions.paths import dated_key, plain_path
from daybook.operators.joins import join_on_key
from daybook.schemas import EMPTY, MISSING_COLUMNS, REQUIRED_COLUMNS, UNREADABLE, VALID, VALIDATED

NOT_UTF8 = "not utf-8"
NO_LINES = "no lines"
HIDDEN = "hidden from readers by its name"


def profile_lines(lines: DataFrame) -> DataFrame:
    """One row per file: header, number of rows, and what is wrong with its text.

    `lines` has path, block_start, line_id and value. Partial results are a few
    values per file and task, however large the files are. `uneven` files have
    rows of more fields than the header, and not all rows have the same number;
    whether that is a problem depends on the first row, see `ragged_files`.
    """
    return (
        lines.withColumn("_fields", field_count(F.col("value")))
        .groupBy("path")
        .agg(
            F.min_by("value", F.struct("block_start", "line_id")).alias("_header"),
            F.count("*").alias("_lines"),
            F.max("_fields").alias("_widest"),
            F.sum("_fields").alias("_all_fields"),
            F.max(has_open_quote(F.col("value"))).alias("multiline"),
            F.collect_set(F.when(~F.is_valid_utf8("value"), F.lit(NOT_UTF8))).alias("problems"),
        )
        .withColumn("header", header_names(F.col("_header")))
        .withColumn("_width", F.size("header"))
        .withColumn(
            "_uneven",
            (F.col("_widest") > F.col("_width"))
            & (F.col("_all_fields") - F.col("_width") < (F.col("_lines") - 1) * F.col("_widest")),
        )
        .select(
            "path",
            "header",
            (F.col("_lines") - 1).alias("n_rows"),
            "multiline",
            "problems",
            F.col("_widest").alias("widest"),
            F.col("_uneven").alias("uneven"),
        )
    )


def ragged_files(lines: DataFrame, profiles: DataFrame) -> DataFrame:
    """Paths of uneven files with a row wider than both the header and the first row.

    The first row may be wider than the header: it then sets the width, as with
    a separator at the end of each row. `lines` are those of the uneven files.
    """
    at = F.struct("block_start", "line_id")
    header_at = lines.groupBy("path").agg(F.min(at).alias("_header_at"))
    first_rows = (
        join_on_key(lines, header_at, "path", "inner")
        .where(at > F.col("_header_at"))
        .groupBy("path")
        .agg(F.min_by(field_count(F.col("value")), at).alias("_first"))
    )
    return (
        profiles.join(first_rows, "path")
        .where(F.col("widest") > F.greatest(F.size("header"), F.col("_first")))
        .select("path")
    )


def required_columns(required: Mapping[str, Sequence[str]]) -> Column:
    """The required names of a row's `file_type`, as an array."""
    names = F.array().cast("array<string>")
    for known, columns in required.items():
        names = F.when(F.col("file_type") == known, F.array(*map(F.lit, columns))).otherwise(names)
    return names


def judge_files(
    files: DataFrame,
    profiles: DataFrame,
    dt,
    run_id: str,
    required: Mapping[str, Sequence[str]] = REQUIRED_COLUMNS,
) -> DataFrame:
    """Verdict of each listed file; a file without a profile has no line at all, or is gone.

    Names are compared exactly, so blanks and case matter. A required column has
    to be there once; twice is as unusable as missing.
    """
    missing = F.filter(
        "_required",
        lambda name: F.size(F.filter("header", lambda found: found == name)) != 1,
    )
    unreadable = F.col("header").isNull() | (F.size("problems") > 0)
    unseen = F.when(F.col("hidden"), HIDDEN).otherwise(NO_LINES)
    return (
        files.join(profiles, "path", "left")
        .withColumn("_required", required_columns(required))
        .withColumn("missing", missing)
        .withColumn(
            "verdict",
            F.when(unreadable, UNREADABLE)
            .when(F.col("n_rows") == 0, EMPTY)
            .when(F.size("missing") > 0, MISSING_COLUMNS)
            .otherwise(VALID),
        )
        .withColumn("dt", F.lit(dt).cast("date"))
        .withColumn("run_id", F.lit(run_id))
        .withColumn(
            "file_key",
            dated_key(VALIDATED, F.col("file_type"), F.col("dt"), plain_path("path")),
        )
        .select(
            "file_type",
            "path",
            "file_key",
            "verdict",
            F.when(F.col("verdict") == MISSING_COLUMNS, F.col("missing")).alias("missing"),
            F.when(F.col("header").isNull(), F.array(unseen))
            .otherwise(F.col("problems"))
            .alias("problems"),
            F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"),
            "header",
            "multiline",
            "length",
            "modified_at",
            "dt",
            "run_id",
        )
    )


def manifest(files: DataFrame) -> DataFrame:
    """(dt, file_type, files): sorted keys of the files of each day and type, for small listings."""
    return files.groupBy("dt", "file_type").agg(
        F.sort_array(F.collect_list("file_key")).alias("files")
    )

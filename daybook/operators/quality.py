"""Row rules for flat order files.

A row breaks a rule or not; a file with one broken row is rejected as a whole.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.casting import to_price
from daybook.functions.labels import labels_where
from daybook.operators.joins import join_on_key
from daybook.schemas import FLAT_COLUMNS

DUPLICATE_ORDER = "duplicate order_id"


def _rules(categories: Sequence[str] | None) -> dict[str, Column]:
    """Reason -> condition under which it applies."""
    rules = {
        f"missing {name}": F.coalesce(F.col(name), F.lit("")) == "" for name in FLAT_COLUMNS
    }
    strict_day = F.regexp_like("order_date", F.lit(r"^\d{4}-\d{2}-\d{2}$")) & F.col(
        "order_date"
    ).try_cast("date").isNotNull()
    rules["bad order_date"] = ~strict_day
    rules["bad quantity"] = F.coalesce(F.col("quantity").try_cast("int") <= 0, F.lit(True))
    rules["bad unit_price"] = F.coalesce(to_price("unit_price") <= 0, F.lit(True))
    rules["bad returned"] = ~F.lower("returned").isin("true", "false")
    if categories is not None:
        rules["unknown category"] = ~F.col("category").isin(list(categories))
    return rules


def _reasons(rules: dict[str, Column]) -> Column:
    """Names of the rules a row breaks; a type rule is not checked on a missing value."""
    present = {
        "bad order_date": "order_date",
        "bad quantity": "quantity",
        "bad unit_price": "unit_price",
        "bad returned": "returned",
        "unknown category": "category",
    }
    return labels_where(
        (
            reason,
            broken & (F.coalesce(F.col(present[reason]), F.lit("")) != "")
            if reason in present
            else broken,
        )
        for reason, broken in rules.items()
    )


def check_rows(
    rows: DataFrame,
    categories: Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """Add `reasons`, the rules each text row breaks (empty for a good row).

    `categories` is the fixed list of allowed names, or a dimension with a
    `category` column.
    """
    if isinstance(categories, DataFrame):
        allowed = categories.select("category").distinct().withColumn("_known", F.lit(True))
        checked = join_on_key(
            rows.withColumn("reasons", _reasons(_rules(None))), allowed, "category", "left"
        )
        unknown = (F.coalesce(F.col("category"), F.lit("")) != "") & F.col("_known").isNull()
        return checked.withColumn(
            "reasons",
            F.when(unknown, F.array_append("reasons", F.lit("unknown category"))).otherwise(
                F.col("reasons")
            ),
        ).select(*rows.columns, "reasons")
    return rows.withColumn("reasons", _reasons(_rules(categories)))


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def rejected_files(checked: DataFrame, file_column: str = "source_file") -> DataFrame:
    """One row per rejected file: every reason and how many rows give it.

    An order id that occurs again within its file counts as a reason too. The
    rows are read once: each counts for its order id and for each of its
    reasons, in two aggregates with partial sums, so a file of any size is fine.
    """
    itself = F.array(F.lit(DUPLICATE_ORDER))
    by_order = (
        checked.select(
            file_column, "order_id", F.explode(F.concat(itself, "reasons")).alias("reason")
        )
        .groupBy(file_column, "order_id", "reason")
        .agg(F.count("*").alias("n"))
    )
    unique = (F.col("reason") == DUPLICATE_ORDER) & (
        (F.col("n") == 1) | (F.coalesce("order_id", F.lit("")) == "")
    )
    return by_order.where(~unique).groupBy(file_column, "reason").agg(F.sum("n").alias("n"))


def reason_counts(checked: DataFrame, file_column: str = "source_file") -> DataFrame:
    """(file, reason, order_hash, n): rows per reason of a file, and rows per hash of file and order id where it repeats.

    The first of two steps, for rows that are a written table: what it shuffles
    per row is a number instead of a path and an id. See `rejected_by_counts`.
    """
    entry = "array<struct<file: string, reason: string, order_hash: bigint>>"
    no_text, no_hash = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    itself = F.when(
        F.coalesce("order_id", F.lit("")) != "",
        F.array(F.struct(no_text.alias("file"), no_text.alias("reason"), _order_hash(file_column).alias("order_hash"))),
    ).otherwise(F.array().cast(entry))
    broken = F.transform(
        "reasons",
        lambda reason: F.struct(F.col(file_column).alias("file"), reason.alias("reason"), no_hash.alias("order_hash")),
    )
    return (
        checked.select(F.inline(F.concat(itself, broken)))
        .groupBy(F.col("file").alias(file_column), "reason", "order_hash")
        .agg(F.count("*").alias("n"))
        .where("reason IS NOT NULL OR n > 1")
    )


def rejected_by_counts(
    checked: DataFrame, counts: DataFrame, file_column: str = "source_file"
) -> DataFrame:
    """`rejected_files` from the written `reason_counts` of the same rows.

    Order ids travel only for rows whose hash repeats, and are compared
    themselves. With `counts` written, Spark knows how few repeat, and then
    sends those to the rows; where they are many, both sides are shuffled and a
    hot id is split.
    """
    columns = [file_column, "reason", "n"]
    repeated = counts.where("order_hash IS NOT NULL").select("order_hash")
    rows = checked.where(F.coalesce("order_id", F.lit("")) != "").select(
        file_column, "order_id", _order_hash(file_column).alias("order_hash")
    )
    duplicates = (
        duplicate_keys(join_on_key(rows, repeated, "order_hash", "left_semi"), [file_column, "order_id"])
        .groupBy(file_column)
        .agg(F.sum("n").alias("n"))
        .withColumn("reason", F.lit(DUPLICATE_ORDER))
    )
    broken = counts.where("reason IS NOT NULL")
    return broken.select(*columns).unionByName(duplicates.select(*columns))


def _order_hash(file_column: str) -> Column:
    return F.xxhash64(file_column, "order_id")


def reasons_by_file(rejected: DataFrame, file_column: str = "source_file") -> DataFrame:
    """(file, reasons): the distinct reasons, at most one per rule."""
    return rejected.groupBy(file_column).agg(
        F.sort_array(F.collect_set("reason")).alias("reasons")
    )


def split_by_file(
    rows: DataFrame, rejected: DataFrame, file_column: str = "source_file"
) -> tuple[DataFrame, DataFrame]:
    """(rows of accepted files, rows of rejected files)."""
    files = rejected.select(file_column).distinct()
    return (
        join_on_key(rows, files, file_column, "left_anti"),
        join_on_key(rows, files, file_column, "left_semi"),
    )

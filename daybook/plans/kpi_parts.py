"""The stored partial sums of a workspace: what a delivery adds, and the KPIs of the days it touches.

All tables change by commits. A delivery writes its own rows and reads, of what
was stored before, the order index at the places of its order ids and the
partial sums of its days. No typed row of another delivery is read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook.functions.casting import month_of
from daybook.operators import parts
from daybook.operators.joins import join_on_key
from daybook.plans.workspace import Workspace
from daybook.schemas import (
    ITEM_PARTS,
    ORDER_DAYS,
    ORDER_PARTS,
    REVENUE_PARTS,
    WAITING_ITEMS,
)
from daybook.session import at_once
from daybook.sinks.versions import Commit, merge_folders, write_rows
from daybook.sources.tables import small_rows
from daybook.sources.versions import is_versioned, no_rows, read_folders, read_state, read_versions

MONTH = "order_month"
#: Beginnings of order ids by which one read of the index is pruned, at most.
BEGINNINGS = 200
#: Rows of the index that are read or skipped together.
FINE_PAGES = {"parquet.page.row.count.limit": 4000}
#: Numbers of last signs that are left out of the ids until their beginnings are that few.
_COARSER = (parts.FINE, 4, 5, 6, 7, 8, 9, 10, 12, 16, 24, 40, 1000)


@dataclass(frozen=True)
class Part:
    """A table of partial sums: by month in order of its days, or by place in order of order ids."""

    schema: StructType
    merged: Callable[[DataFrame], DataFrame]

    @property
    def by_month(self) -> bool:
        return MONTH in self.schema.names

    def write(self, rows: DataFrame, path: str, version: str) -> dict[str, str]:
        rows = rows.select(*self.schema.names)
        if self.by_month:
            return write_rows(rows, path, version, MONTH, ("order_date",))
        return write_rows(in_places(rows), path, version, **FINE_PAGES)


PARTS = {
    "items": Part(ITEM_PARTS, parts.merged_items),
    "orders": Part(ORDER_PARTS, parts.merged_orders),
    "revenue": Part(REVENUE_PARTS, parts.merged_revenue),
    "days": Part(ORDER_DAYS, DataFrame.distinct),
    "waiting": Part(WAITING_ITEMS, parts.merged_waiting),
}


def in_places(rows: DataFrame) -> DataFrame:
    """Rows in order of `place` over all files, so that few of them hold any one place."""
    return rows.repartitionByRange("place", "order_id").sortWithinPartitions("place", "order_id")


def is_built(spark: SparkSession, workspace: Workspace) -> bool:
    """Whether the sums follow all processed files; workspaces of earlier versions have none."""
    return is_versioned(spark, workspace.part("items"))


def stored_part(
    spark: SparkSession,
    workspace: Workspace,
    name: str,
    months: Iterable[str] | None = None,
    more: dict[str, str] | None = None,
) -> DataFrame:
    return read_versions(spark, workspace.part(name), PARTS[name].schema, months, more)


def beginnings(ids: DataFrame) -> list[str] | None:
    """Some few beginnings of places that cover all ids; None if even the coarsest are too many.

    The coarser the beginnings, the fewer: the finest that are few enough are searched for by halves.
    """
    least, most = 0, len(_COARSER)
    while least < most:
        middle = (least + most) // 2
        place = parts.place_of("order_id", _COARSER[middle])
        if ids.agg(F.approx_count_distinct(place)).first()[0] <= BEGINNINGS:
            most = middle
        else:
            least = middle + 1
    if least == len(_COARSER):
        return None
    found = ids.select(parts.place_of("order_id", _COARSER[least]).alias("place")).distinct()
    return sorted(row[0] for row in small_rows(found))


def at_places(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows near the places of some ids. The filter reaches the scan, which skips what lies elsewhere."""
    found = beginnings(ids)
    if found is None:
        return rows
    if not found:
        return rows.limit(0)
    near: Column = reduce(Column.__or__, (F.startswith(F.col("place"), F.lit(p)) for p in found))
    return rows.where(near)


def known_days(spark: SparkSession, workspace: Workspace, ids: DataFrame) -> DataFrame:
    """(order_id, order_date) of the known orders among `ids` (order_id, distinct)."""
    near = at_places(stored_part(spark, workspace, "days"), ids)
    return join_on_key(near.select("order_id", "order_date"), ids, "order_id", "left_semi").distinct()


def months_of(days: Iterable) -> list[str]:
    return sorted({f"{day:%Y-%m}" for day in days})


def day_filter(days: list[dt.date]) -> str:
    """Sorted days as ranges, with their months: few terms where days follow each other, and all reach the scan."""
    ranges: list[list[dt.date]] = []
    for day in days:
        if ranges and day - ranges[-1][1] <= dt.timedelta(days=1):
            ranges[-1][1] = day
        else:
            ranges.append([day, day])
    terms = [
        f"{MONTH} BETWEEN '{a:%Y-%m}' AND '{b:%Y-%m}' AND order_date BETWEEN DATE'{a}' AND DATE'{b}'"
        for a, b in ranges
    ]
    return " OR ".join(f"({t})" for t in terms) or "false"


@dataclass(frozen=True)
class Delivery:
    """The folders that a delivery has written to each table, by partition value; nothing is committed yet."""

    written: dict[str, dict[str, str]]

    def rows(self, spark: SparkSession, workspace: Workspace, name: str) -> DataFrame:
        folders = self.written[name].values()
        return read_folders(spark, workspace.part(name), PARTS[name].schema, folders)

    def commit(self, workspace: Workspace, commit: Commit) -> None:
        for name, folders in self.written.items():
            commit.append(workspace.part(name), folders)


def write_delivery(
    spark: SparkSession, workspace: Workspace, orders: DataFrame, items: DataFrame, work: str, version: str
) -> Delivery:
    """Write what new typed rows add to each table."""

    def kept(rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{work}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{work}/{name}")

    written = {}

    def add(name: str, rows: DataFrame) -> DataFrame:
        written[name] = PARTS[name].write(rows, workspace.part(name), version)
        return Delivery({name: written[name]}).rows(spark, workspace, name)

    # typed rows are read once; all else follows from what they add up to
    sums, pairs = at_once(
        lambda: kept(parts.item_sums(add("items", parts.item_parts(items))), "sums"),
        lambda: kept(parts.order_day_pairs(add("orders", parts.order_parts(orders))), "pairs"),
    )
    known, fresh = no_rows(pairs), pairs
    if read_state(spark, workspace.part("days")).folders:
        ids = sums.select("order_id").unionByName(pairs.select("order_id")).distinct()
        known = kept(known_days(spark, workspace, kept(ids, "ids")), "known")
        fresh = kept(parts.new_pairs(pairs, known), "fresh")

    again = join_on_key(known, fresh.select("order_id"), "order_id", "left_semi")
    months = [row[0] for row in small_rows(again.select(month_of("order_date")).distinct())]
    revenue = stored_part(spark, workspace, "revenue", months).drop(MONTH)
    waiting = stored_part(spark, workspace, "waiting")
    if read_state(spark, workspace.part("waiting")).folders:
        fresh_ids = fresh.select("order_id")
        waiting = at_places(waiting, fresh_ids)
        waiting = join_on_key(waiting, fresh_ids, "order_id", "left_semi")

    def add_sums() -> None:
        days_of_sums = kept(parts.with_days(sums, known.unionByName(fresh)), "days_of_sums")
        at_once(
            lambda: add("revenue", parts.revenue_parts(days_of_sums, known, fresh, revenue, waiting.drop("place"))),
            lambda: add("waiting", parts.still_waiting(days_of_sums)),
        )

    at_once(add_sums, lambda: add("days", fresh.withColumn("place", parts.place_of("order_id"))))
    return Delivery({name: written[name] for name in PARTS})


def touched_days(spark: SparkSession, workspace: Workspace, delivery: Delivery) -> dict[str, list]:
    """Days whose KPIs a delivery changes; as many as the calendar has at most."""
    found = {"category": ["items"], "order": ["orders", "revenue"]}

    def days(names: list[str]) -> list:
        dates = [delivery.rows(spark, workspace, n).select("order_date") for n in names]
        distinct = reduce(DataFrame.unionByName, dates).where("order_date IS NOT NULL").distinct()
        return sorted(row[0] for row in small_rows(distinct))

    return dict(zip(found, at_once(*[partial(days, names) for names in found.values()])))


def kpis_of_days(
    spark: SparkSession,
    workspace: Workspace,
    delivery: Delivery,
    days: dict[str, list],
    products: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """(category KPIs, order KPIs) of whole days from all partial sums, those of the delivery included.

    Their months are read and within them the parts of files that hold the days.
    """

    def on_days(name: str, wanted: list) -> DataFrame:
        rows = stored_part(spark, workspace, name, months_of(wanted), delivery.written[name])
        return rows.where(day_filter(wanted))

    category = parts.category_kpis_of_parts(on_days("items", days["category"]), products)
    order = parts.order_kpis_of_parts(*[on_days(name, days["order"]) for name in ("orders", "revenue")])
    return category, order


def compact_parts(spark: SparkSession, workspace: Workspace) -> list[str]:
    """Merge small runs of every table; the names of those that had any. Each table in a commit of its own."""
    done = []
    for name, part in PARTS.items():
        path = workspace.part(name)

        def merge(folders: list[str], part: Part = part, path: str = path) -> DataFrame:
            rows = part.merged(read_folders(spark, path, part.schema, folders)).select(*part.schema.names)
            return rows if part.by_month else in_places(rows)

        partition, order = (MONTH, ("order_date",)) if part.by_month else (None, ())
        options = {} if part.by_month else FINE_PAGES
        if is_versioned(spark, path) and merge_folders(spark, path, merge, partition, order, **options):
            done.append(name)
    return done

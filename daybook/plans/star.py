"""The operators on the star-schema tables, one query per operator."""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.bindings import STAR_ITEMS, STAR_ORDERS, STAR_PRODUCTS, Binding
from daybook.functions.paths import base_name, plain_path, processed_key
from daybook.operators import arrivals as arr
from daybook.operators import flat, gate, kpis, ledger, quality, serving
from daybook.operators.cleaning import clean_items, clean_orders, reject_counts
from daybook.operators.joins import join_on_key
from daybook.operators.summary import run_summary
from daybook.plans.flat_run import run_flat
from daybook.plans.gate_run import judge, list_incoming, quarantine, run_gate
from daybook.plans.kpi_run import run_kpis, valid_files
from daybook.plans.workspace import Workspace
from daybook.schemas import (
    CATEGORY_KPI,
    CATEGORY_KPI_KEYS,
    FILE_IDENTITY,
    FLAT_COLUMNS,
    FLAT_TYPE,
    ORDER_KPI,
    ORDER_KPI_KEYS,
    REJECTED_FLAT,
    REQUIRED_COLUMNS,
)
from daybook.session import at_once, frees_shuffles, scratch_folder
from daybook.sinks.manifest import MANIFEST
from daybook.sinks.upsert import stored_kpis, upsert
from daybook.sources.tables import path_exists, read_ledger, read_table
from daybook.sources.versions import hadoop_path
from daybook.streaming.kpi_stream import stream_kpis

Query = Callable[[SparkSession, str], DataFrame]

SECOND_DELIVERY = "1998-07-01"
LANDING_BUCKET = "shop-landing"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def star_orders(spark: SparkSession, folder: str) -> DataFrame:
    return clean_orders(STAR_ORDERS.apply(table(spark, folder, "orders")))


def star_items(spark: SparkSession, folder: str) -> DataFrame:
    return clean_items(STAR_ITEMS.apply(table(spark, folder, "lineitem")))


def star_products(spark: SparkSession, folder: str) -> DataFrame:
    return STAR_PRODUCTS.apply(table(spark, folder, "part"))


# Text columns as a CSV would have them, in several spellings, good and bad.
TEXT_ORDERS = Binding(
    {
        "order_id": "cast(o_orderkey as string)",
        "user_id": "cast(o_custkey as string)",
        "created_at": """case o_orderstatus
            when 'F' then date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') || ' UTC'
            when 'O' then date_format(o_orderdate, 'yyyy-MM-dd')
            else date_format(o_orderdate, 'MM/dd/yyyy') end""",
        "status": "if(o_orderstatus = 'F', 'returned', o_orderstatus)",
        "num_of_item": """case o_orderpriority
            when '1-URGENT' then ' 1 '
            when '2-HIGH' then '+2'
            when '3-MEDIUM' then '3.7'
            when '5-LOW' then '5.'
            else o_orderpriority end""",
    }
)
TEXT_ITEMS = Binding(
    {
        "order_id": "cast(l_orderkey as string)",
        "product_id": "cast(l_partkey as string)",
        "created_at": "date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
        "sale_price": """case l_linestatus
            when 'O' then cast(cast(l_extendedprice as decimal(12,2)) as string) || '5'
            else '$' || cast(cast(l_extendedprice as decimal(12,2)) as string) end""",
        "status": "if(l_returnflag = 'R', 'returned', l_returnflag)",
    }
)


def q_clean_orders(spark: SparkSession, folder: str) -> DataFrame:
    raw = TEXT_ORDERS.apply(table(spark, folder, "orders"))
    return clean_orders(raw).select("order_id", "user_id", "status", "order_date", "num_of_item")


def q_clean_items(spark: SparkSession, folder: str) -> DataFrame:
    raw = TEXT_ITEMS.apply(table(spark, folder, "lineitem"))
    return clean_items(raw).select(
        "order_id", "product_id", "order_date", "sale_price", "is_returned"
    )


def q_clean_reject_counts(spark: SparkSession, folder: str) -> DataFrame:
    orders = clean_orders(TEXT_ORDERS.apply(table(spark, folder, "orders")))
    items = clean_items(TEXT_ITEMS.apply(table(spark, folder, "lineitem")))
    return (
        reject_counts(orders)
        .withColumn("file_type", F.lit("orders"))
        .unionByName(reject_counts(items).withColumn("file_type", F.lit("order_items")))
    )


def q_items_with_category(spark: SparkSession, folder: str) -> DataFrame:
    joined = kpis.items_with_category(star_items(spark, folder), star_products(spark, folder))
    return joined.select(
        "order_id", "product_id", "category", "order_date", "sale_price", "is_returned"
    )


def q_category_order_values(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.category_order_values(
        kpis.items_with_category(star_items(spark, folder), star_products(spark, folder))
    )


def q_category_daily_kpi(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.category_kpis(star_items(spark, folder), star_products(spark, folder))


def q_order_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.order_revenue(star_items(spark, folder)).select("order_id", "order_revenue")


def q_orders_with_revenue(spark: SparkSession, folder: str) -> DataFrame:
    revenue = kpis.order_revenue(star_items(spark, folder))
    return kpis.orders_with_revenue(star_orders(spark, folder), revenue).select(
        "order_id", "order_date", "order_revenue"
    )


def q_order_daily_kpi(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.order_kpis(star_orders(spark, folder), star_items(spark, folder), count_lines=True)


def q_kpi_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """Items of every tenth product carry an id that no product has."""
    items = star_items(spark, folder).withColumn(
        "product_id", F.expr("if(product_id % 10 = 0, -1 - product_id, product_id)")
    )
    return kpis.reconciliation(items, star_products(spark, folder))


def star_files(spark: SparkSession, folder: str) -> DataFrame:
    """A listing with one file per order day and status."""
    return (
        table(spark, folder, "orders")
        .select(
            F.col("o_orderdate").cast("date").alias("dt"),
            F.concat(F.lit("orders_"), F.lower("o_orderstatus")).alias("file_type"),
            F.expr(
                "concat('validated/orders/dt=', cast(cast(o_orderdate as date) as string), "
                "'/part-', o_orderstatus, if(day(o_orderdate) = 31, '.txt', '.csv'))"
            ).alias("file_key"),
        )
        .distinct()
    )


def star_ledger(files: DataFrame) -> DataFrame:
    """Files of the first half of each year are done."""
    return files.where(F.month("dt") <= 6).select("file_key")


def q_new_files(spark: SparkSession, folder: str) -> DataFrame:
    files = star_files(spark, folder)
    found = ledger.new_files(files, star_ledger(files), ["file_key"])
    return found.select("file_type", "file_key")


def q_latest_file_per_type(spark: SparkSession, folder: str) -> DataFrame:
    files = star_files(spark, folder)
    return ledger.latest_file_per_type(
        ledger.new_files(files, star_ledger(files), ["file_key"])
    )


def q_processed_keys(spark: SparkSession, folder: str) -> DataFrame:
    return star_files(spark, folder).select(
        "file_key", processed_key(F.col("file_key")).alias("done_key")
    )


def q_batch_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Sorted file lists, as text, of every day and type."""
    files = star_files(spark, folder).withColumn("file_type", F.lit("orders"))
    return gate.manifest(files).select(
        "dt",
        "file_type",
        F.size("files").alias("n_files"),
        F.array_join("files", ",").alias("files"),
    )


def q_kpi_upsert_category(spark: SparkSession, folder: str) -> DataFrame:
    """KPIs of the open lines are stored, then KPIs of the closed lines come in."""
    lines, products = table(spark, folder, "lineitem"), star_products(spark, folder)
    scratch = scratch_folder(spark, "upsert")
    for status in ("O", "F"):
        items = clean_items(STAR_ITEMS.apply(lines.where(F.col("l_linestatus") == status)))
        upsert(
            spark,
            kpis.category_kpis(items, products),
            f"{scratch}/table",
            CATEGORY_KPI,
            CATEGORY_KPI_KEYS,
            f"{scratch}/{status}",
        )
    return stored_kpis(spark, f"{scratch}/table", CATEGORY_KPI).drop("order_month")


def q_kpi_upsert_order(spark: SparkSession, folder: str) -> DataFrame:
    """KPIs of all orders are stored, then KPIs of the urgent orders come in."""
    orders, items = table(spark, folder, "orders"), star_items(spark, folder)
    scratch = scratch_folder(spark, "upsert")
    deliveries = {"all": orders, "urgent": orders.where("o_orderpriority = '1-URGENT'")}
    for name, rows in deliveries.items():
        upsert(
            spark,
            kpis.order_kpis(clean_orders(STAR_ORDERS.apply(rows)), items, count_lines=True),
            f"{scratch}/table",
            ORDER_KPI,
            ORDER_KPI_KEYS,
            f"{scratch}/{name}",
        )
    return stored_kpis(spark, f"{scratch}/table", ORDER_KPI).drop("order_month")


def _write_csv(rows: DataFrame, path: str, **options: object) -> None:
    """CSV files of rows as they come, to a new folder; no row moves for it.

    Of tasks without rows only the first writes a file. It goes unless it is the only one.
    """
    writer = rows.write.option("header", True).options(**{"escape": '"', **options})
    writer.csv(path)
    system, folder = hadoop_path(rows.sparkSession, path)
    header = len(",".join(rows.columns).encode()) + 1 if options.get("header", True) else 0
    files = [f for f in system.listStatus(folder) if f.getPath().getName().startswith("part-")]
    for file in files:
        if len(files) > 1 and file.getPath().getName().startswith("part-00000") and file.getLen() <= header:
            system.delete(file.getPath(), False)


def _write_planted(rows: DataFrame, planted: str, path: str, **options: object) -> None:
    """One file for each 2,000 order keys; its last row is an order 0 with `planted` as its number of items."""
    chunk = F.floor(F.col("order_id") / 2000)
    required = REQUIRED_COLUMNS["orders"]
    texts = rows.select(*[F.col(c).cast("string") for c in required], chunk.alias("chunk"))
    last = texts.select("chunk").distinct().selectExpr(
        "'0' order_id", "'0' user_id", "'2025-07-06' created_at", "'late' status",
        f"{planted} num_of_item", "chunk",
    )
    (
        texts.unionByName(last)
        .repartition("chunk")
        .sortWithinPartitions("chunk", (F.col("status") == "late"))
        .write.mode("append")
        .options(**{"header": True, "escape": '"', **options})
        .partitionBy("chunk")
        .csv(path)
    )


def _touch(spark: SparkSession, path: str) -> None:
    """A file of zero bytes."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at).close()


def priority_rows(spark: SparkSession, folder: str, priority: str, **changed: str) -> DataFrame:
    binding = Binding({**STAR_ORDERS.columns, "num_of_item": "'1'", **changed})
    source = table(spark, folder, "orders")
    return binding.apply(source.where(F.col("o_orderpriority") == priority))


def batch_of(path: str = "path") -> Column:
    """The folder below that of its type in which a file landed."""
    return F.regexp_extract(path, "incoming/[^/]+/([^/]+)/", 1)


def q_file_gate(spark: SparkSession, folder: str) -> DataFrame:
    """All orders as CSV files, each priority with its own kind of file, and files with every defect."""
    workspace = Workspace(scratch_folder(spark, "gate"))

    def path(name: str) -> str:
        return f"{workspace.incoming('orders')}/{name}"

    required = REQUIRED_COLUMNS["orders"]
    urgent = priority_rows(spark, folder, "1-URGENT")
    _write_csv(urgent.select(*required), path("plain"))
    high = priority_rows(spark, folder, "2-HIGH", note="'a, \"b\" and c'")
    _write_csv(high.select("note", *reversed(required)), path("reordered"))
    medium = priority_rows(spark, folder, "3-MEDIUM")
    _write_csv(medium.drop("user_id"), path("no_user"))
    unspecified = priority_rows(spark, folder, "4-NOT SPECIFIED")
    _write_csv(unspecified.withColumnRenamed("order_id", "Order_ID"), path("other_case"))
    low = priority_rows(spark, folder, "5-LOW")
    # Without quoting, a comma inside a value makes one field more.
    _write_planted(low, "'1,2'", path("ragged"), quote="")
    _write_planted(low, "'a\nb'", path("quoted_break"))
    _write_planted(low, "'\u00ff'", path("bad_byte"), encoding="ISO-8859-1")
    low.where("false").select(*required).coalesce(1).write.option("header", True).csv(
        path("header_only")
    )
    _touch(spark, f"{path('zero')}/none.csv")
    _touch(spark, f"{path('hidden')}/_late.csv")

    verdicts = judge(
        spark,
        list_incoming(spark, workspace),
        dt.date(2025, 7, 6),
        "star",
        workspace.staging("star"),
    )
    return verdicts.groupBy(
        batch_of().alias("batch"),
        "verdict",
        F.coalesce(F.array_join("missing", ","), F.lit("")).alias("missing"),
        F.array_join("problems", ",").alias("problems"),
    ).agg(F.sum("n_rows").alias("n_rows"))


def q_written_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of a gate run over all orders and lines as files, read back; keys keep the files' names."""
    workspace = Workspace(scratch_folder(spark, "manifest"))
    orders, items = workspace.incoming("orders"), workspace.incoming("order_items")
    required = REQUIRED_COLUMNS["orders"]
    for priority in ("1-URGENT", "2-HIGH", "4-NOT SPECIFIED", "5-LOW"):
        rows = priority_rows(spark, folder, priority)
        _write_csv(rows.select(*required), f"{orders}/{priority}")
    _write_csv(priority_rows(spark, folder, "3-MEDIUM").drop("status"), f"{orders}/3-MEDIUM")
    lines = table(spark, folder, "lineitem")
    for flag in ("R", "A", "N"):
        rows = STAR_ITEMS.apply(lines.where(F.col("l_returnflag") == flag))
        _write_csv(rows.select(*REQUIRED_COLUMNS["order_items"]), f"{items}/{flag}")
    run_gate(spark, workspace, dt.date(2025, 7, 6), archive=False)
    listed = spark.read.schema(f"{MANIFEST}, dt string").json(workspace.manifests)
    landed = plain_path("path")
    same = base_name(landed) == base_name("file_key")
    return listed.groupBy(
        "dt",
        "file_type",
        F.regexp_extract(landed, "incoming/[^/]+/([^/]+)/", 1).alias("batch"),
        F.regexp_replace("file_key", "[^/]+$", "").alias("key_folder"),
    ).agg(F.min(same.cast("int")).alias("names_kept"))


def before_second() -> Column:
    return F.col("o_orderdate") < F.lit(SECOND_DELIVERY).cast("date")


def land_products(spark: SparkSession, folder: str, workspace: Workspace) -> None:
    _write_csv(star_products(spark, folder), f"{workspace.products}/1997-12-31")


def deliver(spark: SparkSession, folder: str, workspace: Workspace, first: bool) -> None:
    """The CSV files of the orders before or from the second delivery on.

    The lines meet their orders once for both: the files of the second are written
    with those of the first and wait among the staged results, where no gate looks.
    """
    waiting = workspace.staging("deliveries")
    if first:
        land_products(spark, folder, workspace)
        orders = table(spark, folder, "orders")
        early, late = before_second(), ~before_second()
        batch = F.when(early, "first").when(late, "second")
        # A key that is there twice may be in both deliveries.
        keys = orders.groupBy(F.col("o_orderkey").alias("l_orderkey")).agg(
            F.max(early).alias("in_first"), F.max(late).alias("in_second")
        )
        lines = join_on_key(table(spark, folder, "lineitem"), keys, "l_orderkey", "inner")
        batches = F.array(F.when(F.col("in_first"), "first"), F.when(F.col("in_second"), "second"))
        lines = lines.withColumn("batch", F.explode(batches)).where("batch IS NOT NULL")
        order_rows = landed_orders(spark, folder, orders.where(batch.isNotNull()), batch.alias("batch"))
        for file_type, rows in (("orders", order_rows), ("order_items", landed_items(lines, "batch"))):
            rows.write.option("header", True).option("escape", '"').partitionBy("batch").csv(f"{waiting}/{file_type}")
            for name in ("first", "second"):
                if not path_exists(spark, f"{waiting}/{file_type}/batch={name}"):
                    _write_csv(rows.drop("batch").limit(0), f"{waiting}/{file_type}/batch={name}")
    name = "first" if first else "second"
    for file_type in REQUIRED_COLUMNS:
        system, target = hadoop_path(spark, f"{workspace.incoming(file_type)}/{name}")
        system.mkdirs(target.getParent())
        _, source = hadoop_path(spark, f"{waiting}/{file_type}/batch={name}")
        if not system.rename(source, target):
            raise OSError(f"{source} could not be moved to {target}")


def landed_orders(spark: SparkSession, folder: str, orders: DataFrame, *more: Column) -> DataFrame:
    """Rows of orders files, with the number of lines of each order."""
    n_lines = kpis.order_revenue(star_items(spark, folder)).select("order_id", "n_lines")
    bound = orders.select(*[F.expr(sql).alias(name) for name, sql in STAR_ORDERS.columns.items()], *more)
    counted = bound.join(n_lines, "order_id", "left").withColumn("num_of_item", F.coalesce("n_lines", F.lit(0)))
    kept = [name for name in bound.columns if name not in STAR_ORDERS.columns]
    return counted.select(*REQUIRED_COLUMNS["orders"], *kept)


def landed_items(lines: DataFrame, *more: str) -> DataFrame:
    """Rows of order item files."""
    bound = lines.select(*[F.expr(sql).alias(name) for name, sql in STAR_ITEMS.columns.items()], *more)
    price = F.col("sale_price").cast("decimal(12,2)")
    return bound.withColumn("sale_price", price).select(*REQUIRED_COLUMNS["order_items"], *more)


def land(
    spark: SparkSession, folder: str, workspace: Workspace, wanted: Column, batch: str, **options: int
) -> None:
    """CSV files of the wanted orders and of their items, in a folder of their own."""
    orders = table(spark, folder, "orders").where(wanted)
    keys = orders.select(F.col("o_orderkey").alias("l_orderkey"))
    lines = table(spark, folder, "lineitem").join(keys, "l_orderkey", "left_semi")

    def write(file_type: str, rows: DataFrame) -> None:
        if "files" in options:
            rows = rows.repartition(options["files"])  # only the rows go to that task, not the join before
            rows.write.option("header", True).csv(f"{workspace.incoming(file_type)}/{batch}")
        else:
            _write_csv(rows, f"{workspace.incoming(file_type)}/{batch}")

    at_once(
        lambda: write("orders", landed_orders(spark, folder, orders)),
        lambda: write("order_items", landed_items(lines)),
    )


def q_stream_order_kpi(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files in two deliveries through the gate and the stream into the KPI table."""
    workspace = Workspace(scratch_folder(spark, "stream"))
    for first in (True, False):
        deliver(spark, folder, workspace, first)
        run_gate(spark, workspace)
        query = stream_kpis(spark, workspace, f"{workspace.root}/checkpoint")
        query.awaitTermination()
    return stored_kpis(spark, workspace.order_kpis, ORDER_KPI).drop("order_month")


def q_landed_category_kpi(spark: SparkSession, folder: str) -> DataFrame:
    """The same CSV files through the gate and one batch run into the KPI table."""
    workspace = Workspace(scratch_folder(spark, "landed"))
    for first in (True, False):
        deliver(spark, folder, workspace, first)
        run_gate(spark, workspace)
    run_kpis(spark, workspace)
    return stored_kpis(spark, workspace.category_kpis, CATEGORY_KPI).drop("order_month")


def q_latest_only_kpi(spark: SparkSession, folder: str) -> DataFrame:
    """Order KPIs of the last file alone: the orders of the last day, which land a day later."""
    workspace = Workspace(scratch_folder(spark, "latest"))
    last = table(spark, folder, "orders").agg(F.max("o_orderdate")).first()[0]
    on_last = F.col("o_orderdate") == F.lit(last)
    land_products(spark, folder, workspace)
    land(spark, folder, workspace, ~on_last, "earlier")
    run_gate(spark, workspace, dt.date(2025, 7, 6), archive=False)
    land(spark, folder, workspace, on_last, "last", files=1)
    run_gate(spark, workspace, dt.date(2025, 7, 7), archive=False)
    run_kpis(spark, workspace, latest_only=True, recompute=False)
    return stored_kpis(spark, workspace.order_kpis, ORDER_KPI).drop("order_month")


def q_stored_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """What the stored ledger knows after the first of two deliveries, by rows of the files."""
    workspace = Workspace(scratch_folder(spark, "ledger"))
    deliver(spark, folder, workspace, first=True)
    run_gate(spark, workspace, archive=False)
    run_kpis(spark, workspace, recompute=False)
    deliver(spark, folder, workspace, first=False)
    run_gate(spark, workspace, archive=False)
    files, known = valid_files(spark, workspace), read_ledger(spark, workspace.ledger)
    pending = ledger.new_files(files, known).withColumn("state", F.lit("pending"))
    done = files.join(known.select(*FILE_IDENTITY), FILE_IDENTITY, "left_semi").withColumn(
        "state", F.lit("done")
    )
    return (
        done.unionByName(pending)
        .groupBy("file_type", batch_of().alias("batch"), "state")
        .agg(F.sum("n_rows").alias("n_rows"))
    )


def q_run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return run_summary(
        {
            "category_kpis": q_category_daily_kpi(spark, folder),
            "order_kpis": q_order_daily_kpi(spark, folder),
            "pending_files": q_new_files(spark, folder),
        }
    )


def star_notifications(spark: SparkSession, folder: str) -> DataFrame:
    """One notification document per event, whose shape depends on the event type."""
    bucket = f"if(event_type = 'purchase', 'other-bucket', '{LANDING_BUCKET}')"
    place = "if(event_type = 'view', 'static/', 'incoming/order_items/')"
    record = "named_struct('s3', named_struct('bucket', named_struct('name', {}), 'object', {}))"
    first = record.format(bucket, "named_struct('key', 'incoming/orders/' || event_id || '.csv')")
    key = f"if(event_type = 'error', null, {place} || event_id || '.csv')"
    second = record.format(bucket, f"named_struct('key', {key})")
    body = f"""if(event_type = 'signup', to_json(named_struct('Event', event_type)),
        to_json(named_struct('Records', array({first}, {second}))))"""
    return table(spark, folder, "events").select("event_id", "ts", F.expr(body).alias("body"))


def q_arrival_events(spark: SparkSession, folder: str) -> DataFrame:
    parsed = arr.parse_notifications(star_notifications(spark, folder))
    events = arr.start_events(arr.arrivals(parsed, LANDING_BUCKET), F.col("ts"))
    return events.select(
        "event_id",
        *[
            F.get_json_object("detail", f"$.{name}").alias(name)
            for name in ("bucket", "key", "timestamp")
        ],
    )


def q_arrival_summary(spark: SparkSession, folder: str) -> DataFrame:
    parsed = arr.parse_notifications(star_notifications(spark, folder))
    return arr.arrival_summary(parsed, LANDING_BUCKET)


def q_arrival_status(spark: SparkSession, folder: str) -> DataFrame:
    """Result code of every document."""
    parsed = arr.parse_notifications(star_notifications(spark, folder))
    return parsed.select("event_id", "status_code", F.coalesce(F.size("records"), F.lit(0)).alias("n"))


def star_flat_text(spark: SparkSession, folder: str) -> DataFrame:
    """Flat order rows as text, one file per ship date, with rare defects of every kind."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    parts = table(spark, folder, "part")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    return Binding(
        {
            "order_id": "l_orderkey || '-' || l_linenumber",
            "customer_id": "if(o_orderpriority = '4-NOT SPECIFIED' and l_quantity = 11, '', "
            "cast(o_custkey as string))",
            "order_date": "date_format(l_shipdate, if(o_orderpriority = '5-LOW' and "
            "l_quantity = 7, 'dd/MM/yyyy', 'yyyy-MM-dd'))",
            "category": "if(p_brand = 'Brand#13' and l_quantity = 3, 'Brand', p_brand)",
            "product_id": "cast(l_partkey as string)",
            "quantity": "cast(cast(l_quantity as int) as string) || "
            "if(p_type = 'ECONOMY' and l_quantity = 50, '.5', '')",
            "unit_price": "if(o_orderstatus = 'P' and l_quantity = 1, '-1.00', "
            "cast(cast(p_retailprice as decimal(10,2)) as string))",
            "returned": "case l_returnflag when 'R' then 'True' when 'A' then 'FALSE' "
            "else if(l_quantity = 13, 'n/a', 'false') end",
            "source_file": "date_format(l_shipdate, 'yyyy-MM-dd')",
        }
    ).apply(joined)


def _checked(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_rows(star_flat_text(spark, folder), star_products(spark, folder))


def q_row_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per broken rule, and rows that break none."""
    reason = F.explode(
        F.when(F.size("reasons") == 0, F.array(F.lit("good"))).otherwise(F.col("reasons"))
    )
    return (
        _checked(spark, folder)
        .select(reason.alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("n"))
    )


def q_duplicate_orders(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


def q_rejected_files(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rejected_files(_checked(spark, folder))


def star_flat(spark: SparkSession, folder: str, customers: bool) -> DataFrame:
    """Typed flat rows; the join with orders only where customers are needed."""
    lines = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    columns = {
        "order_id": "l_orderkey",
        "order_date": "l_shipdate",
        "category": "p_brand",
        "quantity": "l_quantity",
        "unit_price": "cast(p_retailprice as decimal(10,2))",
        "returned": "l_returnflag = 'R'",
    }
    if customers:
        orders = table(spark, folder, "orders")
        joined = joined.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        columns["customer_id"] = "o_custkey"
    return flat.clean_flat(Binding(columns).apply(joined))


def land_flat(rows: DataFrame, workspace: Workspace) -> None:
    _write_csv(rows.select(*FLAT_COLUMNS), f"{workspace.incoming(FLAT_TYPE)}/star")


FLAT_ORDER_ID = (
    "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_quantity"
    " || '-' || l_extendedprice || '-' || l_shipdate || '-' || l_suppkey || l_discount || l_tax"
)


@frees_shuffles
def q_flat_job_kpi(spark: SparkSession, folder: str) -> DataFrame:
    """Flat text files through the whole job: letter case, large prices and parts of a cent."""
    workspace = Workspace(scratch_folder(spark, "flat"))
    lines, orders, parts = (table(spark, folder, name) for name in ("lineitem", "orders", "part"))
    price = "cast(cast(p_retailprice as decimal(10,2)) as string)"
    binding = Binding(
        {
            "order_id": FLAT_ORDER_ID,
            "customer_id": "cast(o_custkey as string)",
            "order_date": "date_format(l_shipdate, 'yyyy-MM-dd')",
            "category": "p_brand",
            "product_id": "cast(l_partkey as string)",
            "quantity": "cast(cast(l_quantity as int) as string)",
            "unit_price": f"case when l_quantity = 1 then '100000000.00' "
            f"when l_quantity = 3 then {price} || '5' else {price} end",
            "returned": "case l_returnflag when 'R' then 'tRuE' when 'A' then 'FALSE' else 'false' end",
            "l_orderkey": "l_orderkey",
        }
    )

    def flat_rows(lines: DataFrame) -> DataFrame:
        joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
            orders, F.col("l_orderkey") == F.col("o_orderkey")
        )
        return binding.apply(joined)

    # An id begins with its order key, so equal ids are where the join with orders has put them already.
    unnamed = F.expr(FLAT_ORDER_ID).isNull()
    rows = flat_rows(lines.where(~unnamed)).dropDuplicates(["l_orderkey", "order_id"])
    if not lines.where(unnamed).isEmpty():
        rows = rows.unionByName(flat_rows(lines.where(unnamed)).limit(1))
    land_flat(rows, workspace)
    run_flat(spark, workspace, star_products(spark, folder), dt.date(2025, 7, 6))
    return stored_kpis(spark, workspace.flat_order_kpis, ORDER_KPI).drop("order_month")


def q_flat_file_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Flat files must start with a header row: with it, without it, and with nothing else."""
    workspace = Workspace(scratch_folder(spark, "flat-gate"))
    rows = star_flat_text(spark, folder).select(*FLAT_COLUMNS)
    landing = workspace.incoming(FLAT_TYPE)
    _write_csv(rows, f"{landing}/headed")
    _write_csv(rows, f"{landing}/bare", header=False)
    rows.where("false").coalesce(1).write.option("header", True).csv(f"{landing}/header_only")
    verdicts = judge(
        spark,
        list_incoming(spark, workspace, [FLAT_TYPE]),
        dt.date(2025, 7, 6),
        "star",
        workspace.staging("star"),
        {FLAT_TYPE: FLAT_COLUMNS},
    )
    missing = F.coalesce(F.size("missing"), F.lit(0)).alias("n_missing")
    first_rows = F.count_if(batch_of() == "bare")  # taken for headers
    return verdicts.groupBy(batch_of().alias("batch"), "verdict", missing).agg(
        (F.sum("n_rows") + first_rows).alias("n_rows")
    )


def q_idle_run(spark: SparkSession, folder: str) -> DataFrame:
    """A run with order files alone does nothing and marks nothing; with item files it takes both."""
    workspace = Workspace(scratch_folder(spark, "idle"))
    at_once(
        lambda: land_products(spark, folder, workspace),
        lambda: land(spark, folder, workspace, before_second(), "first"),
    )
    items = f"{workspace.incoming('order_items')}/first"
    late = f"{workspace.incoming('order_items')}/_first"  # hidden, so still on its way
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    system = path_of(items).getFileSystem(spark._jsc.hadoopConfiguration())
    system.rename(path_of(items), path_of(late))
    run_gate(spark, workspace, archive=False)
    found = []
    for step in ("orders alone", "both"):
        if step == "both":
            system.rename(path_of(late), path_of(items))
            run_gate(spark, workspace, archive=False)
        ran = run_kpis(spark, workspace) is not None
        stored = stored_kpis(spark, workspace.order_kpis, ORDER_KPI).select(F.lit(1).alias("day"), F.lit(0).alias("known"))
        known = read_ledger(spark, workspace.ledger).select(F.lit(0).alias("day"), F.lit(1).alias("known"))
        found.append(
            stored.unionByName(known).agg(
                F.count_if(F.col("day") == 1).alias("n_days"),
                (F.count_if(F.col("known") == 1) > 0).alias("marked"),
            ).select(F.lit(step).alias("step"), F.lit(ran).alias("ran"), "n_days", "marked")
        )
    return found[0].unionByName(found[1])


def q_quarantined_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Kept lines of files without a column, and kept rows of rejected flat files by broken rule."""
    workspace = Workspace(scratch_folder(spark, "quarantine"))
    orders = Binding({**STAR_ORDERS.columns, "num_of_item": "'1'"}).apply(table(spark, folder, "orders"))
    without = orders.drop("user_id")
    _write_csv(without, f"{workspace.incoming('orders')}/no_user")
    run_gate(spark, workspace, dt.date(2025, 7, 6))
    land_flat(star_flat_text(spark, folder), workspace)
    run_flat(spark, workspace, star_products(spark, folder), dt.date(2025, 7, 6))
    files, lines = quarantine(spark, workspace)
    missing = files.select(F.col("path").alias("source_file"), F.array_join("missing", ",").alias("reason"))
    of_files = (
        lines.where("verdict = 'missing_columns' AND NOT startswith(value, 'order_id')")
        .join(missing, "source_file")
        .groupBy("verdict", "reason")
        .agg(F.count("*").alias("n"))
    )
    rows = read_table(spark, workspace.rejected_rows, REJECTED_FLAT)
    of_rows = (
        rows.select(F.lit("rejected_rows").alias("verdict"), F.explode("reasons").alias("reason"))
        .groupBy("verdict", "reason")
        .agg(F.count("*").alias("n"))
    )
    return of_files.unionByName(of_rows)


def q_flat_category_kpi(spark: SparkSession, folder: str) -> DataFrame:
    return flat.flat_category_kpi(star_flat(spark, folder, customers=False))


def q_flat_daily_kpi(spark: SparkSession, folder: str) -> DataFrame:
    return flat.flat_daily_kpi(star_flat(spark, folder, customers=True))


def stored_category_kpis(spark: SparkSession, folder: str) -> DataFrame:
    scratch = scratch_folder(spark, "serving")
    rows = q_category_daily_kpi(spark, folder)
    upsert(spark, rows, f"{scratch}/table", CATEGORY_KPI, CATEGORY_KPI_KEYS, f"{scratch}/new")
    return stored_kpis(spark, f"{scratch}/table", CATEGORY_KPI)


def stored_order_kpis(spark: SparkSession, folder: str) -> DataFrame:
    scratch = scratch_folder(spark, "serving")
    rows = q_order_daily_kpi(spark, folder)
    upsert(spark, rows, f"{scratch}/table", ORDER_KPI, ORDER_KPI_KEYS, f"{scratch}/new")
    return stored_kpis(spark, f"{scratch}/table", ORDER_KPI)


def q_kpi_category_range(spark: SparkSession, folder: str) -> DataFrame:
    stored = stored_category_kpis(spark, folder)
    return serving.category_range(stored, "Brand#7", "1997-01-01", "1997-12-31")


def q_kpi_category_day(spark: SparkSession, folder: str) -> DataFrame:
    return serving.category_day(stored_category_kpis(spark, folder), "Brand#7", "1997-06-24")


def q_kpi_day_range(spark: SparkSession, folder: str) -> DataFrame:
    return serving.day_range(stored_order_kpis(spark, folder), "1997-01-01", "1997-03-31")


def q_revenue_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return serving.revenue_by_category(q_category_daily_kpi(spark, folder))


def q_kpi_trend(spark: SparkSession, folder: str) -> DataFrame:
    return serving.trend(q_order_daily_kpi(spark, folder))


def q_headline_totals(spark: SparkSession, folder: str) -> DataFrame:
    return serving.headline_totals(q_order_daily_kpi(spark, folder), star_orders(spark, folder))


QUERIES: dict[str, Query] = {
    name.removeprefix("q_"): query for name, query in globals().items() if name.startswith("q_")
}

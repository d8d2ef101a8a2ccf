"""Fixed names and schemas of the data model."""

from pyspark.sql import types as T

# The columns a file of each type must have, the columns of the
# flat one-file variant, the order status that counts as a return, and the
# prefixes of file keys.
REQUIRED_COLUMNS = {
    "orders": ["order_id", "user_id", "created_at", "status", "num_of_item"],
    "order_items": ["order_id", "product_id", "created_at", "sale_price", "status"],
}
PRODUCT_COLUMNS = ["id", "category"]
FLAT_COLUMNS = [
    "order_id",
    "customer_id",
    "order_date",
    "category",
    "product_id",
    "quantity",
    "unit_price",
    "returned",
]
RETURNED_STATUS = "returned"
INCOMING = "incoming/"
VALIDATED = "validated/"
PROCESSED = "processed/"
PRODUCTS = "static/"

# Source and type of the event that starts a pipeline run.
EVENT_SOURCE = "custom.s3.upload"
EVENT_DETAIL_TYPE = "StartEphemeralPipeline"

# Verdicts of the file gate.
VALID = "valid"
MISSING_COLUMNS = "missing_columns"
EMPTY = "empty"
UNREADABLE = "unreadable"
REJECTED_ROWS = "rejected_rows"

FLAT_TYPE = "flat_orders"

MONEY = "decimal(10,2)"
EXACT_PRICE = "decimal(18,6)"
TOTAL = "decimal(30,2)"

_text, _day, _time = T.StringType(), T.DateType(), T.TimestampType()
_texts = T.ArrayType(_text)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


CATEGORY_KPI_KEYS = ["category", "order_date"]
CATEGORY_KPI = _struct(
    category=_text,
    order_date=_day,
    daily_revenue=T.DecimalType(30, 2),
    avg_order_value=T.DoubleType(),
    avg_return_rate=T.DoubleType(),
)

ORDER_KPI_KEYS = ["order_date"]
ORDER_KPI = _struct(
    order_date=_day,
    total_orders=T.LongType(),
    total_revenue=T.DecimalType(30, 2),
    total_items_sold=T.LongType(),
    return_rate=T.DoubleType(),
    unique_customers=T.LongType(),
)

LEDGER = _struct(path=_text, modified_at=_time, file_key=_text, processed_at=_time)
# A file is what lies at a path since a time; its key is a label, which two files may share.
FILE_IDENTITY = ["path", "modified_at"]

GATE_LOG = _struct(
    file_type=_text,
    path=_text,
    file_key=_text,
    verdict=_text,
    missing=_texts,
    problems=_texts,
    n_rows=T.LongType(),
    header=_texts,
    multiline=T.BooleanType(),
    length=T.LongType(),
    modified_at=_time,
    dt=_day,
    run_id=_text,
)

ARCHIVE_LINES = _struct(
    source_file=_text,
    block_start=T.LongType(),
    line_id=T.LongType(),
    value=_text,
    file_type=_text,
    verdict=_text,
    dt=_day,
    run_id=_text,
)

# Partial sums of processed rows. Sums of several rows of one key add up.
_month = {"order_month": _text}
_sum = {"order_revenue": T.DecimalType(30, 2), "n_lines": T.LongType()}
ITEM_PARTS = _struct(
    order_id=_text,
    product_id=_text,
    order_date=_day,
    order_value=T.DecimalType(30, 2),
    n_lines=T.LongType(),
    returned_flag=T.IntegerType(),
    **_month,
)
ORDER_PARTS = _struct(
    order_id=_text,
    user_id=_text,
    order_date=_day,
    n_rows=T.LongType(),
    n_items=T.LongType(),
    n_returned=T.LongType(),
    **_month,
)
REVENUE_PARTS = _struct(order_id=_text, order_date=_day, **_sum, **_month)
# By order id, in order of `place`.
ORDER_DAYS = _struct(place=_text, order_id=_text, order_date=_day)
WAITING_ITEMS = _struct(place=_text, order_id=_text, **_sum)

_RUN = {"dt": _day, "run_id": _text, "order_month": _text}
CLEAN_ROWS = {
    "orders": _struct(
        order_id=_text,
        user_id=_text,
        status=_text,
        order_date=_day,
        num_of_item=T.IntegerType(),
        rejects=_texts,
        source_file=_text,
        **_RUN,
    ),
    "order_items": _struct(
        order_id=_text,
        product_id=_text,
        status=_text,
        order_date=_day,
        sale_price=T.DecimalType(10, 2),
        is_returned=T.BooleanType(),
        rejects=_texts,
        source_file=_text,
        **_RUN,
    ),
}

CLEAN_FLAT = _struct(
    order_id=_text,
    customer_id=_text,
    order_date=_day,
    category=_text,
    product_id=_text,
    quantity=T.IntegerType(),
    unit_price=T.DecimalType(18, 6),
    returned=T.BooleanType(),
    source_file=_text,
    **_RUN,
)

REJECTED_FLAT = _struct(
    **{name: _text for name in FLAT_COLUMNS},
    source_file=_text,
    reasons=_texts,
    dt=_day,
    run_id=_text,
)

_named = _struct(name=_text)
_keyed = _struct(key=_text)
NOTIFICATION = _struct(Records=T.ArrayType(_struct(s3=_struct(bucket=_named, object=_keyed))))

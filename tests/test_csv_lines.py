import pytest
from pyspark.sql import functions as F

from daybook.functions.csv_lines import field_count, has_open_quote, header_names


@pytest.mark.parametrize(
    "line, fields, is_open",
    [
        ("a,b,c", 3, False),
        ("", 1, False),
        (",,", 3, False),
        ('"a,b",c', 2, False),
        ('x,"a ""b"", c",d', 3, False),
        ('5" screen,7" tablet', 2, False),
        ('1,"text goes on', 2, True),
        ('"whole line', 1, True),
        ('1,"done, really",2,"open, ', 5, True),
    ],
)
def test_fields_of_a_line(spark, line, fields, is_open):
    df = spark.createDataFrame([(line,)], "value string")
    row = df.select(field_count(F.col("value")), has_open_quote(F.col("value"))).first()
    # An open field still counts the separators after its quote.
    assert tuple(row) == (fields, is_open)


@pytest.mark.parametrize(
    "line, names",
    [
        ("order_id,user_id", ["order_id", "user_id"]),
        (",order_id", ["", "order_id"]),
        ("order_id,", ["order_id", ""]),
        ('"order_id","a, b","say ""x"""', ["order_id", "a, b", 'say "x"']),
        (" order_id ,Order_ID", [" order_id ", "Order_ID"]),
        ("﻿order_id,b", ["order_id", "b"]),
    ],
)
def test_header(spark, line, names):
    df = spark.createDataFrame([(line,)], "value string")
    assert df.select(header_names(F.col("value"))).first()[0] == names


def test_a_very_long_quoted_field(spark):
    line = "1," + '"' + 'ab""' * 200_000 + '",2'
    df = spark.createDataFrame([(line,)], "value string")
    assert df.select(field_count(F.col("value"))).first()[0] == 3

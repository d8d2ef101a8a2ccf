"""Column maps that give any source table the names the operators expect."""

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Binding:
    """Canonical column name -> SQL expression over the source table."""

    columns: Mapping[str, str]

    def apply(self, source: DataFrame) -> DataFrame:
        return source.select(*[F.expr(sql).alias(name) for name, sql in self.columns.items()])


# The star schema of the test tables. Order status F stands in for a returned
# order, return flag R for a returned item, and the brand for the category.
STAR_ORDERS = Binding(
    {
        "order_id": "o_orderkey",
        "user_id": "o_custkey",
        "created_at": "o_orderdate",
        "status": "if(o_orderstatus = 'F', 'returned', o_orderstatus)",
    }
)
STAR_ITEMS = Binding(
    {
        "order_id": "l_orderkey",
        "product_id": "l_partkey",
        "created_at": "l_shipdate",
        "sale_price": "l_extendedprice",
        "status": "if(l_returnflag = 'R', 'returned', l_returnflag)",
    }
)
STAR_PRODUCTS = Binding({"id": "p_partkey", "category": "p_brand"})

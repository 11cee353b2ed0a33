"""An image catalog derived from ``orders`` (one image per order, country
from the customer's nation), used by the registered catalog queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orders_catalog(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Catalog rows: ``image_id, collection, start_time, end_time, country,
    year, forecast_hours``.  Two equi-joins; the planner broadcasts the sides
    whose measured size is under the broadcast threshold (nation always is)
    and sort-merges otherwise."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = customer.select("c_custkey", "c_nationkey")
    n = nation.select("n_nationkey", "n_name")
    k = F.col("o_orderkey")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
            .select(F.concat(F.lit("img/"), k.cast("string")).alias("image_id"),
                    F.col("o_orderpriority").alias("collection"),
                    F.col("o_orderdate").alias("start_time"),
                    (F.col("o_orderdate") + F.make_dt_interval(days=(k % 2).cast("int"))).alias("end_time"),
                    F.col("n_name").alias("country"),
                    F.year("o_orderdate").alias("year"),
                    ((k % 129) * 3).cast("int").alias("forecast_hours")))

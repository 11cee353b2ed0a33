"""Registered slice-replace queries: each loads a whole driver table into a
partitioned table under the shared checkpoint folder, replaces one slice with
a revised version, and returns the table as read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rastertab.operators.cells import CELL_KEY_COLUMN, with_cell_key, within_box
from rastertab.operators.pixels import expand_pixels
from rastertab.plans.raster_queries import _EMB_BOX, _POINT_SQL, EMB_LAYOUT
from rastertab.plans.registry import register
from rastertab.session import scratch_path
from rastertab.sinks.tables import (create_database, create_or_replace_view, detached, query_to_table, replace_listed_slices,
                                    replace_partition, temp_table, truncate_load)
from rastertab.sources.driver_tables import embedding_tiles, read_table


def _table(spark, kind: str) -> tuple[str, str]:
    name = f"rt_{kind}_{uuid.uuid4().hex[:10]}"
    return name, scratch_path(spark, kind)


# --------------------------------------------------------------------------- SNK-5 (cycle partitions)
SLICE_MONTH = "1995-06-01 00:00:00"
_ORDERS_MONTHLY = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
           CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS creation_time
    FROM orders
"""


def _orders_monthly(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.withColumn("creation_time", F.date_trunc("month", F.col("o_orderdate")).cast("timestamp_ntz"))


def _revise_orders(df):
    return (df.withColumn("o_totalprice", F.round(F.col("o_totalprice") * 1.1, 2))
            .withColumn("o_orderstatus", F.lit("F")))


@register("slice_replace_time", ["SNK-5", "FLT-4", "SNK-3", "SNK-9b", "SNK-9d"], f"""
    SELECT * FROM ({_ORDERS_MONTHLY}) WHERE creation_time <> TIMESTAMP '{SLICE_MONTH}'
    UNION ALL
    SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, round(o_totalprice * 1.1, 2) AS o_totalprice,
           o_orderdate, o_orderpriority, creation_time
    FROM ({_ORDERS_MONTHLY}) WHERE creation_time = TIMESTAMP '{SLICE_MONTH}'
""")
def slice_replace_time(spark, sf_dir):
    name, loc = _table(spark, "cycles")
    monthly = _orders_monthly(spark, sf_dir)
    truncate_load(monthly, name, partition_by=("creation_time",), cluster_by=("o_orderkey",), location=loc)
    revised = _revise_orders(monthly.where(F.col("creation_time") == F.lit(SLICE_MONTH).cast("timestamp_ntz")))
    replace_partition(spark, revised, name, {"creation_time": SLICE_MONTH})
    return detached(spark, name)


# --------------------------------------------------------------------------- SNK-4 (year partition)
SLICE_YEAR = 1996
_ORDERS_YEARLY = "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders"


@register("partition_truncate_load", ["SNK-4", "SNK-9c"], f"""
    SELECT * FROM ({_ORDERS_YEARLY}) WHERE year <> {SLICE_YEAR}
    UNION ALL
    SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, round(o_totalprice * 1.1, 2) AS o_totalprice,
           o_orderdate, o_orderpriority, year
    FROM ({_ORDERS_YEARLY}) WHERE year = {SLICE_YEAR}
""")
def partition_truncate_load(spark, sf_dir):
    name, loc = _table(spark, "years")
    yearly = read_table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    truncate_load(yearly, name, partition_by=("year",), location=loc)
    revised = _revise_orders(yearly.where(F.col("year") == SLICE_YEAR))
    replace_partition(spark, revised, name, {"year": SLICE_YEAR})
    return detached(spark, name)


# --------------------------------------------------------------------------- SNK-6 (two-key slice, MERGE ON FALSE)
SLICE_NATION, SLICE_SEGMENT = 7, "BUILDING"


@register("slice_replace_two_key", ["SNK-6", "FLT-5", "JN-1", "UNI-1"], f"""
    SELECT * FROM customer WHERE NOT (c_nationkey = {SLICE_NATION} AND c_mktsegment = '{SLICE_SEGMENT}')
    UNION ALL
    SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal + 100.0 AS c_acctbal, c_mktsegment
    FROM customer WHERE c_nationkey = {SLICE_NATION} AND c_mktsegment = '{SLICE_SEGMENT}'
""")
def slice_replace_two_key(spark, sf_dir):
    name, loc = _table(spark, "slices")
    cust = read_table(spark, sf_dir, "customer")
    truncate_load(cust, name, partition_by=("c_nationkey", "c_mktsegment"), location=loc)
    # the revised source covers every slice; MERGE semantics keep only the target slice
    revised = cust.withColumn("c_name", F.upper("c_name")).withColumn("c_acctbal", F.col("c_acctbal") + 100.0)
    replace_partition(spark, revised, name, {"c_nationkey": SLICE_NATION, "c_mktsegment": SLICE_SEGMENT},
                      on_foreign_rows="ignore")
    return detached(spark, name).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@register("slice_replace_empty", ["SNK-6"], f"""
    SELECT * FROM customer WHERE NOT (c_nationkey = {SLICE_NATION} AND c_mktsegment = '{SLICE_SEGMENT}')
""")
def slice_replace_empty(spark, sf_dir):
    name, loc = _table(spark, "slices")
    cust = read_table(spark, sf_dir, "customer")
    truncate_load(cust, name, partition_by=("c_nationkey", "c_mktsegment"), location=loc)
    # a reload whose source slice is empty removes the slice
    empty_slice = cust.where((F.col("c_nationkey") == SLICE_NATION) & (F.col("c_mktsegment") == SLICE_SEGMENT)
                             & (F.col("c_acctbal") > F.lit(1e300)))
    replace_partition(spark, empty_slice, name, {"c_nationkey": SLICE_NATION, "c_mktsegment": SLICE_SEGMENT})
    return detached(spark, name).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@register("slice_read", ["FLT-4", "FLT-5", "SNK-9c"], f"""
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
    WHERE year(o_orderdate) = {SLICE_YEAR}
""")
def slice_read(spark, sf_dir):
    """Reading one slice of a year-partitioned table prunes to its folder
    (``PartitionFilters``); only the selected columns are read."""
    name, loc = _table(spark, "years")
    yearly = read_table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    truncate_load(yearly, name, partition_by=("year",), location=loc)
    return detached(spark, name).where(F.col("year") == SLICE_YEAR).select("o_orderkey", "o_totalprice", "year")


BOX = (-100.0, 88.5, 20.0, 89.5)


@register("box_read", ["SNK-9d", "SRT-2", "SNK-3"], f"""
    SELECT {_POINT_SQL} AS geography, vec_id, value, gx, gy FROM ({_EMB_BOX})
    WHERE gx BETWEEN {BOX[0]} AND {BOX[2]} AND gy BETWEEN {BOX[1]} AND {BOX[3]}
""")
def box_read(spark, sf_dir):
    """All pixels in a table laid out by cell key, and a box of them: the key
    ranges skip files and row groups, the exact comparison follows."""
    name, loc = _table(spark, "cells")
    tiles = embedding_tiles(read_table(spark, sf_dir, "embeddings"))
    px = expand_pixels(tiles, EMB_LAYOUT, with_coords=True, keep=("vec_id",)).select("geography", "vec_id", "value", "gx", "gy")
    truncate_load(with_cell_key(px), name, cluster_by=(CELL_KEY_COLUMN,), location=loc)
    return within_box(detached(spark, name), *BOX).drop(CELL_KEY_COLUMN)


LISTED_NATIONS = (1, 2, 3)


@register("slice_replace_listed", ["SNK-6", "FLT-5", "SNK-14", "UNI-1"], f"""
    SELECT * FROM customer WHERE c_nationkey NOT IN {LISTED_NATIONS}
    UNION ALL
    SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal + 100.0 AS c_acctbal, c_mktsegment
    FROM customer WHERE c_nationkey IN (1, 2)
""")
def slice_replace_listed(spark, sf_dir):
    """Several slices in one job: the revised source covers nations 1 and 2
    (and others, ignored); nation 3 is listed but has no source rows, so its
    slice is cleared."""
    name, loc = _table(spark, "nations")
    cust = read_table(spark, sf_dir, "customer")
    truncate_load(cust, name, partition_by=("c_nationkey",), location=loc)
    revised = (cust.where(F.col("c_nationkey") != 3).withColumn("c_name", F.upper("c_name"))
               .withColumn("c_acctbal", F.col("c_acctbal") + 100.0))
    replace_listed_slices(spark, revised, name, "c_nationkey", list(LISTED_NATIONS))
    return detached(spark, name).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


# --------------------------------------------------------------------------- queries into tables, views
@register("tables_and_views", ["SNK-7", "SNK-11", "SNK-12", "SNK-13"], """
    SELECT o_custkey, n, cents FROM (
        SELECT o_custkey, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY o_custkey)
    WHERE n > 1
""")
def tables_and_views(spark, sf_dir):
    """A script-scoped table, a query into a destination table, a view over it
    (defined twice: the second replaces the first); what the view gives is
    copied out before the names are dropped."""
    database, script = f"rt_db_{uuid.uuid4().hex[:10]}", f"rt_orders_{uuid.uuid4().hex[:10]}"
    create_database(spark, database, scratch_path(spark, "database"))
    temp_table(read_table(spark, sf_dir, "orders"), script)
    query_to_table(spark, f"SELECT o_custkey, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM {script} "
                          "GROUP BY o_custkey", f"{database}.totals")
    for least in (5, 1):
        create_or_replace_view(spark, f"SELECT * FROM {database}.totals WHERE n > {least}", f"{database}.several")
    rows, path = spark.table(f"{database}.several"), scratch_path(spark, "view")
    rows.write.parquet(path)
    spark.catalog.dropTempView(script)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.read.schema(rows.schema).parquet(path)

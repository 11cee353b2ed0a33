"""Registered catalog, filter, schema, projection and nesting queries over
the driver's relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastertab.functions.text import basename, extension, first_field, flatten_lists, strip_extension
from rastertab.functions.timefns import cycle_time_col, epoch_millis_to_text
from rastertab.operators.filters import include_exclude, pending, plan_exports
from rastertab.operators.nest import duplicate_elements, ordered_nest, ordered_nest_chunked, scale_values, unnest, unnest_chunks
from rastertab.plans.registry import register
from rastertab.sources import catalog as cat
from rastertab.sources.driver_catalog import orders_catalog
from rastertab.sources.driver_tables import read_table
from rastertab.sources.schemas import conform, enforce_required, read_declared, required_violations, to_struct

_CATALOG_SQL = """
    SELECT 'img/' || CAST(o_orderkey AS VARCHAR) AS image_id, o_orderpriority AS collection,
           o_orderdate AS start_time, o_orderdate + to_days(CAST(o_orderkey % 2 AS INTEGER)) AS end_time,
           n_name AS country, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST((o_orderkey % 129) * 3 AS INTEGER) AS forecast_hours
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""


def _catalog(spark, sf_dir):
    t = lambda n: read_table(spark, sf_dir, n)
    return orders_catalog(t("orders"), t("customer"), t("nation"))


CYCLE_DATE = "1996-03-15 00:00:00"
COUNTRY, YEAR = "NATION_7", 1997
HORIZON_FROM, HORIZON_HOURS = "2000-01-01 00:00:00", 6


@register("catalog_exact", ["SRC-1a", "SRC-1c"],
          f"SELECT * FROM ({_CATALOG_SQL}) WHERE start_time = TIMESTAMP '{CYCLE_DATE}' AND end_time = TIMESTAMP '{CYCLE_DATE}'")
def catalog_exact(spark, sf_dir):
    return cat.select_cycle(_catalog(spark, sf_dir), CYCLE_DATE)


@register("catalog_attr", ["SRC-1b"], f"SELECT * FROM ({_CATALOG_SQL}) WHERE country = '{COUNTRY}' AND year = {YEAR}")
def catalog_attr(spark, sf_dir):
    return cat.select_country_year(_catalog(spark, sf_dir), COUNTRY, YEAR)


@register("catalog_range", ["SRC-1d"],
          f"SELECT * FROM ({_CATALOG_SQL}) WHERE start_time >= TIMESTAMP '{HORIZON_FROM}' AND forecast_hours = {HORIZON_HOURS}")
def catalog_range(spark, sf_dir):
    return cat.select_from_horizon(_catalog(spark, sf_dir), HORIZON_FROM, HORIZON_HOURS)


@register("catalog_year", ["SRC-1e"], f"SELECT * FROM ({_CATALOG_SQL}) WHERE year = {YEAR}")
def catalog_year(spark, sf_dir):
    return cat.select_year(_catalog(spark, sf_dir), YEAR)


@register("catalog_all", ["SRC-1f", "SRC-1g"], f"SELECT * FROM ({_CATALOG_SQL})")
def catalog_all(spark, sf_dir):
    return cat.require_nonempty(cat.select_all(_catalog(spark, sf_dir)))


INCLUDE = "small ring,red widget,blue bolt,hot gear"
EXCLUDE = "red widget"


@register("include_exclude", ["FLT-1", "FLT-2", "SCL-13"], f"""
    SELECT p_partkey, p_name, p_size FROM part
    WHERE p_name IN ({', '.join(repr(s) for s in INCLUDE.split(','))})
      AND p_name NOT IN ({', '.join(repr(s) for s in EXCLUDE.split(','))})
""")
def include_exclude_query(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return include_exclude(part, F.col("p_name"), INCLUDE, EXCLUDE)


@register("pending_outputs", ["FLT-3", "JN-2", "SRC-6"], """
    SELECT doc_id, 'doc_' || CAST(doc_id AS VARCHAR) AS name FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality > 0)
""")
def pending_outputs(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("name"))
    # the output listing: one object per labelled document, its size = quality flag
    listing = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("long").alias("length"))
    return pending(docs, listing, "doc_id")


@register("export_plan", ["FLT-3", "JN-2", "SRC-6"], """
    SELECT 'doc_' || CAST(d.doc_id AS VARCHAR) AS name,
           r.doc_id IS NULL AS needs_download, o.doc_id IS NULL AS needs_convert
    FROM documents d
    LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality > 0) r ON r.doc_id = d.doc_id
    LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE toxic > 0) o ON o.doc_id = d.doc_id
    WHERE r.doc_id IS NULL OR o.doc_id IS NULL
""")
def export_plan(spark, sf_dir):
    """Two independent skip checks per document: a raster listing (size =
    quality flag) and an output listing (size = toxic flag)."""
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("name")
    docs = read_table(spark, sf_dir, "documents").select(name)
    labels = read_table(spark, sf_dir, "labels")
    rasters = labels.select(name, F.col("quality").cast("long").alias("length"))
    outputs = labels.select(name, F.col("toxic").cast("long").alias("length"))
    return plan_exports(docs, rasters, outputs)


@register("path_slices", ["SRC-9", "SCL-14"], """
    SELECT event_id,
           'out/gfs/date=' || strftime(ts - INTERVAL 4 HOUR, '%Y-%m-%d') || '/' || strftime(ts - INTERVAL 4 HOUR, '%H')
               || '/parquet/' AS forecast_prefix,
           'gfs_' || strftime(ts - INTERVAL 4 HOUR, '%Y%m%d%H') AS staging_table,
           'out/annual_npp/parquet/' || strftime(ts, '%Y_%m_%d') || '.parquet' AS productivity_file,
           'out/world_pop/year=' || strftime(ts, '%Y') || '/parquet/' || event_type || '_' || strftime(ts, '%Y')
               || '.parquet' AS population_file,
           CAST(CAST(ts - INTERVAL 4 HOUR AS DATE) AS VARCHAR) AS parsed_date,
           CAST(strftime(ts - INTERVAL 4 HOUR, '%H') AS INTEGER) AS parsed_hour,
           event_type AS parsed_country, CAST(year(ts) AS INTEGER) AS parsed_year
    FROM events
""")
def path_slices(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    cyc = cycle_time_col(F.col("ts"))
    paths = ev.select(
        "event_id",
        cat.forecast_prefix_col("out", cyc).alias("forecast_prefix"),
        F.concat(F.lit("gfs_"), F.date_format(cyc, "yyyyMMddHH")).alias("staging_table"),
        cat.productivity_file_col("out", F.col("ts")).alias("productivity_file"),
        cat.population_file_col("out", F.col("event_type"), F.year("ts")).alias("population_file"))
    d, h = cat.forecast_slice_from_path(F.col("forecast_prefix"))
    c, y = cat.population_slice_from_path(F.col("population_file"))
    return paths.select("*", d.cast("string").alias("parsed_date"), h.alias("parsed_hour"), c.alias("parsed_country"),
                        y.alias("parsed_year"))


@register("page_names", ["SCL-13", "RAS-12"], r"""
    SELECT page_id, url,
           string_split(url, '/')[-1] AS base_name,
           regexp_replace(string_split(url, '/')[-1], '\.[^./]*$', '') AS stem,
           string_split(string_split(url, '/')[-1], '.')[-1] AS ext,
           string_split(lower(string_split(url, '/')[-1]), '_')[1] AS first_field
    FROM pages
""")
def page_names(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    b = basename(F.col("url"))
    return pages.select("page_id", "url", b.alias("base_name"), strip_extension(b).alias("stem"),
                        extension(b).alias("ext"), first_field(F.lower(b)).alias("first_field"))


@register("flat_lists", ["SCL-16"], """
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n, array_to_string(w, '|') AS joined
    FROM (SELECT doc_id, flatten(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: string_split(x, ' '))) AS w FROM documents)
""")
def flat_lists(spark, sf_dir):
    """Lists of the words of each line, as one list."""
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", flatten_lists(F.transform(lines, lambda x: F.split(x, " "))).alias("w"))
    return docs.select("doc_id", F.size("w").cast("long").alias("n"), F.array_join("w", "|").alias("joined"))


# --------------------------------------------------------------------------- schema operators
ORDERS_DECLARED = [
    {"name": "o_orderkey", "type": "INTEGER", "mode": "REQUIRED"},
    {"name": "O_CUSTKEY", "type": "INTEGER"},
    {"name": "o_totalprice", "type": "FLOAT", "mode": "REQUIRED", "description": "order total"},
    {"name": "o_orderdate", "type": "DATETIME", "mode": "REQUIRED"},
    {"name": "o_shippriority", "type": "INTEGER", "mode": "NULLABLE"},
]


@register("ignore_unknown", ["SCH-1", "SCH-5", "SCH-7", "SRC-4", "SRC-5"], """
    SELECT o_orderkey, o_custkey AS O_CUSTKEY, o_totalprice, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate,
           CAST(NULL AS BIGINT) AS o_shippriority
    FROM orders
""")
def ignore_unknown(spark, sf_dir):
    schema = to_struct(ORDERS_DECLARED)
    return read_declared(spark, f"{sf_dir.rstrip('/')}/orders.parquet", schema)


_STATUS_DECLARED = [
    {"name": "o_orderkey", "type": "INTEGER", "mode": "REQUIRED"},
    {"name": "o_orderstatus", "type": "STRING", "mode": "REQUIRED"},
    {"name": "o_orderpriority", "type": "STRING", "mode": "REQUIRED"},
    {"name": "o_comment", "type": "STRING", "mode": "REQUIRED"},
]


@register("required_violations", ["SCH-6"], """
    SELECT CAST(count(*) AS BIGINT) AS rows,
           CAST(sum(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_o_orderkey,
           CAST(sum(CASE WHEN nullif(o_orderstatus, 'P') IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_o_orderstatus,
           CAST(sum(CASE WHEN o_orderpriority IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_o_orderpriority,
           CAST(count(*) AS BIGINT) AS null_o_comment
    FROM orders
""")
def required_violations_query(spark, sf_dir):
    schema = to_struct(_STATUS_DECLARED)
    orders = read_table(spark, sf_dir, "orders").withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'P')"))
    return required_violations(conform(orders, schema), schema)


@register("required_enforced", ["SCH-6"], """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
""")
def required_enforced(spark, sf_dir):
    schema = to_struct([{"name": "o_orderkey", "type": "INTEGER", "mode": "REQUIRED"},
                        {"name": "o_custkey", "type": "INTEGER", "mode": "REQUIRED"},
                        {"name": "o_totalprice", "type": "FLOAT"}])
    return enforce_required(conform(read_table(spark, sf_dir, "orders"), schema), schema)


# --------------------------------------------------------------------------- time
@register("epoch_ms", ["SCL-10"], """
    SELECT event_id, ms, make_timestamp(ms * 1000) AS from_ms,
           strftime(make_timestamp(CAST(floor(ms / 1000.0) AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S') AS ms_text
    FROM (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events)
""")
def epoch_ms(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return ev.select("event_id", ms.alias("ms"), F.timestamp_millis(ms).cast("timestamp_ntz").alias("from_ms"),
                     epoch_millis_to_text(ms).alias("ms_text"))


# --------------------------------------------------------------------------- AGG-1 at scale (lineitem)
_LINE_FIELDS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                "l_returnflag", "l_linestatus", "l_shipdate"]
_HOT_FIELDS = [c for c in _LINE_FIELDS if c != "l_returnflag"]
_LINE_ORDER_BY_KEY = ", ".join(f"{c} ASC NULLS FIRST" for c in ["l_orderkey", *_HOT_FIELDS])
_LINE_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in _LINE_FIELDS)


def _nested_lines(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return ordered_nest(li, ["l_orderkey"], _LINE_FIELDS[:1], _LINE_FIELDS[1:], "lines")


@register("nest_lineitems", ["AGG-1", "AGG-2", "SRT-1"], f"""
    SELECT l_orderkey, CAST(len(lines) AS BIGINT) AS n_lines,
           array_to_string(list_transform(lines, lambda e: CAST(e.l_linenumber AS VARCHAR)), ',') AS line_list,
           lines[1].l_partkey AS first_partkey, lines[-1].l_extendedprice AS last_extendedprice,
           CAST(sum_qty AS DOUBLE) AS sum_quantity
    FROM (SELECT l_orderkey, sum(l_quantity) AS sum_qty,
                 list({{'l_linenumber': l_linenumber, 'l_partkey': l_partkey, 'l_extendedprice': l_extendedprice}}
                      ORDER BY {_LINE_ORDER}) AS lines
          FROM lineitem GROUP BY l_orderkey)
""")
def nest_lineitems(spark, sf_dir):
    nested = _nested_lines(spark, sf_dir)
    lines = F.col("lines")
    return nested.select(
        "l_orderkey", F.size(lines).cast("bigint").alias("n_lines"),
        F.array_join(F.transform(lines, lambda e: e["l_linenumber"].cast("string")), ",").alias("line_list"),
        lines[0]["l_partkey"].alias("first_partkey"),
        F.element_at(lines, -1)["l_extendedprice"].alias("last_extendedprice"),
        F.aggregate(lines, F.lit(0.0), lambda acc, e: acc + e["l_quantity"]).alias("sum_quantity"))


@register("unnest_roundtrip", ["DRV-1", "AGG-1"], f"""
    SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) - 1 AS INTEGER) AS pos,
           {', '.join(_LINE_FIELDS)}
    FROM lineitem
""")
def unnest_roundtrip(spark, sf_dir):
    return unnest(_nested_lines(spark, sf_dir), "lines", keep=["l_orderkey"], position="pos")


@register("nest_chunked", ["AGG-1", "SRT-1"], f"""
    SELECT l_returnflag, row_number() OVER (PARTITION BY l_returnflag ORDER BY {_LINE_ORDER_BY_KEY}) - 1 AS pos,
           l_orderkey, {', '.join(_HOT_FIELDS)}
    FROM lineitem
""")
def nest_chunked(spark, sf_dir):
    """The nest for keys that may be hot: three keys share all lines.  Chunks of
    each key's ordered array, taken apart again with the elements' places."""
    li = read_table(spark, sf_dir, "lineitem")
    chunks = ordered_nest_chunked(li, ["l_returnflag"], ["l_orderkey"], _HOT_FIELDS, "lines")
    return unnest_chunks(chunks, ["l_returnflag"], "lines")


@register("nest_duplicates", ["AGG-1"], """
    SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def nest_duplicates(spark, sf_dir):
    """Report of elements that occur more than once in a cell's array."""
    return duplicate_elements(read_table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_linenumber"])


@register("scale_values", ["DRV-3"], """
    SELECT p_partkey, CAST(p_size AS BIGINT) AS npp, CAST(p_size AS DOUBLE) * 0.0001 AS npp_scaled FROM part
""")
def scale_values_query(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("bigint").alias("npp"))
    return scale_values(part, "npp", out="npp_scaled")

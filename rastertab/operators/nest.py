"""Staging projection and the ordered nesting aggregate (PRJ-1..3, AGG-1,
SRT-1, DRV-1..4, SCL-7..9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastertab.functions.timefns import hour_diff, to_datetime
from rastertab.functions.wkt import st_astext, st_geogfromtext
from rastertab.session import scratch_path
from rastertab.sources.schemas import FORECAST_FIELDS

CELL_KEY = ("creation_time", "geography", "geography_polygon")
PRECIP_FIELD = "total_precipitation_surface"
PRECIP_ACCUMULATED_FROM = "2019-11-07 06:00:00"  # fixed value: cycles from here accumulate from hour 0
NPP_SCALE = 0.0001  # fixed value: productivity scale factor


def stage_projection(staging: DataFrame) -> DataFrame:
    """PRJ-1: the typed 14-column projection of a forecast staging table.

    Geographies as text, civil times, and the forecast hour recovered from the
    time difference when it is missing (whole hours, truncated toward zero).
    """
    return staging.select(
        st_astext(F.col("geography")).alias("geography"),
        st_astext(F.col("geography_polygon")).alias("geography_polygon"),
        to_datetime(F.col("creation_time")).alias("creation_time"),
        F.coalesce(F.col("forecast_hours").cast("bigint"),
                   hour_diff(F.col("creation_time"), F.col("forecast_time"))).alias("forecast_hours"),
        to_datetime(F.col("forecast_time")).alias("forecast_time"),
        *[F.col(c).cast("double").alias(c) for c in FORECAST_FIELDS],
    )


def ordered_nest(df: DataFrame, keys, order_fields, payload_fields, name: str,
                 renames: dict[str, str] | None = None, range_by: str | None = None) -> DataFrame:
    """AGG-1 generic form: ``ARRAY_AGG(STRUCT(...) ORDER BY order_fields)``.

    ``sort_array`` orders structs field by field, so the order fields come first
    and the payload breaks ties deterministically; null order values sort first.
    One exchange on ``keys``; a group holds one cell's elements (bounded by
    the number of forecast hours, not by the data).  The rows are hash-
    partitioned on the keys *before* aggregating: a map-side partial
    ``collect_list`` shrinks nothing (it only re-encodes rows as lists), so the
    list building runs once, after the exchange, in every reduce task (AQE
    still coalesces small partitions).  ``range_by`` names one of the keys by
    whose ranges the rows are dealt instead, so that the one exchange also lays
    the result out (the bounds are sampled: the input is scanned twice).
    """
    renames = renames or {}
    fields = [F.col(c).alias(renames.get(c, c)) for c in (*order_fields, *payload_fields)]
    dealt = df.repartitionByRange(range_by) if range_by else df.repartition(*keys)
    return dealt.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))


def duplicate_elements(df: DataFrame, keys, order_fields) -> DataFrame:
    """Report of repeated elements: ``keys, order fields, n`` for every element
    that occurs more than once (duplicated input files).  Nothing is refused
    or dropped: the nest holds every element."""
    return df.groupBy(*keys, *order_fields).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def ordered_nest_chunked(df: DataFrame, keys, order_fields, payload_fields, name: str,
                         num_partitions: int | None = None, renames: dict[str, str] | None = None) -> DataFrame:
    """AGG-1 for keys that may be hot (one key may hold a large share of rows).

    Rows are range-partitioned on ``(keys, order fields)``: the sampled bounds
    cut a hot key's rows into several partitions, in order.  Each partition
    nests its own run of every key into one *chunk* (bounded by the partition
    size), so no task ever holds a whole hot group.  The chunks are written to
    the scratch folder once; their sizes, one small row each, give the rest: ``chunk`` numbers a key's chunks from 0, and ``first`` is the place
    of the chunk's first element in the key's whole ordered array, so an
    element's place is ``first`` plus its index (:func:`unnest_chunks`).
    Exchanges: the range partitioning, then one hash exchange of the
    per-partition lists (each list moves once), then the sizes.
    """
    renames = renames or {}
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = [*keys, *order_fields, *payload_fields]
    fields = [F.col(c).alias(renames.get(c, c)) for c in (*order_fields, *payload_fields)]
    parts = df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in ordered]) \
        .withColumn("_part", F.spark_partition_id())
    chunks = parts.groupBy(*keys, "_part").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))
    path = scratch_path(spark, "chunks")
    chunks.write.parquet(path)  # the bounds of a range are sampled: a second evaluation might cut elsewhere
    chunks = spark.read.schema(chunks.schema).parquet(path)
    own = Window.partitionBy(*keys).orderBy("_part")
    sizes = chunks.select(*keys, "_part", F.size(name).cast("long").alias("_n")).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_part").alias("_of"), (F.row_number().over(own) - 1).alias("chunk"),
        (F.sum("_n").over(own) - F.col("_n")).alias("first"))
    same = F.col("_part") == F.col("_of")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return chunks.join(sizes, same).select(*keys, "chunk", "first", name)


def unnest_chunks(chunks: DataFrame, keys, name: str, position: str = "pos") -> DataFrame:
    """Elements of chunked arrays with their places in the whole array."""
    rows = chunks.select(*keys, "first", F.posexplode(name).alias("_at", "_e"))
    return rows.select(*keys, (F.col("first") + F.col("_at")).alias(position), "_e.*")


def nest_forecast(projected: DataFrame) -> DataFrame:
    """AGG-1 + PRJ-2/3: one row per (creation_time, cell) with the forecast
    array ordered by hours, in destination column order."""
    nested = ordered_nest(projected, CELL_KEY, ["forecast_hours", "forecast_time"], FORECAST_FIELDS,
                          "forecast", renames={"forecast_hours": "hours", "forecast_time": "time"})
    return nested.select(
        "creation_time",
        st_geogfromtext(F.col("geography")).alias("geography"),
        st_geogfromtext(F.col("geography_polygon")).alias("geography_polygon"),
        "forecast",
    )


def unnest(df: DataFrame, array_col: str, keep=None, position: str | None = None) -> DataFrame:
    """DRV-1: nested array back to rows (``inline``), optionally with the
    element position (0-based)."""
    keep = [c for c in (keep or df.columns) if c != array_col]
    if position:
        return df.select(*keep, F.posexplode(array_col).alias(position, "_e")).select(*keep, position, "_e.*")
    return df.select(*keep, F.inline(array_col))


def deaccumulate(nested: DataFrame, array_col: str = "forecast", field: str = PRECIP_FIELD,
                 since: str = PRECIP_ACCUMULATED_FROM, out_field: str | None = None) -> DataFrame:
    """DRV-2: per-step precipitation from a running total.

    Works inside each nested array (``value[i]`` less the total before it, which
    is 0 when the step before has none, as hour 0), so no window and no second
    shuffle; the first element keeps its value, null included.  Cycles before
    ``since`` are not accumulated and keep their values.
    """
    out_field = out_field or f"{field}_step"
    arr = F.col(array_col)
    accumulated = F.col("creation_time") >= F.lit(since).cast("timestamp_ntz")
    step = F.transform(arr, lambda e, i: e.withField(out_field, F.when(
        accumulated & (i > 0), e[field] - F.coalesce(F.get(arr, i - 1)[field], F.lit(0.0))).otherwise(e[field])))
    return nested.withColumn(array_col, step)


def scale_values(df: DataFrame, col: str, factor: float = NPP_SCALE, out: str | None = None) -> DataFrame:
    """DRV-3: documented scale factor applied to an integer band."""
    return df.withColumn(out or f"{col}_scaled", F.col(col).cast("double") * F.lit(factor))


def forecast_time_consistent(creation_time: Column, hours: Column, forecast_time: Column) -> Column:
    """DRV-4: ``forecast_time = creation_time + hours``."""
    return forecast_time == creation_time + F.make_dt_interval(hours=hours.cast("int"))

"""Registered reprojection, streaming and derived-forecast queries."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastertab.operators.attributes import PixelLayout
from rastertab.operators.nest import deaccumulate, forecast_time_consistent, unnest
from rastertab.operators.reproject import DEG, SPHERE_RADIUS, reproject_tiles
from rastertab.plans.forecast import forecast_nested, forecast_staging
from rastertab.operators.nest import stage_projection
from rastertab.plans.raster_queries import _FC_ORDER, _FC_PROJ
from rastertab.plans.registry import register
from rastertab.session import scratch_path
from rastertab.sinks.tables import create_table, detached
from rastertab.sources.driver_tables import _checked_embedding, forecast_tiles, read_table
from rastertab.sources.tiles import with_year_from_name
from rastertab.streaming.incremental import day_slice, incremental_slice_load

# --------------------------------------------------------------------------- RAS-10
# Source: a sinusoidal grid of 600 x 296 pixels (0.6 degree at the equator,
# not commensurate with the target, so no cell centre sits on a pixel edge);
# vector v is the 8 x 8 block (v % 2775) of layer v div 2775.
# Target: a 1-degree WGS84 grid.
SRC_COLS, SRC_ROWS = 600, 296
SRC_PIXEL = 2.0 * math.pi * SPHERE_RADIUS / SRC_COLS
SRC_GT = (-math.pi * SPHERE_RADIUS, SRC_PIXEL, 0.0, math.pi * SPHERE_RADIUS / 2.0, 0.0, -SRC_PIXEL)
TGT_GT = (-180.0, 1.0, 0.0, 90.0, 0.0, -1.0)
TGT_COLS, TGT_ROWS = 360, 180
BLOCKS_PER_ROW, BLOCKS_PER_LAYER = SRC_COLS // 8, (SRC_COLS // 8) * (SRC_ROWS // 8)


def _sinusoidal_tiles(emb):
    slot = F.col("vec_id") % BLOCKS_PER_LAYER
    return emb.select(
        F.expr(f"vec_id div {BLOCKS_PER_LAYER}").alias("layer"),
        F.array(*[F.lit(g) for g in SRC_GT]).alias("gt"),
        (slot % BLOCKS_PER_ROW).cast("int").alias("ix"), F.expr(f"(vec_id % {BLOCKS_PER_LAYER}) div {BLOCKS_PER_ROW}").cast("int").alias("iy"),
        F.lit(8).alias("xblock"), F.lit(8).alias("yblock"),
        F.array(_checked_embedding()).alias("bands"), F.create_map().cast("map<string,string>").alias("meta"))


_R = repr(SPHERE_RADIUS)
_D = repr(DEG)


@register("reproject_nearest", ["RAS-10", "JN-3"], f"""
    WITH src AS (
      SELECT vec_id // {BLOCKS_PER_LAYER} AS layer,
             CAST(((vec_id % {BLOCKS_PER_LAYER}) % {BLOCKS_PER_ROW}) * 8 + pos % 8 AS BIGINT) AS sx,
             CAST(((vec_id % {BLOCKS_PER_LAYER}) // {BLOCKS_PER_ROW}) * 8 + pos // 8 AS BIGINT) AS sy,
             CAST(embedding[pos + 1] AS DOUBLE) AS value
      FROM (SELECT vec_id, embedding, unnest(generate_series(0, 63)) AS pos FROM embeddings)),
    cells AS (
      SELECT id % {TGT_COLS} AS tx, id // {TGT_COLS} AS ty,
             {TGT_GT[0]!r}::DOUBLE + (id % {TGT_COLS} + 0.5::DOUBLE) * {TGT_GT[1]!r}::DOUBLE
                 + (id // {TGT_COLS} + 0.5::DOUBLE) * {TGT_GT[2]!r}::DOUBLE AS lon,
             {TGT_GT[3]!r}::DOUBLE + (id % {TGT_COLS} + 0.5::DOUBLE) * {TGT_GT[4]!r}::DOUBLE
                 + (id // {TGT_COLS} + 0.5::DOUBLE) * {TGT_GT[5]!r}::DOUBLE AS lat
      FROM range(0, {TGT_COLS * TGT_ROWS}) t(id)),
    idx AS (
      SELECT tx, ty, lon, lat,
             CAST(floor(({_R}::DOUBLE * (lon * {_D}::DOUBLE) * cos(lat * {_D}::DOUBLE) - {SRC_GT[0]!r}::DOUBLE)
                        / {SRC_GT[1]!r}::DOUBLE) AS BIGINT) AS sx,
             CAST(floor(({_R}::DOUBLE * (lat * {_D}::DOUBLE) - {SRC_GT[3]!r}::DOUBLE) / {SRC_GT[5]!r}::DOUBLE) AS BIGINT) AS sy
      FROM cells)
    SELECT CAST(tx AS BIGINT) AS tx, CAST(ty AS BIGINT) AS ty, lon, lat, layer, value
    FROM idx JOIN src ON idx.sx = src.sx AND idx.sy = src.sy
    WHERE idx.sx >= 0 AND idx.sx < {SRC_COLS} AND idx.sy >= 0 AND idx.sy < {SRC_ROWS}
""")
def reproject_query(spark, sf_dir):
    tiles = _sinusoidal_tiles(read_table(spark, sf_dir, "embeddings"))
    return reproject_tiles(tiles, PixelLayout(("value",), "Float32"), SRC_GT, SRC_COLS, SRC_ROWS, TGT_GT, TGT_COLS, TGT_ROWS,
                           keep=("layer",), with_text=False, block_size=8)


@register("year_from_name", ["RAS-11", "RAS-12", "SCL-13"], """
    SELECT image_id, CAST(string_split(string_split(image_id, '/')[-1], '_')[1] AS INTEGER) AS year
    FROM (SELECT 'MOD17A3HGF/' || strftime(o_orderdate, '%Y_%m_%d') || '_' || CAST(o_orderkey AS VARCHAR) AS image_id
          FROM orders)
""")
def year_from_name(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    imgs = o.select(F.concat(F.lit("MOD17A3HGF/"), F.date_format("o_orderdate", "yyyy_MM_dd"), F.lit("_"),
                             F.col("o_orderkey").cast("string")).alias("image_id"),
                    F.create_map(F.lit("AREA_OR_POINT"), F.lit("Area")).alias("meta"))
    return with_year_from_name(imgs).select("image_id", F.col("meta")["year"].cast("int").alias("year"))


# --------------------------------------------------------------------------- DRV-2, DRV-4
@register("precip_deaccumulate", ["DRV-2"], f"""
    SELECT creation_time, geography, CAST(rn - 1 AS INTEGER) AS pos, forecast_hours AS hours,
           total_precipitation_surface,
           CASE WHEN creation_time >= TIMESTAMP '2019-11-07 06:00:00' AND rn > 1
                THEN total_precipitation_surface - coalesce(prev, 0) ELSE total_precipitation_surface END
               AS total_precipitation_surface_step
    FROM (SELECT *, row_number() OVER w AS rn, lag(total_precipitation_surface) OVER w AS prev
          FROM ({_FC_PROJ})
          WINDOW w AS (PARTITION BY creation_time, geography, geography_polygon ORDER BY {_FC_ORDER}))
""")
def precip_deaccumulate(spark, sf_dir):
    nested = deaccumulate(forecast_nested(forecast_tiles(read_table(spark, sf_dir, "embeddings"))))
    flat = unnest(nested, "forecast", keep=["creation_time", "geography"], position="pos")
    return flat.select("creation_time", "geography", "pos", "hours", "total_precipitation_surface",
                       "total_precipitation_surface_step")


@register("forecast_consistency", ["DRV-4"], f"""
    SELECT creation_time, CAST(count(*) AS BIGINT) AS n_rows,
           CAST(sum(CASE WHEN forecast_time = creation_time + to_hours(forecast_hours) THEN 1 ELSE 0 END) AS BIGINT)
               AS n_consistent
    FROM ({_FC_PROJ}) GROUP BY creation_time
""")
def forecast_consistency(spark, sf_dir):
    proj = stage_projection(forecast_staging(forecast_tiles(read_table(spark, sf_dir, "embeddings"))))
    ok = forecast_time_consistent(F.col("creation_time"), F.col("forecast_hours"), F.col("forecast_time"))
    return proj.groupBy("creation_time").agg(F.count(F.lit(1)).alias("n_rows"),
                                             F.sum(ok.cast("long")).alias("n_consistent"))


# --------------------------------------------------------------------------- STR-1, STR-2
@register("stream_slices", ["STR-1", "STR-2"], """
    SELECT event_id, ts, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d') AS day FROM events
""")
def stream_slices(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    name = f"rt_stream_{uuid.uuid4().hex[:10]}"
    schema = events.schema
    table_schema = T.StructType([*schema.fields, T.StructField("day", T.StringType())])  # new object: no mutation
    create_table(spark, name, table_schema, partition_by=("day",), location=scratch_path(spark, "stream"))
    incremental_slice_load(spark, sf_dir, schema, name, {"day": day_slice("ts")},
                           checkpoint=scratch_path(spark, "stream-ckpt"), glob="events.parquet", cluster_by=("event_id",))
    return detached(spark, name)

"""Registered queries that run the slice jobs over rows derived from the
driver tables, and return the tables the jobs made as read back."""

from __future__ import annotations

import math
import uuid
from datetime import datetime

from pyspark.sql import functions as F

from rastertab.functions.params import parameter
from rastertab.operators.attributes import PixelLayout
from rastertab.operators.nest import stage_projection
from rastertab.operators.pixels import expand_pixels
from rastertab.operators.reproject import DEG, SPHERE_RADIUS
from rastertab.plans.forecast import forecast_staging, nested_summary
from rastertab.plans.jobs import (convert_tiles, load_forecast_cycle, load_population_countries, load_population_slice,
                                  load_productivity_from_tiles, select_images)
from rastertab.plans.raster_queries import _EMB_BOX, _EMB_PX, _FC_PROJ, _POINT_SQL, _POLYGON_SQL, EMB_LAYOUT
from rastertab.plans.registry import register
from rastertab.plans.relational_queries import _CATALOG_SQL, _catalog
from rastertab.session import scratch_path
from rastertab.sinks.tables import detached
from rastertab.sources.catalog import forecast_folders, list_folders, population_folders, prefix_ready, ready_objects, single_wildcard
from rastertab.sources.driver_tables import (VECTORS_PER_IMAGE, _checked_embedding, embedding_tiles, forecast_tiles, read_table,
                                             write_embedding_rasters)
from rastertab.sources.schemas import read_declared, to_struct
from rastertab.sources.tiles import NpyRasterDecoder, read_raster_files, read_tiles, write_tiles


def _name(kind: str) -> str:
    return f"rt_{kind}_{uuid.uuid4().hex[:10]}"


# --------------------------------------------------------------------------- 3.1 forecast cycle
@register("stage_projection", ["PRJ-1", "SCL-7", "SCL-8", "SCL-9", "SCH-5"], f"SELECT * FROM ({_FC_PROJ})")
def stage_projection_query(spark, sf_dir):
    return stage_projection(forecast_staging(forecast_tiles(read_table(spark, sf_dir, "embeddings"))))


def _one_cycle_tiles(emb):
    """All vectors as hours of one cycle: every ten of them share a grid of
    their own, one degree wide and half a degree high."""
    created = F.unix_millis(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    tiles = forecast_tiles(emb)
    group_of = F.expr("CAST(substring(image_id, 5) AS BIGINT) div 10")
    ms = (created + F.col("meta")["forecast_time"].cast("bigint") - F.col("meta")["creation_time"].cast("bigint")).cast("string")
    meta = F.map_zip_with("meta", F.create_map(F.lit("creation_time"), created.cast("string"), F.lit("forecast_time"), ms),
                          lambda k, old, new: F.coalesce(new, old))
    return tiles.withColumns({
        "gt": F.array((F.lit(-180.0) + (group_of % 360)).cast("double"), F.lit(0.25), F.lit(0.0),
                      (F.lit(80.0) - F.expr("(CAST(substring(image_id, 5) AS BIGINT) div 10) div 360") * F.lit(0.5)).cast("double"),
                      F.lit(0.0), F.lit(-0.25)),
        "meta": meta})


_CYCLE_SQL = """
    SELECT printf('POINT(%.10g %.10g)', g0 + (x + 0.5) * 0.25, g3 - (y + 0.5) * 0.25) AS geography,
           printf('POLYGON ((%.10g %.10g, %.10g %.10g, %.10g %.10g, %.10g %.10g, %.10g %.10g))',
                  g0 + (x + 1) * 0.25, g3 - (y + 1) * 0.25, g0 + (x + 1) * 0.25, g3 - y * 0.25,
                  g0 + x * 0.25, g3 - y * 0.25, g0 + x * 0.25, g3 - (y + 1) * 0.25,
                  g0 + (x + 1) * 0.25, g3 - (y + 1) * 0.25) AS geography_polygon,
           TIMESTAMP '2024-01-01 00:00:00' AS creation_time, forecast_time,
           CASE WHEN vec_id % 7 = 0 THEN date_sub('hour', TIMESTAMP '2024-01-01 00:00:00', forecast_time) ELSE hour END AS forecast_hours,
           temperature_2m_above_ground
    FROM (SELECT vec_id, pos, pos % 4 AS x, pos // 4 AS y, (vec_id % 10) * 3 AS hour,
                 -180.0 + (vec_id // 10) % 360 AS g0, 80.0 - ((vec_id // 10) // 360) * 0.5 AS g3,
                 TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST((vec_id % 10) * 3 AS BIGINT))
                     + to_minutes(CAST((vec_id % 3) * 20 AS BIGINT)) AS forecast_time,
                 CAST(embedding[pos + 1] AS DOUBLE) AS temperature_2m_above_ground
          FROM (SELECT vec_id, embedding, unnest(generate_series(0, 7)) AS pos FROM embeddings))
"""


@register("job_forecast_cycle", ["SNK-3", "SNK-5", "SNK-8", "SNK-9a", "SNK-9b", "SNK-10", "AGG-1", "SRT-1", "PRJ-2", "PRJ-3",
                                 "SCH-5", "SCH-6", "SRC-3", "FLT-6", "FLT-7"], f"""
    SELECT creation_time, geography, geography_polygon, CAST(len(f) AS BIGINT) AS n_hours,
           array_to_string(list_transform(f, lambda e: CAST(e.hours AS VARCHAR)), ',') AS hours_list,
           f[1].t AS first_temperature, f[-1].t AS last_temperature, f[-1].time AS last_time
    FROM (SELECT creation_time, geography, geography_polygon,
                 list({{'hours': forecast_hours, 'time': forecast_time, 't': temperature_2m_above_ground}}
                      ORDER BY forecast_hours, forecast_time, temperature_2m_above_ground) AS f
          FROM ({_CYCLE_SQL}) GROUP BY creation_time, geography, geography_polygon)
""")
def job_forecast_cycle(spark, sf_dir):
    name = _name("fc")
    rows = forecast_staging(_one_cycle_tiles(read_table(spark, sf_dir, "embeddings")))
    [folder] = forecast_folders(scratch_path(spark, "arrived"), datetime(2024, 1, 1), datetime(2024, 1, 1))
    rows.write.parquet(folder)
    load_forecast_cycle(spark, f"{folder}*.parquet", name, datetime(2024, 1, 1), location=scratch_path(spark, "job-fc"), staging_db="default",
                        staging_location=scratch_path(spark, "job-fc-staging"))
    spark.sql(f"DROP TABLE IF EXISTS default.{name}_2024010100")
    return nested_summary(detached(spark, name))


# --------------------------------------------------------------------------- 3.2 population
def _people(spark, sf_dir):
    key = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer").select(
        F.concat(F.lit("POINT("), (key % 360 - 180).cast("string"), F.lit(" "), (key % 90).cast("string"), F.lit(")")).alias("geography"),
        F.concat(F.lit("cell "), key.cast("string")).alias("geography_polygon"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country"),
        (F.lit(2000) + key % 3).cast("int").alias("year"), F.col("c_acctbal").alias("population"))


_PEOPLE_SQL = """
    SELECT 'POINT(' || CAST(c_custkey % 360 - 180 AS VARCHAR) || ' ' || CAST(c_custkey % 90 AS VARCHAR) || ')' AS geography,
           'cell ' || CAST(c_custkey AS VARCHAR) AS geography_polygon, 'N' || CAST(c_nationkey AS VARCHAR) AS country,
           CAST(2000 + c_custkey % 3 AS BIGINT) AS year, c_acctbal AS population FROM customer
"""
_COUNTRIES = [f"N{i}" for i in range(25)]


@register("job_population_countries", ["SNK-6", "SNK-8", "SNK-9c", "SNK-14", "FLT-5", "FLT-7", "SCH-5", "SCH-6"], f"""
    SELECT * FROM ({_PEOPLE_SQL}) WHERE year <> 2001 OR country <> 'N9'
""")
def job_population_countries(spark, sf_dir):
    """All countries of every year; then the year 2001 again from a source that
    lacks one listed country, whose slice is cleared."""
    name, rows = _name("pop"), _people(spark, sf_dir)
    location = scratch_path(spark, "job-pop")
    for year in (2000, 2001, 2002):
        load_population_countries(spark, rows, name, year, _COUNTRIES, location=location)
    load_population_countries(spark, rows.where("country <> 'N9'"), name, 2001, ",".join(_COUNTRIES), location=location)
    return detached(spark, name).select("geography", "geography_polygon", "country", "year", "population")


@register("job_population_slice", ["SNK-6", "SNK-8", "FLT-4", "FLT-5", "JN-1", "SCH-5", "SCH-6"], f"""
    SELECT geography, geography_polygon, country, year,
           CASE WHEN year = 2002 AND country = 'N7' THEN population + 1 ELSE population END AS population
    FROM ({_PEOPLE_SQL}) WHERE NOT (year = 2000 AND country = 'N3')
""")
def job_population_slice(spark, sf_dir):
    """One slice revised from a source of all slices, one removed by an empty one."""
    name, rows = _name("pop"), _people(spark, sf_dir)
    location = scratch_path(spark, "job-pop")
    for year in (2000, 2001, 2002):
        load_population_countries(spark, rows, name, year, _COUNTRIES, location=location)
    load_population_slice(spark, rows.withColumn("population", F.col("population") + 1), name, "N7", 2002, location=location)
    load_population_slice(spark, rows.where("country <> 'N3'"), name, "N3", 2000, location=location)
    return detached(spark, name).select("geography", "geography_polygon", "country", "year", "population")


@register("job_population_files", ["SRC-3", "SRC-6", "SRC-7", "SRC-8", "SRC-9", "FLT-6", "FLT-7", "SCL-15", "SNK-6", "SNK-14"], f"""
    SELECT * FROM ({_PEOPLE_SQL})
""")
def job_population_files(spark, sf_dir):
    """The slices of a range of years arrive as files in the folders that the
    path template names; each ready folder is loaded by its one-wildcard pattern."""
    settings = {"first_year": "2000", "last_year": " 2003 ", "countries": ""}
    years = range(parameter(settings, "first_year", int), parameter(settings, "last_year", int) + 1)
    name, base, location = _name("pop"), scratch_path(spark, "arrived"), scratch_path(spark, "job-pop")
    for year in (2000, 2001, 2002):
        _people(spark, sf_dir).where(F.col("year") == year).write.parquet(population_folders(base, [year])[0])
    for year, folder in zip(years, population_folders(base, years)):
        files = ready_objects(list_folders(spark, [folder], "*.parquet"))
        if prefix_ready(spark, folder) and not files.isEmpty():  # 2003 has not arrived
            load_population_countries(spark, f"{folder}*.parquet", name, year, parameter(settings, "countries", str, _COUNTRIES),
                                      location=location)
    return detached(spark, name).select("geography", "geography_polygon", "country", "year", "population")


# --------------------------------------------------------------------------- 3.3 productivity
# Source: a sinusoidal grid of B x B blocks of 8 x 8 pixels, B the least number
# whose square holds all vectors; every vector is an image of its own.
# Target: a 1-degree WGS84 grid.
_X0, _Y0 = -math.pi * SPHERE_RADIUS, math.pi * SPHERE_RADIUS / 2.0
_TARGET, _TX, _TY = (-180.0, 1.0, 0.0, 90.0, 0.0, -1.0), 360, 180


@register("job_productivity_year", ["SNK-4", "SNK-8", "SNK-9c", "RAS-10", "RAS-11", "RAS-12", "JN-3", "SCL-1", "SCL-2", "SCH-5",
                                    "SCH-6"], f"""
    WITH n AS (SELECT CAST(ceil(sqrt(max(vec_id) + 1)) AS BIGINT) AS b FROM embeddings),
    g AS (SELECT b, {2 * math.pi * SPHERE_RADIUS!r}::DOUBLE / (8 * b) AS px, {math.pi * SPHERE_RADIUS!r}::DOUBLE / (8 * b) AS py FROM n),
    src AS (
      SELECT (vec_id % b) * 8 + pos % 8 AS sx, (vec_id // b) * 8 + pos // 8 AS sy,
             CAST(floor(CAST(embedding[pos + 1] AS DOUBLE) * 10000) AS BIGINT) AS npp, CAST(label AS BIGINT) AS npp_qc
      FROM (SELECT vec_id, embedding, label, unnest(generate_series(0, 63)) AS pos FROM embeddings), n),
    cells AS (SELECT -180.0::DOUBLE + (id % {_TX} + 0.5::DOUBLE) AS lon, 90.0::DOUBLE - (id // {_TX} + 0.5::DOUBLE) AS lat
              FROM range(0, {_TX * _TY}) t(id)),
    idx AS (
      SELECT lon, lat,
             CAST(floor(({SPHERE_RADIUS!r}::DOUBLE * (lon * {DEG!r}::DOUBLE) * cos(lat * {DEG!r}::DOUBLE) - {_X0!r}::DOUBLE) / px) AS BIGINT) AS sx,
             CAST(floor(({SPHERE_RADIUS!r}::DOUBLE * (lat * {DEG!r}::DOUBLE) - {_Y0!r}::DOUBLE) / -py) AS BIGINT) AS sy
      FROM cells, g)
    SELECT printf('POINT(%.10g %.10g)', lon, lat) AS geography,
           printf('POLYGON ((%.10g %.10g, %.10g %.10g, %.10g %.10g, %.10g %.10g, %.10g %.10g))', lon + 0.5, lat - 0.5,
                  lon + 0.5, lat + 0.5, lon - 0.5, lat + 0.5, lon - 0.5, lat - 0.5, lon + 0.5, lat - 0.5) AS geography_polygon,
           npp, npp_qc, CAST(2001 AS BIGINT) AS year
    FROM idx JOIN src USING (sx, sy)
""")
def job_productivity_year(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings")
    side = math.ceil(math.sqrt((emb.agg(F.max("vec_id")).first()[0] or 0) + 1))
    px, py = 2 * math.pi * SPHERE_RADIUS / (8 * side), math.pi * SPHERE_RADIUS / (8 * side)
    column, row = F.col("vec_id") % side, F.expr(f"vec_id div {side}")
    values = F.transform(_checked_embedding(), lambda v: F.floor(v * 10000).cast("double"))
    tiles = emb.select(
        F.concat(F.lit("MOD/2001_01_01_"), F.col("vec_id").cast("string")).alias("image_id"),
        F.array(F.lit(_X0) + column * 8 * F.lit(px), F.lit(px), F.lit(0.0), F.lit(_Y0) - row * 8 * F.lit(py), F.lit(0.0), F.lit(-py)).alias("gt"),
        F.lit(0).alias("ix"), F.lit(0).alias("iy"), F.lit(8).alias("xblock"), F.lit(8).alias("yblock"),
        F.array(values, F.array_repeat(F.col("label").cast("double"), 64)).alias("bands"),
        F.create_map().cast("map<string,string>").alias("meta"))
    name = _name("npp")
    load_productivity_from_tiles(spark, tiles, name, 2001, (_X0, px, 0.0, _Y0, 0.0, -py), 8 * side, 8 * side, _TARGET, _TX, _TY,
                                 block_size=8, location=scratch_path(spark, "job-npp"))
    return detached(spark, name).select("geography", "geography_polygon", "npp", "npp_qc", "year")


# --------------------------------------------------------------------------- converter
@register("convert_parquet", ["SNK-2", "SRC-3", "SRC-4", "SRC-8", "SCH-2", "SCH-5", "RAS-8"], f"""
    SELECT {_POINT_SQL} AS geography, {_POLYGON_SQL} AS geography_polygon,
           CASE WHEN vec_id % 3 < 2 THEN CAST(2000 + label AS BIGINT) END AS year,
           CASE WHEN vec_id % 3 = 0 THEN value END AS red, CASE WHEN vec_id % 3 > 0 THEN value END AS green,
           CASE WHEN vec_id % 3 = 1 THEN -value END AS blue
    FROM ({_EMB_BOX})
""")
def convert_parquet(spark, sf_dir):
    """Images of three schemas, one of them without any metadata, converted in
    one pass, then read by one wildcard with a declared schema."""
    tiles, kind = embedding_tiles(read_table(spark, sf_dir, "embeddings")), F.col("vec_id") % 3
    values = F.col("bands")[0]
    tiles = tiles.withColumns({
        "band_names": F.when(kind == 0, F.array(F.lit("red"))).when(kind == 1, F.array(F.lit("blue"), F.lit("green"))).otherwise(F.array(F.lit("green"))),
        "bands": F.when(kind == 1, F.array(F.transform(values, lambda v: -v), values)).otherwise(F.array(values)),
        "meta": F.when(kind < 2, F.col("meta"))})
    path = scratch_path(spark, "converted")
    convert_tiles(tiles, path)
    schema = to_struct([{"name": "geography", "type": "GEOGRAPHY", "mode": "REQUIRED"},
                        {"name": "geography_polygon", "type": "GEOGRAPHY", "mode": "REQUIRED"}, {"name": "year", "type": "INTEGER"},
                        *[{"name": n, "type": "FLOAT"} for n in ("red", "green", "blue")]])
    folder, leaf = single_wildcard(f"{path}/*.parquet")
    return read_declared(spark, f"{folder}/{leaf}", schema)


@register("tile_table_roundtrip", ["RAS-3", "RAS-4"], f"""
    SELECT 'emb_' || CAST(vec_id AS VARCHAR) AS image_id, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, value FROM ({_EMB_PX})
""")
def tile_table_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "tiles")
    write_tiles(embedding_tiles(read_table(spark, sf_dir, "embeddings")), path, partition_by=("band_type",))
    px = expand_pixels(read_tiles(spark, path), EMB_LAYOUT, with_text=False, with_coords=True, keep=("image_id",))
    return px.select("image_id", "x", "y", "value")


@register("decode_files", ["SRC-2", "RAS-1", "RAS-2", "RAS-3", "RAS-4", "RAS-12"], f"""
    SELECT CAST(vec_id // {VECTORS_PER_IMAGE} AS VARCHAR) || '_vectors' AS image_id,
           CAST((vec_id % {VECTORS_PER_IMAGE}) * 8 + x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, value, -value AS negative,
           CAST(2000 + vec_id // {VECTORS_PER_IMAGE} % 20 AS INTEGER) AS year
    FROM ({_EMB_PX})
""")
def decode_files(spark, sf_dir):
    """Raster files written from all vectors, then listed, decoded by strips
    into blocks of 64 pixels and expanded."""
    path = scratch_path(spark, "rasters")
    write_embedding_rasters(read_table(spark, sf_dir, "embeddings"), path)
    tiles = read_raster_files(spark, path, NpyRasterDecoder(), glob="*.npy", block_size=64)
    layout = PixelLayout(("value", "negative"), "Float32", (("year", "integer"),))
    px = expand_pixels(tiles, layout, block_size=64, with_text=False, with_coords=True, keep=("image_id",))
    return px.select("image_id", "x", "y", "value", "negative", "year")


# --------------------------------------------------------------------------- export planning
@register("select_images", ["SRC-1b", "SRC-1g", "SRC-6", "FLT-1", "FLT-2", "FLT-3", "JN-2", "RAS-12"], f"""
    SELECT image_id, collection, start_time, end_time, country, year, forecast_hours, name,
           o_orderstatus = 'P' AS needs_download, o_orderstatus <> 'F' AS needs_convert
    FROM (SELECT *, split_part(image_id, '/', 2) AS name FROM ({_CATALOG_SQL}) WHERE country = 'NATION_7' AND year = 1997)
    JOIN orders ON name = CAST(o_orderkey AS VARCHAR) WHERE o_orderstatus <> 'F'
""")
def select_images_query(spark, sf_dir):
    """Work planning from listings of what exists: rasters ``NAME.tif`` and
    outputs ``NAME.parquet``; an object without bytes counts as missing."""
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("name"), "o_orderstatus")

    def listing(folder: str, ext: str, present):
        return orders.select(F.concat(F.lit(f"store/{folder}/"), "name", F.lit(ext)).alias("path"),
                             F.when(present, 10).otherwise(0).cast("long").alias("length"))

    return select_images(_catalog(spark, sf_dir), "world_pop", country="NATION_7", year=1997,
                         rasters=listing("tif", ".tif", F.col("o_orderstatus") != "P"),
                         outputs=listing("parquet", ".parquet", F.col("o_orderstatus") == "F"))

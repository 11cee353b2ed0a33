"""Registered raster queries over rasters derived from ``embeddings`` / ``part``."""

from __future__ import annotations

from pyspark.sql import functions as F

from rastertab.operators.attributes import (PixelLayout, attribute_kind_col, band_kind_col,
                                            band_schema_type_col, band_spark_type_col, schema_string_col)
from rastertab.operators.nest import unnest
from rastertab.operators.pixels import expand_pixels
from rastertab.plans.forecast import forecast_nested, forecast_nested_late, nested_summary
from rastertab.plans.registry import register
from rastertab.sinks.csv_text import csv_lines
from rastertab.sources.driver_tables import (embedding_pair_tiles, embedding_tiles, forecast_tiles,
                                             part_images, read_table)
from rastertab.sources.tiles import image_blocks

EMB_LAYOUT = PixelLayout(("value",), "Float32", (("year", "integer"),))
PAIR_LAYOUT = PixelLayout(("first", "second"), "Float32", (("year", "integer"),))

# --------------------------------------------------------------------------- SQL building blocks
# Pixels of the 8 x 8 embedding tiles: position, column, row, value, grid origin.
_EMB_PX = """
    SELECT vec_id, label, pos, pos % 8 AS x, pos // 8 AS y,
           CAST(embedding[pos + 1] AS DOUBLE) AS value,
           -180.0 + CAST(vec_id % 180 AS DOUBLE) * 2.0 AS g0
    FROM (SELECT vec_id, label, embedding, unnest(generate_series(0, len(embedding) - 1)) AS pos FROM embeddings)
"""
_EMB_GEO = f"""
    SELECT *, g0 + (x + 0.5::DOUBLE) * 0.25::DOUBLE + (y + 0.5::DOUBLE) * 0.0::DOUBLE AS gx,
              90.0::DOUBLE + (x + 0.5::DOUBLE) * 0.0::DOUBLE + (y + 0.5::DOUBLE) * -0.25::DOUBLE AS gy
    FROM ({_EMB_PX})
"""
_EMB_BOX = f"""
    SELECT *, round_even(greatest(least(gx - 0.5 * 0.25, 180.0), -180.0) * 100000000.0, 0) / 100000000.0 AS min_x,
              round_even(greatest(least(gx + 0.5 * 0.25, 180.0), -180.0) * 100000000.0, 0) / 100000000.0 AS max_x,
              round_even(greatest(least(gy - 0.5 * 0.25, 90.0), -90.0) * 100000000.0, 0) / 100000000.0 AS min_y,
              round_even(greatest(least(gy + 0.5 * 0.25, 90.0), -90.0) * 100000000.0, 0) / 100000000.0 AS max_y
    FROM ({_EMB_GEO})
"""
_POINT_SQL = "printf('POINT(%.10g %.10g)', gx, gy)"
_POLYGON_SQL = ("printf('POLYGON ((%.10g %.10g, %.10g %.10g, %.10g %.10g, %.10g %.10g, %.10g %.10g))', "
                "max_x, min_y, max_x, max_y, min_x, max_y, min_x, min_y, max_x, min_y)")

# Forecast staging rows derived from embeddings (4 x 2 pixels, 8 bands).
_FC_STAGE = """
    SELECT vec_id, pos, pos % 4 AS x, pos // 4 AS y, cycle,
           TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(cycle * 6 AS BIGINT)) AS creation_time,
           CASE WHEN vec_id % 7 = 0 THEN NULL ELSE hour END AS raw_hours,
           TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(cycle * 6 + hour AS BIGINT))
               + to_minutes(CAST((vec_id % 3) * 20 AS BIGINT)) AS forecast_time,
           CAST(embedding[pos + 1] AS DOUBLE) AS temperature_2m_above_ground,
           CAST(embedding[pos + 9] AS DOUBLE) AS specific_humidity_2m_above_ground,
           CAST(embedding[pos + 17] AS DOUBLE) AS relative_humidity_2m_above_ground,
           CAST(embedding[pos + 25] AS DOUBLE) AS u_component_of_wind_10m_above_ground,
           CAST(embedding[pos + 33] AS DOUBLE) AS v_component_of_wind_10m_above_ground,
           CASE WHEN hour > 0 THEN CAST(embedding[pos + 41] AS DOUBLE) END AS total_precipitation_surface,
           CAST(embedding[pos + 49] AS DOUBLE) AS precipitable_water_entire_atmosphere,
           CAST(embedding[pos + 57] AS DOUBLE) AS total_cloud_cover_entire_atmosphere,
           CAST(NULL AS DOUBLE) AS downward_shortwave_radiation_flux
    FROM (SELECT vec_id, embedding, vec_id // 10 AS cycle, (vec_id % 10) * 3 AS hour,
                 unnest(generate_series(0, 7)) AS pos FROM embeddings)
"""
_FC_PROJ = f"""
    SELECT printf('POINT(%.10g %.10g)', 10.0 + (x + 0.5) * 0.25 + (y + 0.5) * 0.0,
                  50.0 + (x + 0.5) * 0.0 + (y + 0.5) * -0.25) AS geography,
           printf('POLYGON ((%.10g %.10g, %.10g %.10g, %.10g %.10g, %.10g %.10g, %.10g %.10g))',
                  10.25 + x * 0.25, 49.75 - y * 0.25, 10.25 + x * 0.25, 50.0 - y * 0.25,
                  10.0 + x * 0.25, 50.0 - y * 0.25, 10.0 + x * 0.25, 49.75 - y * 0.25,
                  10.25 + x * 0.25, 49.75 - y * 0.25) AS geography_polygon,
           creation_time,
           coalesce(raw_hours, date_sub('hour', creation_time, forecast_time)) AS forecast_hours,
           forecast_time,
           temperature_2m_above_ground, specific_humidity_2m_above_ground, relative_humidity_2m_above_ground,
           u_component_of_wind_10m_above_ground, v_component_of_wind_10m_above_ground,
           total_precipitation_surface, precipitable_water_entire_atmosphere,
           total_cloud_cover_entire_atmosphere, downward_shortwave_radiation_flux
    FROM ({_FC_STAGE})
"""
_FC_ORDER = ("forecast_hours ASC NULLS FIRST, forecast_time, temperature_2m_above_ground, "
             "specific_humidity_2m_above_ground, relative_humidity_2m_above_ground, "
             "u_component_of_wind_10m_above_ground, v_component_of_wind_10m_above_ground, "
             "total_precipitation_surface, precipitable_water_entire_atmosphere, "
             "total_cloud_cover_entire_atmosphere")


def _emb(spark, sf_dir):
    return read_table(spark, sf_dir, "embeddings")


# --------------------------------------------------------------------------- RAS-4/5
@register("tile_pixels", ["RAS-3", "RAS-4", "RAS-5", "RAS-9"], f"""
    SELECT vec_id, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, value FROM ({_EMB_PX})
""")
def tile_pixels(spark, sf_dir):
    px = expand_pixels(embedding_tiles(_emb(spark, sf_dir)), EMB_LAYOUT, with_text=False, with_coords=True,
                       keep=("vec_id",))
    return px.select("vec_id", "x", "y", "value")


@register("pixel_centers", ["RAS-6"], f"""
    SELECT vec_id, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, gx, gy FROM ({_EMB_GEO})
""")
def pixel_centers(spark, sf_dir):
    px = expand_pixels(embedding_tiles(_emb(spark, sf_dir)), EMB_LAYOUT, with_text=False, with_coords=True,
                       keep=("vec_id",))
    return px.select("vec_id", "x", "y", "gx", "gy")


@register("cell_boxes", ["RAS-7", "SCL-12"], f"""
    SELECT vec_id, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, min_x, max_x, min_y, max_y FROM ({_EMB_BOX})
""")
def cell_boxes(spark, sf_dir):
    px = expand_pixels(embedding_tiles(_emb(spark, sf_dir)), EMB_LAYOUT, with_text=False, with_coords=True,
                       keep=("vec_id",))
    return px.select("vec_id", "x", "y", "min_x", "max_x", "min_y", "max_y")


@register("cell_wkt", ["SCL-1", "SCL-2", "SCL-3", "RAS-8"], f"""
    SELECT vec_id, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y,
           {_POINT_SQL} AS geography, {_POLYGON_SQL} AS geography_polygon,
           CAST(2000 + label AS INTEGER) AS year, value
    FROM ({_EMB_BOX})
""")
def cell_wkt(spark, sf_dir):
    px = expand_pixels(embedding_tiles(_emb(spark, sf_dir)), EMB_LAYOUT, with_text=True, with_coords=True,
                       keep=("vec_id",))
    return px.select("vec_id", "x", "y", "geography", "geography_polygon", "year", "value")


@register("multiband_pixels", ["RAS-3", "RAS-4", "RAS-8"], f"""
    SELECT a.vec_id, CAST(a.x AS BIGINT) AS x, CAST(a.y AS BIGINT) AS y,
           {_POINT_SQL.replace('gx', 'a.gx').replace('gy', 'a.gy')} AS geography,
           CAST(2000 + a.label AS INTEGER) AS year, a.value AS first,
           CAST(b.embedding[a.pos + 1] AS DOUBLE) AS second
    FROM ({_EMB_GEO}) a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1
""")
def multiband_pixels(spark, sf_dir):
    px = expand_pixels(embedding_pair_tiles(_emb(spark, sf_dir)), PAIR_LAYOUT, with_text=True, with_coords=True,
                       keep=("vec_id",))
    return px.select("vec_id", "x", "y", "geography", "year", "first", "second")


# --------------------------------------------------------------------------- RAS-1/2, SCH-2..4
@register("block_tiling", ["RAS-1", "RAS-2"], """
    SELECT p_partkey, CAST(ix AS INTEGER) AS ix, CAST(iy AS INTEGER) AS iy,
           CAST(least(xsize - ix * 256, 256) AS INTEGER) AS xblock,
           CAST(least(ysize - iy * 256, 256) AS INTEGER) AS yblock
    FROM (SELECT p_partkey, xsize, ysize, ix, unnest(range(0, CAST(ceil(ysize / 256.0) AS BIGINT))) AS iy
          FROM (SELECT p_partkey, xsize, ysize, unnest(range(0, CAST(ceil(xsize / 256.0) AS BIGINT))) AS ix
                FROM (SELECT p_partkey, p_size * 37 AS xsize, p_size * 64 AS ysize FROM part)))
""")
def block_tiling(spark, sf_dir):
    blocks = image_blocks(part_images(read_table(spark, sf_dir, "part")))
    return blocks.select("p_partkey", "ix", "iy", "xblock", "yblock")


_PART_TYPE_SQL = ("list_extract(['Byte', 'Int16', 'UInt16', 'Int32', 'UInt32', 'Float32', 'Float64', 'CInt16'], "
                  "CAST(p_partkey % 8 + 1 AS INTEGER))")


@register("band_types", ["SCH-3"], f"""
    SELECT p_partkey, band_type,
           CASE WHEN band_type IN ('Byte', 'Int16', 'UInt16', 'Int32', 'UInt32') THEN 'integer' ELSE 'float' END AS band_kind,
           CASE WHEN band_type IN ('Byte', 'Int16', 'UInt16', 'Int32', 'UInt32') THEN 'INTEGER' ELSE 'FLOAT' END AS schema_type,
           CASE WHEN band_type = 'UInt32' THEN 'bigint'
                WHEN band_type IN ('Byte', 'Int16', 'UInt16', 'Int32') THEN 'int' ELSE 'double' END AS spark_type
    FROM (SELECT p_partkey, {_PART_TYPE_SQL} AS band_type FROM part)
""")
def band_types(spark, sf_dir):
    img = part_images(read_table(spark, sf_dir, "part"))
    bt = F.col("band_type")
    return img.select("p_partkey", bt, band_kind_col(bt).alias("band_kind"),
                      band_schema_type_col(bt).alias("schema_type"), band_spark_type_col(bt).alias("spark_type"))


# Metadata entries in map order, typed by key.
_META_SQL = """
    SELECT p_partkey, k AS attr_key, ord AS attr_pos, v AS attr_text FROM (
      SELECT p_partkey, unnest(['AREA_OR_POINT', 'country', 'creation_time', 'forecast_hours',
                                'time_hours_time', 'year', 'p_type']) AS k,
             unnest(['Area', p_brand, CAST(1577836800000 + p_partkey * 3600000 AS VARCHAR),
                     CAST(p_size AS VARCHAR), CAST(1577836800000 + p_partkey * 60000 AS VARCHAR),
                     CAST(1990 + p_partkey % 30 AS VARCHAR), p_type]) AS v,
             unnest(generate_series(0, 6)) AS ord
      FROM part)
"""


@register("meta_typing", ["SCH-4", "SCL-10", "SCL-11"], f"""
    SELECT p_partkey, attr_key, CAST(attr_pos AS INTEGER) AS attr_pos, attr_kind,
           CASE WHEN attr_kind = 'string' THEN attr_text
                WHEN attr_kind = 'datetime'
                    THEN strftime(make_timestamp(CAST(attr_text AS BIGINT) * 1000), '%Y-%m-%d %H:%M:%S.%g')
                ELSE CAST(CAST(attr_text AS INTEGER) AS VARCHAR) END AS typed_value
    FROM (SELECT *, CASE WHEN attr_key = 'AREA_OR_POINT' THEN NULL
                         WHEN attr_key = 'country' THEN 'string'
                         WHEN contains(attr_key, '_time') THEN 'datetime'
                         WHEN contains(attr_key, 'hours') OR contains(attr_key, 'year') THEN 'integer' END AS attr_kind
          FROM ({_META_SQL}))
    WHERE attr_kind IS NOT NULL
""")
def meta_typing(spark, sf_dir):
    """Metadata entries typed by key; the typed value is shown as canonical
    text (string as is, datetime from epoch milliseconds, integer parsed)."""
    img = part_images(read_table(spark, sf_dir, "part"))
    entries = img.select("p_partkey", F.posexplode(F.map_entries("meta")).alias("attr_pos", "e"))
    k, v = F.col("e.key"), F.col("e.value")
    kind = attribute_kind_col(k)
    return (entries.select("p_partkey", k.alias("attr_key"), "attr_pos", kind.alias("attr_kind"), v.alias("v"))
            .where(F.col("attr_kind").isNotNull())
            .select("p_partkey", "attr_key", "attr_pos", "attr_kind",
                    F.when(F.col("attr_kind") == "string", F.col("v"))
                    .when(F.col("attr_kind") == "datetime",
                          F.date_format(F.timestamp_millis(F.col("v").cast("bigint")), "yyyy-MM-dd HH:mm:ss.SSS"))
                    .otherwise(F.col("v").cast("int").cast("string")).alias("typed_value")))


@register("schema_strings", ["SCH-2"], f"""
    SELECT p_partkey,
           'geography:GEOGRAPHY,geography_polygon:GEOGRAPHY,country:STRING,creation_time:DATETIME,'
           || 'forecast_hours:INTEGER,time_hours_time:DATETIME,year:INTEGER,'
           || array_to_string(list_transform(string_split(lower(p_name), ' '),
                  lambda b: b || ':' || CASE WHEN {_PART_TYPE_SQL} IN ('Byte', 'Int16', 'UInt16', 'Int32', 'UInt32')
                                        THEN 'INTEGER' ELSE 'FLOAT' END), ',') AS schema_text
    FROM part
""")
def schema_strings(spark, sf_dir):
    img = part_images(read_table(spark, sf_dir, "part"))
    return img.select("p_partkey", schema_string_col(F.col("band_names"), F.col("band_type"), F.col("meta"))
                      .alias("schema_text"))


# --------------------------------------------------------------------------- SNK-1 / SCL-4 / SCL-2b
@register("csv_lines", ["SNK-1", "SCL-2b", "SCL-4"], f"""
    SELECT vec_id, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y,
           printf('"POINT(%.10g %.10g)"', gx, gy) || ',"POLYGON (('
             || regexp_replace(CAST(max_x AS VARCHAR), '\\.0$', '') || ' ' || regexp_replace(CAST(min_y AS VARCHAR), '\\.0$', '') || ', ' || regexp_replace(CAST(max_x AS VARCHAR), '\\.0$', '') || ' ' || regexp_replace(CAST(max_y AS VARCHAR), '\\.0$', '') || ', '
             || regexp_replace(CAST(min_x AS VARCHAR), '\\.0$', '') || ' ' || regexp_replace(CAST(max_y AS VARCHAR), '\\.0$', '') || ', ' || regexp_replace(CAST(min_x AS VARCHAR), '\\.0$', '') || ' ' || regexp_replace(CAST(min_y AS VARCHAR), '\\.0$', '') || ', '
             || regexp_replace(CAST(max_x AS VARCHAR), '\\.0$', '') || ' ' || regexp_replace(CAST(min_y AS VARCHAR), '\\.0$', '') || '))",' || CAST(2000 + label AS VARCHAR) || ','
             || printf('%g', value) || ',' || coalesce(printf('%g', second), '') AS line
    FROM (SELECT a.*, CAST(b.embedding[a.pos + 1] AS DOUBLE) AS second
          FROM ({_EMB_BOX}) a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1)
""")
def csv_lines_query(spark, sf_dir):
    """Two-band lines; the last image's second band is missing (empty field)."""
    tiles = embedding_pair_tiles(_emb(spark, sf_dir))
    return csv_lines(tiles, PAIR_LAYOUT, keep=("vec_id",), with_position=True)


# --------------------------------------------------------------------------- AGG-1 flagship
@register("nest_forecast", ["AGG-1", "SRT-1", "PRJ-2", "PRJ-3", "SCL-7", "SCL-8", "SCL-9"], f"""
    SELECT creation_time, geography, geography_polygon,
           CAST(len(forecast) AS BIGINT) AS n_hours,
           array_to_string(list_transform(forecast, lambda e: coalesce(CAST(e.hours AS VARCHAR), 'null')), ',') AS hours_list,
           forecast[1].temperature_2m_above_ground AS first_temperature,
           forecast[-1].temperature_2m_above_ground AS last_temperature,
           forecast[-1].time AS last_time
    FROM (SELECT creation_time, geography, geography_polygon,
                 list({{'hours': forecast_hours, 'time': forecast_time,
                        'temperature_2m_above_ground': temperature_2m_above_ground}} ORDER BY {_FC_ORDER}) AS forecast
          FROM ({_FC_PROJ}) GROUP BY creation_time, geography, geography_polygon)
""")
def nest_forecast_query(spark, sf_dir):
    return nested_summary(forecast_nested_late(forecast_tiles(_emb(spark, sf_dir))))


@register("nest_forecast_positions", ["AGG-1", "DRV-1", "PRJ-1", "PRJ-2", "PRJ-3", "SCH-5", "SCL-5", "SCL-6"], f"""
    SELECT creation_time, geography,
           CAST(row_number() OVER (PARTITION BY creation_time, geography, geography_polygon ORDER BY {_FC_ORDER}) - 1
                AS INTEGER) AS pos,
           forecast_hours AS hours, forecast_time AS time, temperature_2m_above_ground,
           specific_humidity_2m_above_ground, relative_humidity_2m_above_ground,
           u_component_of_wind_10m_above_ground, v_component_of_wind_10m_above_ground,
           total_precipitation_surface, precipitable_water_entire_atmosphere,
           total_cloud_cover_entire_atmosphere, downward_shortwave_radiation_flux
    FROM ({_FC_PROJ})
""")
def nest_forecast_positions(spark, sf_dir):
    nested = forecast_nested(forecast_tiles(_emb(spark, sf_dir)))
    return unnest(nested, "forecast", keep=["creation_time", "geography"], position="pos")


# --------------------------------------------------------------------------- rotated grids
_TURN = (0.25, 0.03125, 0.0625, -0.25)  # gt1, gt2, gt4, gt5: eighths and less, exact in binary


@register("rotated_text", ["RAS-6", "RAS-7", "RAS-8", "SCL-1", "SCL-2", "SCL-3"], f"""
    SELECT vec_id, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, {_POINT_SQL} AS geography, {_POLYGON_SQL} AS geography_polygon, value
    FROM (SELECT *, round_even(greatest(least(gx - 0.5 * {_TURN[0]}, 180.0), -180.0) * 100000000.0, 0) / 100000000.0 AS min_x,
                    round_even(greatest(least(gx + 0.5 * {_TURN[0]}, 180.0), -180.0) * 100000000.0, 0) / 100000000.0 AS max_x,
                    round_even(greatest(least(gy + 0.5 * {_TURN[3]}, 90.0), -90.0) * 100000000.0, 0) / 100000000.0 AS min_y,
                    round_even(greatest(least(gy - 0.5 * {_TURN[3]}, 90.0), -90.0) * 100000000.0, 0) / 100000000.0 AS max_y
          FROM (SELECT *, g0 + (x + 0.5::DOUBLE) * {_TURN[0]}::DOUBLE + (y + 0.5::DOUBLE) * {_TURN[1]}::DOUBLE AS gx,
                       80.0::DOUBLE + (x + 0.5::DOUBLE) * {_TURN[2]}::DOUBLE + (y + 0.5::DOUBLE) * {_TURN[3]}::DOUBLE AS gy FROM ({_EMB_PX})))
""")
def rotated_text(spark, sf_dir):
    """Every vector as a tile of a turned grid: the text differs from pixel to
    pixel and is made a row of pixels at a time."""
    tiles, gt = embedding_tiles(read_table(spark, sf_dir, "embeddings")), F.col("gt")
    tiles = tiles.withColumn("gt", F.array(gt[0], *[F.lit(v) for v in (_TURN[0], _TURN[1], 80.0, _TURN[2], _TURN[3])]))
    px = expand_pixels(tiles, PixelLayout(("value",), "Float32"), with_coords=True, keep=("vec_id",))
    return px.select("vec_id", "x", "y", "geography", "geography_polygon", "value")

"""Deterministic rasters derived from the driver's tables.

The driver tables hold no rasters, so tiles are built from them with native
column expressions (no driver round trip; the work grows with the tables):

* ``embeddings``: every vector has 64 floats = one 8 x 8 single-band tile.
* forecast cycles: vector ``v`` is hour ``v % 10`` of cycle ``v div 10``; its 64
  floats are a 4 x 2 tile with 8 bands (the ninth quantity is absent, as in an
  hour-0 file, and hour 0 has no precipitation).  All hours of a cycle share one grid, so they nest per cell.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertab.sources.files import open_output
from rastertab.sources.schemas import FORECAST_FIELDS

EMBEDDING_SIDE = 8
PRECIP_FIELD = "total_precipitation_surface"
CYCLE_ORIGIN = "2024-01-01 00:00:00"
FORECAST_GT = (10.0, 0.25, 0.0, 50.0, 0.0, -0.25)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _checked_embedding(n: int = EMBEDDING_SIDE * EMBEDDING_SIDE):
    emb = F.col("embedding")
    return F.when(F.size(emb) == n, F.transform(emb, lambda v: v.cast("double"))).otherwise(
        F.raise_error(F.lit(f"embedding must hold {n} values")))


def embedding_tiles(emb: DataFrame) -> DataFrame:
    """One 8 x 8 single-band tile per vector on adjacent 2-degree cells along
    the top row of the globe (touches -180, +180 and +90)."""
    vid = F.col("vec_id")
    gt = F.array((F.lit(-180.0) + (vid % 180).cast("double") * 2.0), F.lit(0.25), F.lit(0.0),
                 F.lit(90.0), F.lit(0.0), F.lit(-0.25))
    return emb.select(
        F.concat(F.lit("emb_"), vid.cast("string")).alias("image_id"),
        F.lit(EMBEDDING_SIDE).alias("xsize"), F.lit(EMBEDDING_SIDE).alias("ysize"),
        gt.alias("gt"),
        F.array(F.lit("value")).alias("band_names"),
        F.lit("Float32").alias("band_type"),
        F.create_map(F.lit("AREA_OR_POINT"), F.lit("Area"),
                     F.lit("year"), (F.lit(2000) + F.col("label")).cast("string"),
                     F.lit("label"), F.col("label").cast("string")).alias("meta"),
        F.lit(0).alias("ix"), F.lit(0).alias("iy"),
        F.lit(EMBEDDING_SIDE).alias("xblock"), F.lit(EMBEDDING_SIDE).alias("yblock"),
        F.array(_checked_embedding()).alias("bands"),
        vid.alias("vec_id"),
    )


VECTORS_PER_IMAGE = 40


def write_embedding_rasters(emb: DataFrame, path: str) -> None:
    """Raster files on shared storage: 40 vectors side by side make one image
    of 320 x 8 pixels and two bands (the values, and their negatives), stored
    row-major with a header file; a task writes the images it holds."""
    def write(it):
        import io

        import numpy as np

        for pdf in it:
            for row in pdf.itertuples():
                side = EMBEDDING_SIDE
                values = np.full((side, (max(v["place"] for v in row.vectors) + 1) * side), np.nan, np.float32)
                for v in row.vectors:
                    values[:, v["place"] * side:(v["place"] + 1) * side] = np.reshape(v["embedding"], (side, side))
                body = io.BytesIO()
                np.save(body, np.stack([values, -values]))
                head = {"gt": [-180.0 + row.image % 100, 0.01, 0.0, 50.0, 0.0, -0.01], "band_names": ["value", "negative"],
                        "band_type": "Float32", "meta": {"year": str(2000 + row.image % 20)}}
                for ext, content in (("npy", body.getvalue()), ("json", json.dumps(head).encode())):
                    with open_output(f"{path}/{row.image}_vectors.{ext}") as out:
                        out.write(content)
            yield pdf[["image"]]

    groups = emb.select((F.col("vec_id") / VECTORS_PER_IMAGE).cast("long").alias("image"), F.struct(
        (F.col("vec_id") % VECTORS_PER_IMAGE).cast("int").alias("place"), "embedding").alias("v"))
    images = groups.groupBy("image").agg(F.collect_list("v").alias("vectors"))  # 40 vectors at most
    images.mapInPandas(write, "image long").write.format("noop").mode("overwrite").save()


def embedding_pair_tiles(emb: DataFrame) -> DataFrame:
    """Two-band tiles: vector ``v`` and ``v + 1`` as bands of image ``v`` (an
    equi-join on the id; both sides are the whole table).  The last image has
    no second vector: its second band holds nulls."""
    a = embedding_tiles(emb)
    b = emb.select((F.col("vec_id") - 1).alias("vec_id"), _checked_embedding().alias("second"))
    missing = F.array_repeat(F.lit(None).cast("double"), EMBEDDING_SIDE * EMBEDDING_SIDE)
    return (a.join(b, "vec_id", "left")
            .withColumn("bands", F.array(F.col("bands")[0], F.coalesce("second", missing)))
            .withColumn("band_names", F.array(F.lit("first"), F.lit("second")))
            .drop("second"))


def forecast_tiles(emb: DataFrame) -> DataFrame:
    """Forecast hour tiles: 4 x 2 pixels, 8 bands, shared grid per cycle.

    Metadata as the exported files carry it: epoch-millisecond creation and
    forecast times and the forecast hour, which is missing for every seventh
    vector (recovered later from the time difference).
    """
    vid = F.col("vec_id")
    cycle = F.expr("vec_id div 10")
    hour = (vid % 10) * 3
    creation_ms = F.unix_millis(F.lit(CYCLE_ORIGIN).cast("timestamp")) + cycle * F.lit(6 * 3600 * 1000)
    forecast_ms = creation_ms + hour * F.lit(3600 * 1000) + (vid % 3) * F.lit(20 * 60 * 1000)
    absent = F.array_repeat(F.lit(None).cast("double"), 8)  # hour 0 has no precipitation
    bands = F.array(*[F.when(hour == 0, absent).otherwise(F.slice(F.col("_emb"), 8 * b + 1, 8))
                      if FORECAST_FIELDS[b] == PRECIP_FIELD else F.slice(F.col("_emb"), 8 * b + 1, 8) for b in range(8)])
    meta_with_hour = F.create_map(F.lit("creation_time"), creation_ms.cast("string"),
                                  F.lit("forecast_hours"), hour.cast("string"),
                                  F.lit("forecast_time"), forecast_ms.cast("string"))
    meta_no_hour = F.create_map(F.lit("creation_time"), creation_ms.cast("string"),
                                F.lit("forecast_time"), forecast_ms.cast("string"))
    emb = emb.select("vec_id", _checked_embedding().alias("_emb"))
    return emb.select(
        F.concat(F.lit("gfs_"), vid.cast("string")).alias("image_id"),
        F.lit(4).alias("xsize"), F.lit(2).alias("ysize"),
        F.array(*[F.lit(float(g)) for g in FORECAST_GT]).alias("gt"),
        F.array(*[F.lit(n) for n in FORECAST_FIELDS[:8]]).alias("band_names"),
        F.lit("Float32").alias("band_type"),
        F.when(vid % 7 == 0, meta_no_hour).otherwise(meta_with_hour).alias("meta"),
        F.lit(0).alias("ix"), F.lit(0).alias("iy"), F.lit(4).alias("xblock"), F.lit(2).alias("yblock"),
        bands.alias("bands"),
    )


def part_images(part: DataFrame) -> DataFrame:
    """Image headers from ``part``: ``p_size * 37`` x ``p_size * 64`` pixels
    (heights hit exact multiples of 256), a data type and metadata per part."""
    types = F.array(*[F.lit(t) for t in ("Byte", "Int16", "UInt16", "Int32", "UInt32", "Float32", "Float64", "CInt16")])
    pk = F.col("p_partkey")
    return part.select(
        pk,
        F.concat(F.lit("part_"), pk.cast("string")).alias("image_id"),
        (F.col("p_size") * 37).alias("xsize"), (F.col("p_size") * 64).alias("ysize"),
        F.element_at(types, (pk % 8 + 1).cast("int")).alias("band_type"),
        F.split(F.lower(F.col("p_name")), " ").alias("band_names"),
        F.create_map(
            F.lit("AREA_OR_POINT"), F.lit("Area"),
            F.lit("country"), F.col("p_brand"),
            F.lit("creation_time"), (F.lit(1577836800000) + pk * F.lit(3600000)).cast("string"),
            F.lit("forecast_hours"), F.col("p_size").cast("string"),
            F.lit("time_hours_time"), (F.lit(1577836800000) + pk * F.lit(60000)).cast("string"),
            F.lit("year"), (F.lit(1990) + pk % 30).cast("string"),
            F.lit("p_type"), F.col("p_type"),
        ).alias("meta"),
    )

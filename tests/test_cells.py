"""Cell keys: Morton numbers, box covers, and what a box query skips."""
import glob
import random
from datetime import datetime

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from rastertab.operators.cells import box_ranges, cell_key, text_place, with_cell_key, within_box


def steps(lon, lat):
    return (min(max(int((lon + 180) / 360 * 65536), 0), 65535), min(max(int((lat + 90) / 180 * 65536), 0), 65535))


def interleaved(x, y):
    return sum(((x >> i & 1) << 2 * i) | ((y >> i & 1) << 2 * i + 1) for i in range(16))


def test_keys_are_interleaved_bits(spark):
    rng = random.Random(3)
    places = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(300)]
    places += [(-180.0, -90.0), (180.0, 90.0), (-200.0, 95.0), (0.0, 0.0), (179.9999999, 89.9999999)]
    rows = spark.createDataFrame([(*p, interleaved(*steps(*p))) for p in places], "lon double, lat double, want long")
    assert rows.where(cell_key(F.col("lon"), F.col("lat")) != F.col("want")).count() == 0
    odd = spark.createDataFrame([(None, 1.0), (1.0, None), (float("nan"), 1.0)], "lon double, lat double")
    assert [r.k for r in odd.select(cell_key(F.col("lon"), F.col("lat")).alias("k")).collect()] == [None] * 3
    texts = spark.createDataFrame([("POINT(1.5 -2)",), ("POINT(x y)",), (None,), ("cell",)], "geography string")
    lon, lat = text_place(F.col("geography"))
    assert [tuple(r) for r in texts.select(lon, lat).collect()] == [(1.5, -2.0), (None, None), (None, None), (None, None)]
    assert [r.cell_key is None for r in with_cell_key(texts).collect()] == [False, True, True, True]


def test_ranges_cover_the_box_and_little_else():
    rng = random.Random(5)
    for most in (4, 64, 400):
        for _ in range(40):
            w, h = rng.choice([0.001, 1, 20, 170]), rng.choice([0.001, 1, 20, 80])
            lon, lat = rng.uniform(-180, 180 - w), rng.uniform(-90, 90 - h)
            ranges = box_ranges(lon, lat, lon + w, lat + h, most)
            assert 0 < len(ranges) <= most and ranges == sorted(ranges)
            assert all(a[1] + 1 < b[0] for a, b in zip(ranges, ranges[1:]))
            for _ in range(50):
                key = interleaved(*steps(rng.uniform(lon, lon + w), rng.uniform(lat, lat + h)))
                assert any(a <= key <= b for a, b in ranges)
            if most == 400 and w == 20 and h == 20:
                x0, y0 = steps(lon, lat)
                x1, y1 = steps(lon + w, lat + h)
                assert sum(b - a + 1 for a, b in ranges) < 2 * (x1 - x0 + 1) * (y1 - y0 + 1)


BOX = (100.0, -30.0, 112.0, -21.0)


def share_read(folder):
    """Row groups whose smallest and largest key meet a range of the box, of all."""
    ranges, met, total = box_ranges(*BOX), 0, 0
    for name in glob.glob(f"{folder}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index("cell_key")
        for i in range(meta.num_row_groups):
            stats = meta.row_group(i).column(at).statistics
            total += 1
            met += any(stats.min <= b and stats.max >= a for a, b in ranges)
    return met / total, total


def test_box_query_of_one_slice_skips_most_files(spark, tmp_dir):
    from rastertab.plans.forecast import forecast_layout, forecast_staging
    from rastertab.plans.jobs import load_forecast_cycle, load_population_slice, load_productivity_year
    from raster_fixtures import tiles_from_arrays
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cells = spark.range(180 * 90).selectExpr(
            "concat('POINT(', -179 + 2 * (id % 180), ' ', 89 - 2 * (id div 180), ')') AS geography", "CAST(id AS STRING) AS geography_polygon",
            "'NZL' AS country", "id AS npp", "0 AS npp_qc", "2001 AS year", "CAST(id AS DOUBLE) AS population")
        load_productivity_year(spark, cells, "npp_box", 2001, location=f"{tmp_dir}/npp")
        load_population_slice(spark, cells, "pop_box", "NZL", 2001, location=f"{tmp_dir}/pop")
        tiles = tiles_from_arrays(spark, [{"image_id": "f", "data": np.zeros((8, 90, 180)), "gt": (-180.0, 2.0, 0.0, 90.0, 0.0, -2.0),
                                           "band_names": list(forecast_layout().band_names), "band_type": "Float32",
                                           "meta": {"creation_time": "1704067200000", "forecast_hours": "0", "forecast_time": "1704067200000"}}])
        load_forecast_cycle(spark, forecast_staging(tiles), "fc_box", datetime(2024, 1, 1), location=f"{tmp_dir}/fc",
                            staging_location=f"{tmp_dir}/fcs")
        want = {(x, y) for x in range(-179, 180, 2) for y in range(-89, 90, 2) if BOX[0] <= x <= BOX[2] and BOX[1] <= y <= BOX[3]}
        for name, folder in (("npp_box", "npp"), ("pop_box", "pop"), ("fc_box", "fc")):
            share, groups = share_read(f"{tmp_dir}/{folder}")
            assert groups >= 30 and share < 0.2, (name, share, groups)
            df = within_box(spark.table(name), *BOX)
            assert {tuple(map(float, r.geography[6:-1].split())) for r in df.select("geography").collect()} == want
            text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
            assert "LessThanOrEqual(cell_key," in text.split("PushedFilters: [")[1].split("\n")[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from raster_fixtures import tiles_from_arrays
from rastertab.operators.attributes import PixelLayout
from rastertab.operators.reproject import SPHERE_RADIUS, reproject_tiles, sinusoidal_forward, sinusoidal_inverse


def test_round_trip(spark):
    df = spark.createDataFrame([(float(lon), float(lat)) for lon in range(-179, 180, 37) for lat in range(-85, 86, 17)],
                               "lon double, lat double")
    x, y = sinusoidal_forward(F.col("lon"), F.col("lat"))
    back = df.select("lon", "lat", x.alias("x"), y.alias("y")).select(
        "lon", "lat", *[c.alias(n) for c, n in zip(sinusoidal_inverse(F.col("x"), F.col("y")), ("lon2", "lat2"))])
    err = back.select(F.max(F.greatest(F.abs(F.col("lon") - F.col("lon2")), F.abs(F.col("lat") - F.col("lat2"))))).first()[0]
    assert err * math.pi / 180 < 1e-9


COLS, ROWS, SIZE = 37, 23, 31000.0
SRC = (-COLS * SIZE / 2, SIZE, 0.0, ROWS * SIZE / 2, 0.0, -SIZE)
TARGET, TX, TY = (-6.0, 0.173, 0.0, 3.5, 0.0, -0.131), 71, 53


def brute_force(values):
    want = {}
    for j in range(TY):
        for i in range(TX):
            lon, lat = TARGET[0] + (i + 0.5) * TARGET[1], TARGET[3] + (j + 0.5) * TARGET[5]
            x = SPHERE_RADIUS * (lon * (math.pi / 180)) * math.cos(lat * (math.pi / 180))
            y = SPHERE_RADIUS * (lat * (math.pi / 180))
            c, r = math.floor((x - SRC[0]) / SRC[1]), math.floor((y - SRC[3]) / SRC[5])
            if 0 <= c < COLS and 0 <= r < ROWS:
                want[(i, j)] = float(values[r, c])
    return want


def image(name, values, x0=0, y0=0):
    return {"image_id": name, "data": values, "gt": (SRC[0] + x0 * SIZE, SIZE, 0.0, SRC[3] - y0 * SIZE, 0.0, -SIZE),
            "band_names": ["v"], "band_type": "Float64"}


def reprojected(spark, images, block, **options):
    tiles = tiles_from_arrays(spark, images, block)
    return reproject_tiles(tiles, PixelLayout(("v",), "Float64"), SRC, COLS, ROWS, TARGET, TX, TY, block_size=block, **options)


@pytest.mark.parametrize("block", [256, 8, 5])
def test_nearest_pick_matches_brute_force(spark, block):
    values = np.random.default_rng(5).normal(size=(ROWS, COLS))
    rows = reprojected(spark, [image("one", values)], block).collect()
    want = brute_force(values)
    assert {(r.tx, r.ty): r.v for r in rows} == want and len(rows) == len(want) > 100
    for r in rows:
        assert r.lon == TARGET[0] + (r.tx + 0.5) * TARGET[1] and r.lat == TARGET[3] + (r.ty + 0.5) * TARGET[5]
        assert r.geography == "POINT(%.10g %.10g)" % (r.lon, r.lat)


def test_adjacent_images_make_one_mosaic(spark):
    values = np.random.default_rng(6).normal(size=(ROWS, COLS))
    parts = [image("a", values[:, :13]), image("b", values[:10, 13:], 13), image("c", values[10:, 13:], 13, 10)]
    rows = reprojected(spark, parts, 8, with_text=False).collect()
    want = brute_force(values)
    assert {(r.tx, r.ty): r.v for r in rows} == want and len(rows) == len(want)


def test_overlapping_and_foreign_images_are_refused(spark):
    values = np.zeros((ROWS, COLS))
    with pytest.raises(Exception, match="overlap"):
        reprojected(spark, [image("a", values[:, :20]), image("b", values[:, 19:], 19)], 8).collect()
    with pytest.raises(Exception, match="does not lie on the source grid"):
        reprojected(spark, [image("a", values[:, :20], 0.4)], 8).collect()


def test_part_of_the_source_gives_its_cells_only(spark):
    values = np.random.default_rng(7).normal(size=(ROWS, COLS))
    rows = reprojected(spark, [image("b", values[:, 20:], 20)], 8, with_text=False).collect()
    holes = values.copy()
    holes[:, :20] = np.nan
    assert {(r.tx, r.ty): r.v for r in rows} == {k: v for k, v in brute_force(holes).items() if not math.isnan(v)}


def test_tiles_cross_one_exchange(spark, tmp_dir):
    """Bands move once; overlaps are found on rectangles read on their own."""
    values = np.zeros((ROWS, COLS))
    tiles_from_arrays(spark, [image("a", values)], 8).write.parquet(f"{tmp_dir}/tiles")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = reproject_tiles(spark.read.parquet(f"{tmp_dir}/tiles"), PixelLayout(("v",), "Float64"), SRC, COLS, ROWS, TARGET, TX, TY,
                              block_size=8)
        text = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = [part.split("\n")[1] for part in text.split(") Exchange")[1:]]
    assert sum("bands#" in line for line in moved) == 1 and len(moved) > 2
    scans = [part.split("ReadSchema: ")[1].split("\n")[0] for part in text.split(") Scan parquet")[1:]]
    assert sorted("bands" in schema for schema in scans) == [False, True]


def test_overlap_is_refused_where_no_target_cell_asks(spark):
    """Images that overlap beside what the target grid covers are refused all the same."""
    values = np.zeros((ROWS, COLS))
    far = (-5.0, 0.1, 0.0, 0.4, 0.0, -0.1)
    tiles = tiles_from_arrays(spark, [image("a", values[:, :20]), image("b", values[:, 19:], 19)], 8)
    with pytest.raises(Exception, match="overlap"):
        reproject_tiles(tiles, PixelLayout(("v",), "Float64"), SRC, COLS, ROWS, far, 5, 5, block_size=8).collect()


@pytest.mark.parametrize("src", [(SRC, COLS, ROWS), ((2e6, 25000.0, 0.0, 7e6, 0.0, -25000.0), 60, 90),
                                 ((-9e6, 4e4, 0.0, -1e6, 0.0, -4e4), 50, 70)])
def test_suggested_grid_bounds_every_corner(src):
    from rastertab.operators.reproject import suggest_target_grid
    gt, w, h = src
    corners = []
    for j in range(h + 1):
        for i in range(w + 1):
            x, y = gt[0] + i * gt[1], gt[3] + j * gt[5]
            phi = y / SPHERE_RADIUS
            corners.append((math.degrees(x / (SPHERE_RADIUS * math.cos(phi))), math.degrees(phi)))
    lons, lats = zip(*corners)
    (west, cell, _, north, _, down), tx, ty = suggest_target_grid(gt, w, h)
    low, high = max(-180.0, min(lons)), min(180.0, max(lons))
    assert math.isclose(west, low, abs_tol=1e-9) and math.isclose(north, max(lats), abs_tol=1e-9) and down == -cell
    assert abs(tx * cell - (high - low)) <= cell and abs(ty * cell - (max(lats) - min(lats))) <= cell
    assert math.isclose(math.hypot(high - low, max(lats) - min(lats)) / cell, math.hypot(w, h), rel_tol=1e-9)


def test_suggested_grid_of_the_whole_globe():
    from rastertab.operators.reproject import suggest_target_grid
    half = math.pi * SPHERE_RADIUS
    (west, cell, _, north, _, _), tx, ty = suggest_target_grid((-half, half / 400, 0, half / 2, 0, -half / 400), 800, 400)
    assert (round(west, 6), round(north, 6), tx, ty) == (-180.0, 90.0, 800, 400) and math.isclose(cell, 0.45)
    with pytest.raises(ValueError):
        suggest_target_grid((3 * half, 1000.0, 0, 0.0, 0, -1000.0), 5, 5)


def test_productivity_job_picks_its_own_grid(spark, tmp_dir):
    from rastertab.operators.reproject import suggest_target_grid
    from rastertab.plans.jobs import load_productivity_from_tiles
    values = np.arange(ROWS * COLS).reshape(ROWS, COLS)
    one = {**image("MOD/2001_01_01", np.stack([values, values % 7])), "band_names": ["Npp", "Npp_QC"], "band_type": "Int16"}
    load_productivity_from_tiles(spark, tiles_from_arrays(spark, [one]), "npp_own_grid", 2001, SRC, COLS, ROWS, location=f"{tmp_dir}/own")
    gt, tx, ty = suggest_target_grid(SRC, COLS, ROWS)
    want = 0
    for j in range(ty):
        for i in range(tx):
            lon, lat = gt[0] + (i + 0.5) * gt[1], gt[3] + (j + 0.5) * gt[5]
            c = math.floor((SPHERE_RADIUS * math.radians(lon) * math.cos(math.radians(lat)) - SRC[0]) / SRC[1])
            r = math.floor((SPHERE_RADIUS * math.radians(lat) - SRC[3]) / SRC[5])
            want += 0 <= c < COLS and 0 <= r < ROWS
    assert spark.table("npp_own_grid").count() == want > 0.8 * ROWS * COLS

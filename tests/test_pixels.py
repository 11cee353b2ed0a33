import math

import numpy as np
from pyspark.sql import functions as F

from rastertab.operators.attributes import PixelLayout, infer_layout
from rastertab.operators.pixels import expand_pixels
from rastertab.sources.tiles import image_blocks
from raster_fixtures import tiles_from_arrays

GT = (-180.0, 0.25, 0.0, 90.0, 0.0, -0.25)


def _tiles(spark, data, gt=GT, bands=("v",), band_type="Float32", meta=None, block=256):
    return tiles_from_arrays(spark, [{"image_id": "img", "data": np.asarray(data, dtype=float), "gt": gt,
                                      "band_names": list(bands), "band_type": band_type, "meta": meta or {}}], block)


def _collect(df, *order):
    return df.orderBy(*order).collect() if order else df.collect()


def test_first_pixel_text_and_order(spark):
    data = np.arange(6, dtype=float).reshape(2, 3)  # ysize 2, xsize 3
    px = expand_pixels(_tiles(spark, data), PixelLayout(("v",), "Float32"), with_coords=True)
    rows = _collect(px, "y", "x")
    assert len(rows) == 6
    assert rows[0].geography == "POINT(-179.875 89.875)"
    assert rows[0].geography_polygon == "POLYGON ((-179.75 89.75, -179.75 90, -180 90, -180 89.75, -179.75 89.75))"
    assert [r.v for r in rows] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]


def test_two_bands_become_columns(spark):
    data = np.stack([np.ones((2, 3)), 2 * np.ones((2, 3))])
    px = expand_pixels(_tiles(spark, data, bands=("a", "b")), PixelLayout(("a", "b"), "Float64"))
    assert px.columns == ["geography", "geography_polygon", "a", "b"]
    rows = px.collect()
    assert len(rows) == 6 and all(r.a == 1.0 and r.b == 2.0 for r in rows)


def test_edge_blocks(spark):
    t257 = _tiles(spark, np.zeros((1, 257)))
    t256 = _tiles(spark, np.zeros((1, 256)))
    assert t257.count() == 2 and t256.count() == 1
    assert expand_pixels(t257, PixelLayout(("v",), "Float32"), with_text=False).count() == 257
    assert expand_pixels(t256, PixelLayout(("v",), "Float32"), with_text=False).count() == 256


def test_block_plan_covers_images(spark):
    images = spark.createDataFrame([("a", 257, 1), ("b", 256, 768), ("c", 0, 5), ("d", 513, 300)],
                                   "image_id string, xsize int, ysize int")
    got = sorted((r.image_id, r.ix, r.iy, r.xblock, r.yblock) for r in image_blocks(images).collect())
    want = []
    for name, xs, ys in [("a", 257, 1), ("b", 256, 768), ("c", 0, 5), ("d", 513, 300)]:
        for x in range(0, xs, 256):
            for y in range(0, ys, 256):
                want.append((name, x // 256, y // 256, min(256, xs - x), min(256, ys - y)))
    assert got == sorted(want)


def test_zero_and_sign_text(spark):
    px = expand_pixels(_tiles(spark, [[1.0]], gt=(-0.5, 1.0, 0.0, 0.5, 0.0, -1.0)), PixelLayout(("v",), "Float32"))
    r = px.collect()[0]
    assert r.geography == "POINT(0 0)"
    assert r.geography_polygon == "POLYGON ((0.5 -0.5, 0.5 0.5, -0.5 0.5, -0.5 -0.5, 0.5 -0.5))"


def test_tie_heavy_text_equals_python(spark):
    gt = (110.0, 0.000833333333, 0.0, 10.0, 0.0, -0.000833333333)
    data = np.zeros((40, 300))
    px = expand_pixels(_tiles(spark, data, gt=gt), PixelLayout(("v",), "Float32"), with_coords=True)
    for r in px.collect():
        gx = gt[0] + (r.x + 0.5) * gt[1] + (r.y + 0.5) * gt[2]
        gy = gt[3] + (r.x + 0.5) * gt[4] + (r.y + 0.5) * gt[5]
        assert r.geography == "POINT(%.10g %.10g)" % (gx, gy)
        lo_x = np.round(np.clip(gx - 0.5 * gt[1], -180, 180), 8)
        hi_y = np.round(np.clip(gy + 0.5 * -gt[5], -90, 90), 8)
        assert r.geography_polygon.split(", ")[2] == "%.10g %.10g" % (lo_x, hi_y)


def test_tile_crossing_antimeridian(spark):
    gt = (179.5, 0.5, 0.0, 10.0, 0.0, -0.5)
    px = expand_pixels(_tiles(spark, np.zeros((1, 3)), gt=gt), PixelLayout(("v",), "Float32"), with_coords=True)
    rows = _collect(px, "x")
    assert rows[2].gx == 180.75 and rows[2].geography.startswith("POINT(180.75 ")
    assert rows[2].max_x == 180.0 and rows[2].min_x == 180.0


def test_fill_values_and_nan_are_kept(spark):
    data = np.array([[np.nan, -9999.0, 1.0]])
    px = expand_pixels(_tiles(spark, data), PixelLayout(("v",), "Float32"), with_text=False)
    vals = [r.v for r in px.collect()]
    assert len(vals) == 3 and -9999.0 in vals and any(math.isnan(v) for v in vals)


def test_meta_typing_and_drop(spark):
    meta = {"AREA_OR_POINT": "Area", "country": "NZL", "creation_time": "1600000000000", "forecast_hours": "6",
            "year": "2020", "foo": "bar", "time_hours_time": "1600000000000"}
    tiles = _tiles(spark, [[1.0]], meta=meta, band_type="Int16")
    layout = infer_layout(tiles)
    # map order of a Python dict is not kept by Spark: compare as sets
    assert sorted(k for k, _ in layout.attributes) == ["country", "creation_time", "forecast_hours",
                                                       "time_hours_time", "year"]
    assert dict(layout.attributes)["time_hours_time"] == "datetime"
    text = layout.schema_string()
    assert text.startswith("geography:GEOGRAPHY,geography_polygon:GEOGRAPHY,") and text.endswith(",v:INTEGER")
    assert "year:INTEGER" in text and "time_hours_time:DATETIME" in text and "foo" not in text
    px = expand_pixels(tiles, layout)
    dtypes = dict(px.dtypes)
    assert dtypes["creation_time"] == "timestamp" and dtypes["forecast_hours"] == "int" and dtypes["v"] == "int"
    r = px.collect()[0]
    assert r.country == "NZL" and r.year == 2020 and r.v == 1


def test_rotated_grid_uses_per_pixel_text(spark):
    gt = (10.0, 0.1, 0.01, 50.0, 0.02, -0.1)
    px = expand_pixels(_tiles(spark, np.zeros((3, 4)), gt=gt), PixelLayout(("v",), "Float32"), with_coords=True)
    for r in px.collect():
        gx = gt[0] + (r.x + 0.5) * gt[1] + (r.y + 0.5) * gt[2]
        gy = gt[3] + (r.x + 0.5) * gt[4] + (r.y + 0.5) * gt[5]
        assert r.geography == "POINT(%.10g %.10g)" % (gx, gy)
        assert r.gx == gx and r.gy == gy


def test_pixel_count_property(spark):
    rng = np.random.default_rng(1)
    images = []
    for i in range(4):
        h, w = rng.integers(1, 300, 2)
        images.append({"image_id": f"i{i}", "data": rng.normal(size=(int(h), int(w))), "gt": GT, "band_names": ["v"]})
    tiles = tiles_from_arrays(spark, images)
    n = expand_pixels(tiles, PixelLayout(("v",), "Float64"), with_text=False).count()
    assert n == sum(im["data"].size for im in images)
    area = expand_pixels(tiles, PixelLayout(("v",), "Float64"), with_text=False, with_coords=True).select(
        F.max(F.abs((F.col("max_x") - F.col("min_x")) * (F.col("max_y") - F.col("min_y")) - 0.0625))).first()[0]
    assert area < 1e-12


def test_layouts_do_not_depend_on_key_order(spark):
    from rastertab.operators.attributes import infer_layouts, of_layout
    a = _tiles(spark, [[1.0]], meta={"year": "2020", "country": "NZL", "x": "1"})
    b = _tiles(spark, [[2.0]], meta={"country": "NZL", "year": "2020"})
    c = _tiles(spark, [[3.0]], meta={"year": "2020"}, bands=("w",))
    assert len(infer_layouts(a.unionByName(b))) == 1
    layouts = infer_layouts(a.unionByName(b).unionByName(c))
    assert [(x.band_names, [k for k, _ in x.attributes]) for x in layouts] == [(("v",), ["country", "year"]), (("w",), ["year"])]
    assert of_layout(a.unionByName(c), layouts[1]).count() == 1


def test_partition_count_is_the_callers(spark):
    tiles = _tiles(spark, np.zeros((4, 4)))
    assert expand_pixels(tiles, PixelLayout(("v",), "Float32"), with_text=False, num_partitions=3).rdd.getNumPartitions() == 3


def _mixed_images(n):
    images = []
    for i in range(n):
        meta = {"year": str(2000 + i)} if i % 3 else {"country": "NZL", "x_time": "0"}
        images.append({"image_id": f"m{i}", "data": np.full((2, 2, 3), float(i)), "gt": (float(i), 0.5, 0.0, 10.0, 0.0, -0.5),
                       "band_names": [f"own_{i}", "shared"], "band_type": ("Int16", "UInt32", "Float64")[i % 3], "meta": meta})
    return images


def test_fifty_layouts_in_one_scan_and_one_write(spark, tmp_dir):
    from rastertab.operators.attributes import aligned_bands, infer_layouts, joint_layout
    from rastertab.plans.jobs import convert_tiles
    tiles = tiles_from_arrays(spark, _mixed_images(50)).withColumn("meta", F.when(F.col("image_id") != "m7", F.col("meta")))
    tiles.write.parquet(f"{tmp_dir}/t")
    tiles = spark.read.parquet(f"{tmp_dir}/t")
    layouts = infer_layouts(tiles)
    joint = joint_layout(layouts)
    assert len(layouts) == 50 and len(joint.band_names) == 51
    plan = expand_pixels(aligned_bands(tiles, joint), joint)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Union" not in plan
    assert len(convert_tiles(tiles, f"{tmp_dir}/out")) == 50
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert dict(out.dtypes)["shared"] == "double" and dict(out.dtypes)["own_0"] == "int" and dict(out.dtypes)["own_1"] == "bigint"
    for i in (0, 1, 2, 7, 49):
        own = out.where(F.col(f"own_{i}").isNotNull()).collect()
        assert len(own) == 6 and {(r[f"own_{i}"], r.shared, r[f"own_{(i + 1) % 50}"]) for r in own} == {(i, float(i), None)}
        assert {r.year for r in own} == {2000 + i if i % 3 and i != 7 else None}
        assert {r.country for r in own} == {None if i % 3 else "NZL"}


def test_mixed_lines_have_their_own_fields(spark, tmp_dir):
    from rastertab.plans.jobs import convert_tiles
    tiles = tiles_from_arrays(spark, _mixed_images(4)).withColumn("meta", F.when(F.col("image_id") != "m1", F.col("meta")))
    convert_tiles(tiles, f"{tmp_dir}/csv", fmt="csv")
    ends = sorted(r.value.split('))",')[1] for r in spark.read.text(f"{tmp_dir}/csv").collect())
    assert ends == sorted(["NZL,1970-01-01T00:00:00,0,0"] * 6 + ["1,1"] * 6 + ["2002,2,2"] * 6 + ["NZL,1970-01-01T00:00:00,3,3"] * 6)


def test_files_are_decoded_once_for_their_layouts_and_pixels(spark, tmp_dir):
    import json
    from rastertab.plans.jobs import convert_files
    from rastertab.sources.tiles import NpyRasterDecoder
    for im in _mixed_images(3):
        np.save(f"{tmp_dir}/{im['image_id']}.npy", im["data"])
        with open(f"{tmp_dir}/{im['image_id']}.json", "w") as fh:
            json.dump({k: im[k] for k in ("gt", "band_names", "band_type", "meta")}, fh)
    log = f"{tmp_dir}/log.txt"

    class Noted(NpyRasterDecoder):
        def read_block(self, path, *args):
            with open(log, "a") as fh:
                fh.write(path + "\n")
            return NpyRasterDecoder.read_block(self, path, *args)

    assert len(convert_files(spark, tmp_dir, Noted(), f"{tmp_dir}/out", glob="*.npy")) == 3
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 18
    with open(log) as fh:
        assert len(fh.readlines()) == 3


def test_text_of_a_turned_grid_is_made_by_rows(spark):
    """Per-pixel text is that of one row of pixels, and what a plain formula gives."""
    gt = (10.0, 0.1, 0.02, 50.0, 0.03, -0.1)
    data = np.arange(1.0, 701.0).reshape(1, 20, 35)
    tiles = tiles_from_arrays(spark, [{"image_id": "r", "data": data, "gt": gt, "band_names": ["v"], "band_type": "Float64"},
                                      {"image_id": "n", "data": -data, "gt": (10.0, 0.1, 0.0, 50.0, 0.0, -0.1), "band_names": ["v"],
                                       "band_type": "Float64"}], 16)
    rows = expand_pixels(tiles, PixelLayout(("v",), "Float64"), block_size=16, with_coords=True, keep=("image_id",)).collect()
    assert len(rows) == 1400
    for r in rows:
        g = gt if r.image_id == "r" else (10.0, 0.1, 0.0, 50.0, 0.0, -0.1)
        gx, gy = g[0] + (r.x + 0.5) * g[1] + (r.y + 0.5) * g[2], g[3] + (r.x + 0.5) * g[4] + (r.y + 0.5) * g[5]
        assert abs(r.v) == data[0, r.y, r.x] and (r.gx, r.gy) == (gx, gy) and r.geography == "POINT(%.10g %.10g)" % (gx, gy)
        assert r.geography_polygon.startswith("POLYGON ((%.10g %.10g," % (r.max_x, r.min_y))

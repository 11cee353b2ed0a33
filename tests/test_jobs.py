from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastertab.plans.forecast import forecast_layout, forecast_staging
from rastertab.plans.jobs import (convert_tiles, load_forecast_cycle, load_population_slice,
                                  load_productivity_year, select_images)
from raster_fixtures import tiles_from_arrays

GT = (170.0, 0.5, 0.0, -40.0, 0.0, -0.5)


def _forecast_tiles(spark, cycle_ms, hours=(0, 3, 6)):
    rng = np.random.default_rng(4)
    images = []
    for h in hours:
        meta = {"creation_time": str(cycle_ms), "forecast_time": str(cycle_ms + h * 3600000)}
        if h != 3:
            meta["forecast_hours"] = str(h)
        images.append({"image_id": f"f{h}", "data": rng.normal(size=(8, 3, 4)), "gt": GT,
                       "band_names": list(forecast_layout().band_names), "band_type": "Float32", "meta": meta})
    return tiles_from_arrays(spark, images)


def test_forecast_cycle_job_is_idempotent_and_isolated(spark, tmp_dir):
    c1, c2 = datetime(2024, 1, 1, 0), datetime(2024, 1, 1, 6)
    ms1, ms2 = 1704067200000, 1704067200000 + 6 * 3600000
    s1 = forecast_staging(_forecast_tiles(spark, ms1))
    s2 = forecast_staging(_forecast_tiles(spark, ms2))
    load_forecast_cycle(spark, s1, "gfs_fc", c1, location=f"{tmp_dir}/fc")
    load_forecast_cycle(spark, s2, "gfs_fc", c2, location=f"{tmp_dir}/fc")
    first = sorted(map(tuple, spark.table("gfs_fc").select("creation_time", "geography", F.size("forecast")).collect()))
    load_forecast_cycle(spark, s1, "gfs_fc", c1, location=f"{tmp_dir}/fc")
    again = sorted(map(tuple, spark.table("gfs_fc").select("creation_time", "geography", F.size("forecast")).collect()))
    assert first == again and len(first) == 24
    hours = spark.table("gfs_fc").select(F.transform("forecast", lambda e: e["hours"]).alias("h")).distinct().collect()
    assert [r.h for r in hours] == [[0, 3, 6]]
    with pytest.raises(ValueError, match="outside the slice"):
        load_forecast_cycle(spark, s1.unionByName(s2), "gfs_fc", c1, location=f"{tmp_dir}/fc")


def test_population_and_productivity_jobs(spark, tmp_dir):
    pop = spark.createDataFrame([("POINT(1 1)", "P1", "NZL", 2020, 5.0), ("POINT(2 2)", "P2", "NZL", 2020, 6.0),
                                 ("POINT(3 3)", "P3", "FRA", 2020, 7.0)],
                                "geography string, geography_polygon string, country string, year int, population double")
    load_population_slice(spark, pop, "pop_t", "NZL", 2020, location=f"{tmp_dir}/pop")
    load_population_slice(spark, pop, "pop_t", "FRA", 2020, location=f"{tmp_dir}/pop")
    load_population_slice(spark, pop, "pop_t", "NZL", 2020, location=f"{tmp_dir}/pop")
    assert spark.table("pop_t").count() == 3
    load_population_slice(spark, pop.where("false"), "pop_t", "NZL", 2020, location=f"{tmp_dir}/pop")
    assert [r.country for r in spark.table("pop_t").collect()] == ["FRA"]

    rows = spark.createDataFrame([("POINT(0.25 -0.25)", "P1", 5, 0, 2001), ("POINT(0.75 -0.25)", "P2", 6, 0, 2001)],
                                 "geography string, geography_polygon string, npp long, npp_qc long, year int")
    load_productivity_year(spark, rows, "npp_t", 2001, location=f"{tmp_dir}/npp")
    t = spark.table("npp_t")
    assert t.count() == 2 and t.where("geography LIKE 'POINT(0.25 -0.25)'").first().npp == 5
    with pytest.raises(ValueError):
        load_productivity_year(spark, rows, "npp_t", 2002, location=f"{tmp_dir}/npp")


def test_convert_and_select(spark, tmp_dir):
    tiles = tiles_from_arrays(spark, [{"image_id": "x", "data": np.arange(6.0).reshape(2, 3),
                                       "gt": (-180.0, 0.25, 0.0, 90.0, 0.0, -0.25), "band_names": ["b1"],
                                       "band_type": "Int16", "meta": {"year": "2020", "AREA_OR_POINT": "Area"}}])
    assert convert_tiles(tiles) == ["geography:GEOGRAPHY,geography_polygon:GEOGRAPHY,year:INTEGER,b1:INTEGER"]
    convert_tiles(tiles, f"{tmp_dir}/csv", fmt="csv")
    lines = sorted(open(p).read() for p in __import__("glob").glob(f"{tmp_dir}/csv/part-*"))
    text = "".join(lines)
    assert '"POINT(-179.875 89.875)","POLYGON ((-179.75 89.75, -179.75 90, -180 90, -180 89.75, -179.75 89.75))",2020,0\n' in text
    convert_tiles(tiles, f"{tmp_dir}/pq")
    assert spark.read.parquet(f"{tmp_dir}/pq").count() == 6
    catalog = spark.createDataFrame([("c/a_1", "2020-01-01", "2020-01-01"), ("c/b_1", "2020-01-01", "2020-01-01")],
                                    "image_id string, s string, e string").select(
        "image_id", F.col("s").cast("timestamp").alias("start_time"), F.col("e").cast("timestamp").alias("end_time"))
    from rastertab.sources.catalog import list_objects
    done = f"{tmp_dir}/done"
    __import__("os").makedirs(done)
    for name in ("a_1.parquet", "a_1.tif", "b_1.tif"):
        open(f"{done}/{name}", "wb").write(b"x")
    open(f"{done}/b_1.parquet", "wb").close()  # an empty output counts as missing
    rasters, outputs = (list_objects(spark, done, glob=f"*.{ext}") for ext in ("tif", "parquet"))
    pick = lambda **k: [(r.name, r.needs_download, r.needs_convert) for r in
                        select_images(catalog, "gfs", date="2020-01-01 00:00:00", rasters=rasters, outputs=outputs, **k).collect()]
    assert pick() == [("b_1", False, True)]
    assert pick(exclude="b_1") == []  # all done: nothing to do is no error
    assert sorted(pick(overwrite=True)) == [("a_1", True, True), ("b_1", True, True)]
    with pytest.raises(ValueError, match="no image found"):
        select_images(catalog, "gfs", date="2021-01-01 00:00:00")


def test_end_to_end_through_parquet_files(spark, tmp_dir):
    """Converter output files -> declared staging read -> cycle load."""
    tiles = _forecast_tiles(spark, 1704067200000)
    layout = forecast_layout()
    out = f"{tmp_dir}/gfs/date=2024-01-01/00/parquet"
    schema_text = convert_tiles(tiles, out, layout=layout)[0]
    assert "forecast_hours:INTEGER" in schema_text
    assert dict(spark.read.parquet(out).dtypes)["forecast_hours"] == "int"
    load_forecast_cycle(spark, f"{out}/*.parquet", "gfs_files", datetime(2024, 1, 1, 0), location=f"{tmp_dir}/t")
    t = spark.table("gfs_files")
    rows = t.select("geography", F.transform("forecast", lambda e: e["hours"]).alias("h"),
                    F.col("forecast")[0]["downward_shortwave_radiation_flux"].alias("rad")).collect()
    assert len(rows) == 12 and all(r.h == [0, 3, 6] and r.rad is None for r in rows)
    assert dict(t.dtypes)["creation_time"] == "timestamp_ntz"


def test_population_countries_in_one_job(spark, tmp_dir):
    from rastertab.plans.jobs import load_population_countries
    cols = "geography string, geography_polygon string, country string, year int, population double"
    first = spark.createDataFrame([("P1", "Q1", "NZL", 2020, 1.0), ("P2", "Q2", "FRA", 2020, 2.0),
                                   ("P3", "Q3", "USA", 2020, 3.0), ("P4", "Q4", "NZL", 2019, 4.0)], cols)
    load_population_countries(spark, first, "pop_multi", 2020, "NZL,FRA,USA", location=f"{tmp_dir}/pm")
    load_population_countries(spark, first, "pop_multi", 2019, ["NZL"], location=f"{tmp_dir}/pm")
    second = spark.createDataFrame([("P5", "Q5", "NZL", 2020, 5.0), ("P6", "Q6", "DEU", 2020, 6.0)], cols)
    cleared = load_population_countries(spark, second, "pop_multi", 2020, "NZL,FRA", location=f"{tmp_dir}/pm")
    assert cleared == ["FRA"]
    got = sorted((r.country, r.year, r.population) for r in spark.table("pop_multi").collect())
    assert got == [("NZL", 2019, 4.0), ("NZL", 2020, 5.0), ("USA", 2020, 3.0)]


def test_csv_line_with_string_datetime_and_float_bands(spark):
    from rastertab.operators.attributes import PixelLayout
    from rastertab.sinks.csv_text import csv_lines
    tiles = tiles_from_arrays(spark, [{"image_id": "x", "data": np.array([[[0.1234567, -2.5]]]),
                                       "gt": (10.0, 0.5, 0.0, 0.0, 0.0, -0.5), "band_names": ["t"],
                                       "band_type": "Float32",
                                       "meta": {"country": "NZL", "creation_time": "1600000000999"}}])
    layout = PixelLayout(("t",), "Float32", (("country", "string"), ("creation_time", "datetime")))
    lines = sorted(r.line for r in csv_lines(tiles, layout).collect())
    assert lines == [
        '"POINT(10.25 -0.25)","POLYGON ((10.5 -0.5, 10.5 0, 10 0, 10 -0.5, 10.5 -0.5))",NZL,2020-09-13T12:26:40,0.123457',
        '"POINT(10.75 -0.25)","POLYGON ((11 -0.5, 11 0, 10.5 0, 10.5 -0.5, 11 -0.5))",NZL,2020-09-13T12:26:40,-2.5',
    ]


def test_productivity_from_sinusoidal_tiles(spark, tmp_dir):
    from rastertab.plans.jobs import load_productivity_from_tiles
    s = 50000.0
    data = np.stack([np.arange(200.0).reshape(10, 20), np.full((10, 20), 7.0)])
    tiles = tiles_from_arrays(spark, [{"image_id": "MOD/2003_01_01", "data": data, "gt": (0.0, s, 0.0, 0.0, 0.0, -s),
                                       "band_names": ["Npp", "Npp_QC"], "band_type": "Int16", "meta": {}}])
    load_productivity_from_tiles(spark, tiles, "npp_tiles", 2003, (0.0, s, 0.0, 0.0, 0.0, -s), 20, 10,
                                 (0.0, 0.5, 0.0, 0.0, 0.0, -0.5), 18, 9, location=f"{tmp_dir}/npp")
    t = spark.table("npp_tiles")
    assert t.count() > 0 and {r.year for r in t.select("year").distinct().collect()} == {2003}
    r = t.where("geography = 'POINT(0.25 -0.25)'").first()
    assert r.npp == 0 and r.npp_qc == 7
    with pytest.raises(ValueError, match="outside the slice"):
        load_productivity_from_tiles(spark, tiles, "npp_tiles", 2004, (0.0, s, 0.0, 0.0, 0.0, -s), 20, 10,
                                     (0.0, 0.5, 0.0, 0.0, 0.0, -0.5), 18, 9, location=f"{tmp_dir}/npp")


def test_select_images_per_task(spark):
    catalog = spark.createDataFrame(
        [("WP/NZL_2020", "2020-01-01", "2021-01-01", "NZL", 2020), ("WP/FRA_2020", "2020-01-01", "2021-01-01", "FRA", 2020),
         ("NPP/2001_01_01", "2001-01-01", "2001-01-01", None, 2001)],
        "image_id string, s string, e string, country string, year int").select(
        "image_id", F.col("s").cast("timestamp").alias("start_time"), F.col("e").cast("timestamp").alias("end_time"),
        "country", "year")
    assert [r.name for r in select_images(catalog, "world_pop", country="NZL", year=2020).collect()] == ["NZL_2020"]
    assert [r.name for r in select_images(catalog, "annual_npp", date="2001-01-01 00:00:00").collect()] == ["2001_01_01"]
    with pytest.raises(ValueError):
        select_images(catalog, "world_pop", country="NZL")
    with pytest.raises(ValueError):
        select_images(catalog, "unknown", date="2001-01-01 00:00:00")


def test_missing_input_files_fail_the_jobs(spark, tmp_dir):
    for load in (lambda p: load_forecast_cycle(spark, p, "gfs_none", datetime(2024, 1, 1), location=f"{tmp_dir}/a"),
                 lambda p: load_population_slice(spark, p, "pop_none", "NZL", 2020, location=f"{tmp_dir}/b"),
                 lambda p: load_productivity_year(spark, p, "npp_none", 2001, location=f"{tmp_dir}/c")):
        with pytest.raises(FileNotFoundError):
            load(f"{tmp_dir}/nothing/*.parquet")


def test_csv_keeps_the_field_of_a_missing_band(spark):
    from rastertab.operators.attributes import PixelLayout
    from rastertab.sinks.csv_text import csv_lines
    tiles = spark.createDataFrame([("a", [0.0, 1.0, 0.0, 1.0, 0.0, -1.0], 0, 0, 1, 1, {"year": "2020"}, [[None], [4.0]])],
                                  "image_id string, gt array<double>, ix int, iy int, xblock int, yblock int, "
                                  "meta map<string,string>, bands array<array<double>>")
    for kind, last in (("Int16", "4"), ("Float32", "4")):
        line = csv_lines(tiles, PixelLayout(("a", "b"), kind, (("year", "integer"),))).first().line
        assert line.endswith(f"))\",2020,,{last}")


def test_mixed_schemas_convert_into_one_folder(spark, tmp_dir):
    images = [{"image_id": n, "data": [[v]], "gt": GT, "band_names": [b], "band_type": "Float32", "meta": m}
              for n, v, b, m in (("p", 1.0, "a", {"year": "2020"}), ("q", 2.0, "b", {"country": "NZL"}), ("r", 3.0, "a", {"year": "2021"}))]
    texts = convert_tiles(tiles_from_arrays(spark, images), f"{tmp_dir}/mixed")
    assert len(texts) == 2
    rows = spark.read.schema("year int, country string, a double, b double").parquet(f"{tmp_dir}/mixed").collect()
    assert sorted(map(repr, rows)) == sorted(repr(type(rows[0])(year=y, country=c, a=a, b=b)) for y, c, a, b in
                                             ((2020, None, 1.0, None), (None, "NZL", None, 2.0), (2021, None, 3.0, None)))

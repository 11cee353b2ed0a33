import os

import pytest
from pyspark.sql import functions as F

from rastertab.operators.filters import include_exclude, pending, require
from rastertab.sources import catalog as cat


def _catalog(spark):
    return spark.createDataFrame([
        ("GFS/2024010100F000", "gfs", "2024-01-01 00:00:00", "2024-01-01 00:00:00", None, None, 0),
        ("GFS/2024010100F003", "gfs", "2024-01-01 00:00:00", "2024-01-01 00:00:00", None, None, 3),
        ("GFS/2024010106F000", "gfs", "2024-01-01 06:00:00", "2024-01-01 06:00:00", None, None, 0),
        ("POP/NZL_2020", "pop", "2020-01-01 00:00:00", "2021-01-01 00:00:00", "NZL", 2020, None),
        ("POP/FRA_2020", "pop", "2020-01-01 00:00:00", "2021-01-01 00:00:00", "FRA", 2020, None),
    ], "image_id string, collection string, start_time string, end_time string, country string, year int, "
       "forecast_hours int").withColumn("start_time", F.col("start_time").cast("timestamp")) \
        .withColumn("end_time", F.col("end_time").cast("timestamp"))


def test_catalog_selections(spark):
    c = _catalog(spark)
    assert cat.select_cycle(c, "2024-01-01 00:00:00").count() == 2
    assert cat.select_country_year(c, "NZL", 2020).count() == 1
    assert cat.select_from_horizon(c, "2024-01-01 00:00:00", 0).count() == 2
    assert cat.select_year(c, 2020).count() == 2
    with pytest.raises(ValueError):
        cat.require_nonempty(cat.select_year(c, 1999))
    assert sorted(r.image_id for r in cat.select_year(c, 2020).collect()) == ["POP/FRA_2020", "POP/NZL_2020"]


def test_pushdown_to_parquet_scan(spark, tmp_dir):
    _catalog(spark).write.parquet(f"{tmp_dir}/cat")
    sel = cat.select_country_year(spark.read.parquet(f"{tmp_dir}/cat"), "NZL", 2020).select("image_id")
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(country,NZL)" in plan and "ReadSchema: struct<image_id" in plan


def test_include_exclude_and_pending(spark):
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    assert sorted(r.name for r in include_exclude(names, F.col("name"), "a,b", "b").collect()) == ["a"]
    assert names.transform(lambda d: include_exclude(d, F.col("name"), None, "c")).count() == 2
    outputs = spark.createDataFrame([("a", 10), ("b", 0)], "name string, length bigint")
    assert sorted(r.name for r in pending(names, outputs, "name").collect()) == ["b", "c"]
    assert pending(names, outputs, "name", overwrite=True).count() == 3
    with pytest.raises(ValueError):
        require("", "bucket")


def test_readiness_and_paths(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/gfs/date=2024-01-01/06/parquet")
    open(f"{tmp_dir}/gfs/date=2024-01-01/06/parquet/a.parquet", "wb").write(b"x")
    open(f"{tmp_dir}/empty.parquet", "wb").close()
    assert cat.object_ready(spark, f"{tmp_dir}/gfs/date=2024-01-01/06/parquet/a.parquet")
    assert not cat.object_ready(spark, f"{tmp_dir}/empty.parquet")
    assert not cat.object_ready(spark, f"{tmp_dir}/missing.parquet")
    assert cat.prefix_ready(spark, f"{tmp_dir}/gfs")
    assert cat.prefix_ready(spark, f"{tmp_dir}/gfs/date=2024-01-01/06/parq")  # the beginning of a name
    assert not cat.prefix_ready(spark, f"{tmp_dir}/nothing")
    assert cat.single_wildcard("b/dir/x_*.tif") == ("b/dir", "x_*.tif")
    with pytest.raises(ValueError):
        cat.single_wildcard("b/*/x_*.tif")
    df = spark.createDataFrame([("o/gfs/date=2024-01-02/18/parquet/f.parquet", "o/world_pop/year=2020/parquet/NZL_2020.parquet")],
                               "p string, q string")
    d, h = cat.forecast_slice_from_path(F.col("p"))
    c, y = cat.population_slice_from_path(F.col("q"))
    r = df.select(d.cast("string").alias("d"), h.alias("h"), c.alias("c"), y.alias("y")).first()
    assert (r.d, r.h, r.c, r.y) == ("2024-01-02", 18, "NZL", 2020)


def test_plan_exports_two_independent_checks(spark):
    from rastertab.operators.filters import plan_exports
    sel = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "name string")
    tifs = spark.createDataFrame([("a", 5), ("b", 5), ("c", 0)], "name string, length bigint")
    pqs = spark.createDataFrame([("a", 7), ("c", 7)], "name string, length bigint")
    got = sorted((r.name, r.needs_download, r.needs_convert) for r in plan_exports(sel, tifs, pqs).collect())
    assert got == [("b", False, True), ("c", True, False), ("d", True, True)]
    assert plan_exports(sel, tifs, pqs, overwrite=True).count() == 4


def test_slice_attributes_from_file_paths(spark, tmp_dir):
    for day, hour in (("2024-01-01", "06"), ("2024-01-02", "18")):
        spark.range(3).write.parquet(f"{tmp_dir}/out/gfs/date={day}/{hour}/parquet")
    df = cat.with_source_path(spark.read.parquet(f"{tmp_dir}/out/gfs/date=*/*/parquet"))
    d, h = cat.forecast_slice_from_path(F.col("source_path"))
    got = sorted({(r.d, r.h) for r in df.select(d.cast("string").alias("d"), h.alias("h")).collect()})
    assert got == [("2024-01-01", 6), ("2024-01-02", 18)]


def test_a_range_of_cycles_lists_its_folders_only(spark, tmp_dir, monkeypatch):
    import os
    from datetime import datetime, timedelta

    from rastertab.sources import catalog as cat
    first = datetime(2024, 1, 1)
    for i in range(100):
        c = first + timedelta(hours=6 * i)
        folder = f"{tmp_dir}/gfs/date={c:%Y-%m-%d}/{c:%H}/parquet"
        os.makedirs(folder)
        for name, body in ((f"f{i}.parquet", b"x" * (i + 1)), ("notes.txt", b"y")):
            with open(f"{folder}/{name}", "wb") as fh:
                fh.write(body)
    wanted = cat.forecast_folders(tmp_dir, datetime(2024, 1, 25, 6), datetime(2024, 1, 26, 0))
    assert len(wanted) == 4 and wanted[0] == f"{tmp_dir}/gfs/date=2024-01-25/06/parquet/"
    looked, real = [], cat._hadoop_path
    monkeypatch.setattr(cat, "_hadoop_path", lambda s, text: (looked.append(text), real(s, text))[1])
    listing = cat.list_folders(spark, wanted, "*.parquet")
    assert looked == wanted
    d, h = cat.forecast_slice_from_path(F.col("path"))
    got = sorted(tuple(r) for r in listing.select(d.cast("string"), h, "length").collect())
    assert got == [("2024-01-25", 6, 98), ("2024-01-25", 12, 99), ("2024-01-25", 18, 100)]  # the fourth cycle has no folder
    assert cat.list_folders(spark, cat.population_folders(tmp_dir, [2020, 2021])).count() == 0


def test_prefix_ready_stops_at_the_first_object(spark, tmp_dir):
    import os

    from rastertab.sources import catalog as cat
    os.makedirs(f"{tmp_dir}/out/gfs/date=2024-01-01/06/parquet/_temporary")
    assert not cat.prefix_ready(spark, f"{tmp_dir}/out/gfs/date=2024") and not cat.prefix_ready(spark, f"{tmp_dir}/none/x")
    open(f"{tmp_dir}/out/gfs/date=2024-01-01/06/parquet/_SUCCESS", "w").close()
    assert not cat.prefix_ready(spark, f"{tmp_dir}/out/gfs/date=2024")
    open(f"{tmp_dir}/out/gfs/date=2024-01-01/06/parquet/a.parquet", "w").close()
    assert cat.prefix_ready(spark, f"{tmp_dir}/out/gfs/date=2024") and cat.prefix_ready(spark, f"{tmp_dir}/out/gfs/date=2024-01-01/06/parquet/a")
    assert not cat.prefix_ready(spark, f"{tmp_dir}/out/gfs/date=2025")

import pytest
from pyspark.sql import functions as F

from rastertab.functions.params import parameter
from rastertab.functions.text import comma_list, flatten_lists
from rastertab.functions.wkt import st_geogfromtext
from rastertab.operators.filters import require_input
from rastertab.sinks.tables import create_database, create_or_replace_view, query_to_table, temp_table


def test_parameters():
    from datetime import date, datetime
    given = {"a": "YES", "b": "no", "c": " ", "d": "2020-01-02", "e": "2020-01-02T06:00:00", "f": "7", "g": "maybe", "h": True}
    assert parameter(given, "a", bool) is True and parameter(given, "b", bool) is False and parameter(given, "h", bool) is True
    assert parameter(given, "c", bool, False) is False and parameter(given, "missing", int, 3) == 3
    assert parameter(given, "d", date) == date(2020, 1, 2) and parameter(given, "e", datetime) == datetime(2020, 1, 2, 6)
    assert parameter(given, "f", int) == 7 and parameter(given, "f", str) == "7"
    for name, kind in (("g", bool), ("g", int), ("f", date)):
        with pytest.raises(ValueError, match=f"parameter {name}"):
            parameter(given, name, kind)


def test_text_helpers(spark):
    r = spark.createDataFrame([("a, b,c", [[1, 2], [3]])], "s string, l array<array<int>>").select(
        comma_list(F.col("s")).alias("c"), flatten_lists(F.col("l")).alias("f")).first()
    assert r.c == ["a", "b", "c"] and r.f == [1, 2, 3]


def test_geog_from_text_validates(spark):
    ok = spark.createDataFrame([("POINT(1.5 -2)",), ("POLYGON ((1 1, 1 2, 0 2, 0 1, 1 1))",), (None,)], "g string")
    assert ok.select(st_geogfromtext(F.col("g"))).count() == 3
    bad = spark.createDataFrame([("POINT(1 2 3)",)], "g string")
    with pytest.raises(Exception, match="invalid WKT"):
        bad.select(st_geogfromtext(F.col("g"))).collect()


def test_database_ctas_view_temp(spark, tmp_dir):
    create_database(spark, "rt_db", f"{tmp_dir}/db")
    create_database(spark, "rt_db")  # exists: tolerated
    spark.range(5).createOrReplaceTempView("five")
    query_to_table(spark, "SELECT id * 2 AS v FROM five", "rt_db.doubled")
    assert sorted(r.v for r in spark.table("rt_db.doubled").collect()) == [0, 2, 4, 6, 8]
    create_or_replace_view(spark, "SELECT v FROM rt_db.doubled WHERE v > 4", "big_v", temporary=True)
    create_or_replace_view(spark, "SELECT v FROM rt_db.doubled WHERE v > 2", "big_v", temporary=True)
    assert spark.table("big_v").count() == 3
    temp_table(spark.range(2), "tmp_two")
    assert spark.table("tmp_two").count() == 2
    spark.catalog.dropTempView("tmp_two")


def test_require_input(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        require_input(spark, f"{tmp_dir}/missing.tif")
    open(f"{tmp_dir}/x.tif", "wb").write(b"1")
    require_input(spark, f"{tmp_dir}/x.tif")


def test_scratch_lies_in_the_folder_the_session_names(spark):
    import pathlib

    import rastertab
    from rastertab.session import scratch_path, shared_folder
    assert scratch_path(spark, "x").startswith(f"{shared_folder(spark)}/rastertab/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    for path in pathlib.Path(rastertab.__file__).parent.rglob("*.py"):  # the library itself keeps nothing in a local temp folder
        assert "llm" in path.parts or "tempfile" not in path.read_text(), path


def test_scratch_is_removed_when_released(spark):
    import os

    from rastertab.session import release_scratch, scratch_mark, scratch_path
    mark = scratch_mark()
    paths = [scratch_path(spark, "gone") for _ in range(2)]
    for p in paths:
        spark.range(3).write.parquet(p)
    kept = scratch_path(spark, "never-written")
    local = [p.removeprefix("file:") for p in (*paths, kept)]
    assert [os.path.exists(p) for p in local] == [True, True, False]
    assert release_scratch(spark, mark) == 2 and not any(os.path.exists(p) for p in local)
    assert scratch_mark() == mark and release_scratch(spark, mark) == 0

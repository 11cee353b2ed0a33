import pytest
from pyspark.sql import functions as F

from rastertab.sinks.tables import (create_table, replace_partition, replace_slice_logical, slice_predicate,
                                    staging_name, truncate_load)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_slice_replace_idempotent_and_isolated(spark, tmp_dir):
    base = spark.createDataFrame([(1, "a", 2019, "NZL"), (2, "b", 2020, "NZL"), (3, "c", 2020, "FRA")],
                                 "id int, v string, year int, country string")
    truncate_load(base, "t_pop", partition_by=("year", "country"), location=f"{tmp_dir}/pop")
    src = spark.createDataFrame([(9, "z", 2020, "NZL"), (8, "y", 2020, "FRA")], "id int, v string, year int, country string")
    replace_partition(spark, src, "t_pop", {"year": 2020, "country": "NZL"}, on_foreign_rows="ignore")
    once = _rows(spark.table("t_pop"))
    replace_partition(spark, src, "t_pop", {"year": 2020, "country": "NZL"}, on_foreign_rows="ignore")
    assert _rows(spark.table("t_pop")) == once
    assert once == sorted([(1, "a", 2019, "NZL"), (9, "z", 2020, "NZL"), (3, "c", 2020, "FRA")])
    logical = replace_slice_logical(base, src, slice_predicate({"year": 2020, "country": "NZL"}))
    assert _rows(logical) == once
    # empty source clears exactly that slice
    replace_partition(spark, src.where("id < 0"), "t_pop", {"year": 2020, "country": "NZL"})
    assert _rows(spark.table("t_pop")) == sorted([(1, "a", 2019, "NZL"), (3, "c", 2020, "FRA")])


def test_foreign_rows_raise_before_delete(spark, tmp_dir):
    base = spark.createDataFrame([(1, 2019), (2, 2020)], "id int, year int")
    truncate_load(base, "t_year", partition_by=("year",), location=f"{tmp_dir}/y")
    with pytest.raises(ValueError, match="outside the slice"):
        replace_partition(spark, base, "t_year", {"year": 2020})
    assert _rows(spark.table("t_year")) == [(1, 2019), (2, 2020)]


def test_timestamp_ntz_partition_replace(spark, tmp_dir):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("v", T.LongType()), T.StructField("creation_time", T.TimestampNTZType())])
    create_table(spark, "t_cycles", schema, partition_by=("creation_time",), location=f"{tmp_dir}/c")
    df = spark.range(3).select(F.col("id").alias("v"),
                               F.lit("2024-01-01 06:00:00").cast("timestamp_ntz").alias("creation_time"))
    replace_partition(spark, df, "t_cycles", {"creation_time": "2024-01-01 06:00:00"})
    replace_partition(spark, df, "t_cycles", {"creation_time": "2024-01-01 06:00:00"})
    t = spark.table("t_cycles")
    assert t.count() == 3 and dict(t.dtypes)["creation_time"] == "timestamp_ntz"
    plan = t.where(F.col("creation_time") == F.lit("2024-01-01 06:00:00").cast("timestamp_ntz"))._jdf \
        .queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_staging_name():
    assert staging_name("gfs", "2024010106") == "gfs_2024010106"
    assert staging_name("pop", "NZL", 2020) == "pop_NZL_2020"


def test_failed_load_keeps_previous_slice(spark, tmp_dir):
    base = spark.createDataFrame([(1, 2019), (2, 2020)], "id int, year int")
    truncate_load(base, "t_safe", partition_by=("year",), location=f"{tmp_dir}/safe")
    bad = spark.createDataFrame([(5, 2020), (6, 2020)], "id int, year int").withColumn(
        "id", F.when(F.col("id") == 6, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        replace_partition(spark, bad, "t_safe", {"year": 2020})
    assert _rows(spark.table("t_safe")) == [(1, 2019), (2, 2020)]


def test_concurrent_slice_loads_into_one_table(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor
    base = spark.createDataFrame([(i, 2000 + i % 4) for i in range(40)], "id int, year int")
    truncate_load(base, "t_conc", partition_by=("year",), location=f"{tmp_dir}/conc")

    def load(y):
        src = spark.range(100).selectExpr(f"CAST(id + {y * 1000} AS INT) AS id", f"{y} AS year")
        replace_partition(spark, src, "t_conc", {"year": y})

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(load, [2000, 2001, 2002]))
    counts = {r.year: r.n for r in spark.table("t_conc").groupBy("year").agg(F.count("*").alias("n")).collect()}
    assert counts == {2000: 100, 2001: 100, 2002: 100, 2003: 10}


def test_load_slice_from_staging(spark, tmp_dir):
    from rastertab.sinks.tables import load_slice_from_staging
    base = spark.createDataFrame([(1, 2019), (2, 2020)], "id int, year int")
    truncate_load(base, "t_stg_dest", partition_by=("year",), location=f"{tmp_dir}/d")
    new = spark.createDataFrame([(7, 2020), (8, 2020)], "id int, year int")
    load_slice_from_staging(spark, new, "t_stg_2020", "t_stg_dest", {"year": 2020},
                            transform=lambda df: df.withColumn("id", F.col("id") * 10))
    assert _rows(spark.table("t_stg_dest")) == [(1, 2019), (70, 2020), (80, 2020)]


def test_a_job_that_dies_before_the_switch_leaves_the_old_slice(spark, tmp_dir, monkeypatch):
    from rastertab.sinks import tables
    base = spark.createDataFrame([(1, 2019), (2, 2020)], "id int, year int")
    truncate_load(base, "t_switch", partition_by=("year",), location=f"{tmp_dir}/switch")
    new = spark.createDataFrame([(7, 2020), (8, 2020)], "id int, year int")

    def killed(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(tables, "point_slices", killed)
        for load in (lambda: replace_partition(spark, new, "t_switch", {"year": 2020}),
                     lambda: tables.replace_partitions(spark, new, "t_switch")):
            with pytest.raises(KeyboardInterrupt):
                load()
            assert _rows(spark.table("t_switch")) == [(1, 2019), (2, 2020)]  # the rows are written, nothing points to them
    with monkeypatch.context() as m:
        m.setattr(tables, "_remove", killed)  # dies after the switch
        with pytest.raises(KeyboardInterrupt):
            replace_partition(spark, new, "t_switch", {"year": 2020})
    assert _rows(spark.table("t_switch")) == [(1, 2019), (7, 2020), (8, 2020)]
    replace_partition(spark, new.where("id = 8"), "t_switch", {"year": 2020})
    assert _rows(spark.table("t_switch")) == [(1, 2019), (8, 2020)]


def test_a_switch_removes_the_old_folder(spark, tmp_dir):
    import glob
    base = spark.createDataFrame([(1, 2019), (2, 2020)], "id int, year int")
    truncate_load(base, "t_clean", partition_by=("year",), location=f"{tmp_dir}/clean")
    for i in range(3):
        replace_partition(spark, spark.createDataFrame([(i, 2020)], "id int, year int").coalesce(1), "t_clean", {"year": 2020})
        assert len(glob.glob(f"{tmp_dir}/clean/**/*.parquet", recursive=True)) == 2
        assert len(spark.table("t_clean").inputFiles()) == 2
    replace_partition(spark, base.where("id < 0"), "t_clean", {"year": 2020})
    assert len(glob.glob(f"{tmp_dir}/clean/**/*.parquet", recursive=True)) == 1
    assert _rows(spark.table("t_clean")) == [(1, 2019)]


def test_many_slices_in_one_job_with_odd_keys(spark, tmp_dir):
    from rastertab.sinks.tables import replace_listed_slices, replace_partitions
    base = spark.createDataFrame([(i, k) for i, k in enumerate(["a b", "it's", "x=y/z", "100%", None, "ü", "old"])], "id int, k string")
    truncate_load(base, "t_odd", partition_by=("k",), location=f"{tmp_dir}/odd")
    new = base.where("k <> 'old' OR k IS NULL").selectExpr("id + 10 AS id", "k")
    assert len(replace_partitions(spark, new, "t_odd")) == 6
    want = sorted([(i + 10, k) for i, k in enumerate(["a b", "it's", "x=y/z", "100%", None, "ü"])] + [(6, "old")], key=str)
    assert sorted(((r.id, r.k) for r in spark.table("t_odd").collect()), key=str) == want
    assert replace_listed_slices(spark, new.where("k = 'ü'"), "t_odd", "k", ["ü", "old", "never"]) == ["old"]
    assert spark.table("t_odd").where("k = 'old'").count() == 0 and spark.table("t_odd").count() == 6

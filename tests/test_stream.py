import shutil

from pyspark.sql import types as T

from rastertab.sinks.tables import create_table
from rastertab.streaming.incremental import day_slice, incremental_slice_load


def test_slice_split_over_two_batches_is_kept_whole(spark, tmp_dir):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType())])
    src = f"{tmp_dir}/in"
    spark.createDataFrame([(1, "2024-01-01 01:00:00"), (2, "2024-01-02 01:00:00")], "id long, ts string") \
        .selectExpr("id", "cast(ts as timestamp) ts").coalesce(1).write.parquet(f"{tmp_dir}/stage1")
    spark.createDataFrame([(3, "2024-01-01 05:00:00")], "id long, ts string") \
        .selectExpr("id", "cast(ts as timestamp) ts").coalesce(1).write.parquet(f"{tmp_dir}/stage2")
    import glob, os
    os.makedirs(src)
    shutil.copy(glob.glob(f"{tmp_dir}/stage1/*.parquet")[0], f"{src}/a.parquet")
    create_table(spark, "t_stream", schema.add("day", "string"), partition_by=("day",), location=f"{tmp_dir}/t")
    ck = f"{tmp_dir}/ck"
    incremental_slice_load(spark, src, schema, "t_stream", {"day": day_slice("ts")}, ck)
    assert spark.table("t_stream").count() == 2
    # a later file adds to an existing day: the day is rebuilt from the whole source
    shutil.copy(glob.glob(f"{tmp_dir}/stage2/*.parquet")[0], f"{src}/b.parquet")
    incremental_slice_load(spark, src, schema, "t_stream", {"day": day_slice("ts")}, ck)
    got = sorted((r.id, r.day) for r in spark.table("t_stream").collect())
    assert got == [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-01")]


def test_partitioned_source_slices_prune(spark, tmp_dir):
    from pyspark.sql import functions as F
    src = f"{tmp_dir}/src"
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-01")], "id long, day string")
    df.write.partitionBy("day").parquet(src)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.StringType())])
    create_table(spark, "t_stream_p", schema, partition_by=("day",), location=f"{tmp_dir}/tp")
    incremental_slice_load(spark, src, schema, "t_stream_p", {"day": None}, f"{tmp_dir}/ckp")
    got = sorted((r.id, r.day) for r in spark.table("t_stream_p").collect())
    assert got == [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-01")]


def test_one_file_per_batch_keeps_slices_whole(spark, tmp_dir):
    import os
    src = f"{tmp_dir}/many"
    os.makedirs(src)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType())])
    for i in range(4):  # four files, all on the same day, one file per micro-batch
        spark.createDataFrame([(i, "2024-03-01 0%d:00:00" % i)], "id long, ts string") \
            .selectExpr("id", "cast(ts as timestamp) ts").coalesce(1).write.mode("overwrite").parquet(f"{tmp_dir}/s{i}")
        f = [p for p in os.listdir(f"{tmp_dir}/s{i}") if p.endswith(".parquet")][0]
        shutil.copy(f"{tmp_dir}/s{i}/{f}", f"{src}/f{i}.parquet")
    create_table(spark, "t_stream_many", T.StructType([*schema.fields, T.StructField("day", T.StringType())]),
                 partition_by=("day",), location=f"{tmp_dir}/tm")
    incremental_slice_load(spark, src, schema, "t_stream_many", {"day": day_slice("ts")}, f"{tmp_dir}/ckm",
                           max_files_per_trigger=1)
    assert sorted(r.id for r in spark.table("t_stream_many").collect()) == [0, 1, 2, 3]


def test_a_batch_registers_touched_slices_only(spark, tmp_dir, monkeypatch):
    """No statement of a batch names the whole table or an untouched slice."""
    import os
    from pyspark.sql import SparkSession
    src = f"{tmp_dir}/reg"
    os.makedirs(src)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType())])

    def arrive(name, rows):
        spark.createDataFrame(rows, "id long, ts string").selectExpr("id", "cast(ts as timestamp) ts").coalesce(1) \
            .write.parquet(f"{tmp_dir}/{name}")
        f = [p for p in os.listdir(f"{tmp_dir}/{name}") if p.endswith(".parquet")][0]
        shutil.copy(f"{tmp_dir}/{name}/{f}", f"{src}/{name}.parquet")

    create_table(spark, "t_stream_reg", T.StructType([*schema.fields, T.StructField("day", T.StringType())]),
                 partition_by=("day",), location=f"{tmp_dir}/treg")
    arrive("a", [(i, f"2024-05-{i + 1:02d} 00:00:00") for i in range(9)])
    incremental_slice_load(spark, src, schema, "t_stream_reg", {"day": day_slice("ts")}, f"{tmp_dir}/ckreg")
    said, real = [], SparkSession.sql
    monkeypatch.setattr(SparkSession, "sql", lambda self, text, *a, **b: (said.append(text), real(self, text, *a, **b))[1])
    arrive("b", [(20, "2024-05-03 10:00:00"), (21, "2024-06-01 10:00:00")])
    incremental_slice_load(spark, src, schema, "t_stream_reg", {"day": day_slice("ts")}, f"{tmp_dir}/ckreg")
    named = [t for t in said if "PARTITION" in t]
    assert named and not any("RECOVER" in t or "REPAIR" in t for t in said)
    assert all("2024-05-03" in t or "2024-06-01" in t for t in named)
    assert sorted(r.id for r in spark.table("t_stream_reg").collect()) == [*range(9), 20, 21]

"""Incremental slice loads (STR-1, STR-2).

New files under a folder are picked up by a file-source stream
(``availableNow`` trigger = process what has arrived, then stop; the checkpoint
remembers which files were seen).  Each micro-batch lands its rows in folders by
slice and batch, then rebuilds the slices it touched from their folders, so a
slice whose files arrive over many batches is whole.  A batch reads, lists and
registers the folders of the slices it touched and no others: the folder of a
slice is named by a hash of its keys, and the writing job reports which it wrote.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastertab.sinks.tables import SLICE, replace_partitions, slice_name

BATCH = "_batch"  # folder below the slice's in the landing place


def with_slice(df: DataFrame, slice_cols: dict[str, Callable | None]) -> DataFrame:
    """Adds derived slice columns; ``None`` keeps an existing column."""
    for name, fn in slice_cols.items():
        if fn is not None:
            df = df.withColumn(name, fn(df))
    return df


def land(batch: DataFrame, landing: str, keys, epoch: int) -> list[str]:
    """Write a batch into its own ``_slice=.../_batch=epoch`` folders; a
    replayed batch overwrites exactly them.  Returns the slices' folder names
    (one per slice touched)."""
    touched = Observation()
    rows = batch.withColumns({SLICE: slice_name(keys), BATCH: F.lit(int(epoch)).cast("long")})
    rows = rows.observe(touched, F.collect_set(SLICE).alias("slices"))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SLICE, BATCH).parquet(landing))
    return sorted(touched.get["slices"])


def touched_slices(spark: SparkSession, landing: str, schema: T.StructType, touched: list[str]) -> DataFrame:
    """All landed rows of the named slices, from their folders alone."""
    if not touched:
        return spark.createDataFrame([], schema)
    paths = [f"{landing}/{SLICE}={name}" for name in touched]
    return spark.read.schema(schema).option("basePath", landing).parquet(*paths).select(*schema.fieldNames())


def incremental_slice_load(spark: SparkSession, source_dir: str, schema: T.StructType, table: str,
                           slice_cols: dict[str, Callable | None], checkpoint: str, glob: str | None = None,
                           transform=None, max_files_per_trigger: int | None = None, landing: str | None = None,
                           cluster_by=()) -> None:
    """Run the stream until everything that has arrived is loaded.  ``landing``
    is the shared folder of landed rows (beside the checkpoint by default)."""
    landing = landing or f"{checkpoint.rstrip('/')}-landing"
    keys = list(slice_cols)
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = with_slice(reader.parquet(source_dir), slice_cols)
    landed_schema = stream.schema

    def each_batch(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        whole = touched_slices(session, landing, landed_schema, land(batch, landing, keys, epoch))
        replace_partitions(session, transform(whole) if transform else whole, table,
                           cluster_by=cluster_by or [c for c in landed_schema.fieldNames() if c not in keys][:1])

    q = (stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    # the batches wrote from the stream's own session: drop this session's file listing
    spark.catalog.refreshTable(table)


def day_slice(col: str = "ts") -> Callable:
    return lambda df: F.date_format(F.col(col), "yyyy-MM-dd")

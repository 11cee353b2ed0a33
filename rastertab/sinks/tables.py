"""Table writers (SNK-2 .. SNK-14, FLT-4, FLT-5, JN-1).

Replace units are partitions: a forecast cycle, a (year, country) slice, a
year.  A replace touches exactly one partition and leaves every other one
untouched, and it commits by pointer: the rows are written to a fresh folder
under the table's ``_slices``, then one catalog call makes the partition stand
there (or drops the partition when there are no rows), then the old folder is
removed.  A job that fails or is killed before that call leaves the old slice
as it was; after it, at worst a folder that nothing points to.  Loads of
different slices can run at the same time; of two loads of one slice the last
wins whole.  Replaced slices are found through the catalog only: read such a
table by its name, not by its path.

Tables whose partitions the catalog does not track have no pointers; they get a
dynamic partition overwrite by path, whose commit is not atomic.

The source is evaluated once: rows are checked and counted as they are written.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from typing import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastertab.session import scratch_path


# --------------------------------------------------------------------------- literals / predicates
def sql_literal(value, dtype: T.DataType | None = None) -> str:
    """SQL literal for a partition value of the given column type."""
    if value is None:
        return "NULL"
    if isinstance(dtype, T.TimestampNTZType):
        return f"TIMESTAMP_NTZ'{_ts_text(value)}'"
    if isinstance(dtype, T.TimestampType):
        return f"TIMESTAMP'{_ts_text(value)}'"
    if isinstance(dtype, T.DateType):
        return f"DATE'{value if isinstance(value, str) else value.isoformat()}'"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)) and not isinstance(dtype, T.StringType):
        return repr(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _ts_text(value) -> str:
    if isinstance(value, str):
        return value.replace("T", " ")
    if isinstance(value, _dt.datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return str(value)


def slice_predicate(slice_values: Mapping[str, object], schema: T.StructType | None = None) -> Column:
    """``k1 = v1 AND k2 = v2 ...`` with typed literals (null-safe equality)."""
    types = {f.name: f.dataType for f in schema.fields} if schema else {}
    pred = F.lit(True)
    for k, v in slice_values.items():
        pred = pred & F.col(k).eqNullSafe(F.expr(sql_literal(v, types.get(k))))
    return pred


# --------------------------------------------------------------------------- catalog objects
def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """SNK-7: create the database if it does not exist (existing is fine)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def table_exists(spark: SparkSession, name: str) -> bool:
    """SNK-8 existence test."""
    return spark.catalog.tableExists(name)


def _ddl(schema: T.StructType) -> str:
    cols = []
    for f in schema.fields:
        comment = f.metadata.get("comment") if f.metadata else None
        c = f"`{f.name}` {f.dataType.simpleString()}"
        if comment:
            c += " COMMENT '" + comment.replace("'", "\\'") + "'"
        cols.append(c)
    return ", ".join(cols)


def create_table(spark: SparkSession, name: str, schema: T.StructType, partition_by=(),
                 location: str | None = None, comment: str | None = None) -> bool:
    """SNK-8/SNK-9: create a partitioned Parquet table if it is missing.
    Returns True when the table was created."""
    if table_exists(spark, name):
        return False
    parts = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    cmt = " COMMENT '" + comment.replace("'", "\\'") + "'" if comment else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema)}) USING parquet{parts}{loc}{cmt}")
    return True


def data_columns(spark: SparkSession, table: str) -> list[str]:
    """Non-partition columns in table order (INSERT is positional)."""
    parts = {c.name for c in spark.catalog.listColumns(table) if c.isPartition}
    return [f.name for f in spark.table(table).schema.fields if f.name not in parts]


# --------------------------------------------------------------------------- layout
def clustered(df: DataFrame, partition_by=(), cluster_by=(), num_partitions: int | None = None) -> DataFrame:
    """SNK-9d: lay rows out for min/max data skipping.

    Range-partition on (partition keys, cluster keys) and sort within tasks:
    the sampled bounds split a large partition value (one cycle, one big
    country) over many tasks by the cluster key, small partition values share
    a task, and each task writes few, tight files.  Without a cluster key a
    deterministic row hash takes its place -- never the partition keys alone,
    which would put a whole cycle into one task.  The number of ranges is the
    shuffle width, which adaptive execution lowers for small slices, unless
    ``num_partitions`` fixes it.
    """
    if not partition_by and not cluster_by:
        return df
    second = [F.col(c) for c in cluster_by] or [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("_h")]
    keys = [*[F.col(c) for c in partition_by], *second]
    out = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    return out.sortWithinPartitions(*partition_by, *cluster_by)


# --------------------------------------------------------------------------- writes
def truncate_load(df: DataFrame, table: str, partition_by=(), cluster_by=(), location: str | None = None,
                  num_partitions: int | None = None, layout: bool = True) -> None:
    """SNK-3: replace the whole table (create if needed).

    ``layout=False`` skips the clustering shuffle -- for staging tables that
    are read once by a job that reshuffles anyway."""
    laid = clustered(df, partition_by, cluster_by, num_partitions) if layout else df
    w = laid.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if location:
        w = w.option("path", location)
    w.saveAsTable(table)


def table_storage(spark: SparkSession, table: str) -> tuple[str, bool]:
    """(location, partitions tracked in the catalog) from ``DESCRIBE TABLE EXTENDED``."""
    info = {row[0]: row[1] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "Location" not in info:
        raise ValueError(f"{table} has no location")
    return info["Location"], info.get("Partition Provider") == "Catalog"


# --------------------------------------------------------------------------- slices by pointer
VERSIONS, SLICE = "_slices", "_slice"


def slice_name(keys) -> Column:
    """Folder name of a slice: a hash of its keys (types and nulls tell apart)."""
    named = F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])
    return F.md5(F.to_json(named, {"ignoreNullFields": "false"}))


def _fresh_folder(location: str) -> str:
    return f"{location.rstrip('/')}/{VERSIONS}/{uuid.uuid4().hex}"


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slice_location(spark: SparkSession, table: str, spec: str) -> str | None:
    """The folder a partition stands in; None when there is no such partition."""
    if not spark.sql(f"SHOW PARTITIONS {table} PARTITION ({spec})").take(1):
        return None
    info = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({spec})").collect()
    return next(r[1] for r in info if r[0] == "Location")  # the partition's stands before the table's


def _partition_spec(values: Mapping[str, object], schema: T.StructType) -> str:
    return ", ".join(f"`{k}` = {sql_literal(v, schema[k].dataType)}" for k, v in values.items())


def point_slices(spark: SparkSession, table: str, folders: Mapping[str, str]) -> None:
    """Make each partition (by its spec) stand in its folder: one catalog call
    for all new ones, one for each that was there, whose old folder then goes."""
    old = {spec: slice_location(spark, table, spec) for spec in folders}
    new = [f"PARTITION ({spec}) LOCATION '{_quoted(folders[spec])}'" for spec, was in old.items() if was is None]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(new)}")
    for spec, was in old.items():
        if was is not None:
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{_quoted(folders[spec])}'")
            _remove(spark, was)


def drop_slice(spark: SparkSession, table: str, spec: str) -> None:
    """Clear a slice: one catalog call, then its folder is removed."""
    old = slice_location(spark, table, spec)
    if old is not None:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
        _remove(spark, old)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


OUTSIDE = "source holds rows outside the slice being replaced"


def replace_partition(spark: SparkSession, src: DataFrame, table: str, slice_values: Mapping[str, object],
                      *, on_foreign_rows: str = "raise", cluster_by=(), sorted_by=()) -> None:
    """Replace exactly one partition (slice) of ``table`` with ``src``.

    ``on_foreign_rows``: what to do with source rows of another slice --
    ``"raise"`` (SNK-4/SNK-5: a cycle or year load must hold only its slice;
    the writing job fails on the first such row, before its commit) or
    ``"ignore"`` (SNK-6 MERGE semantics: they are filtered out).
    ``cluster_by`` lays the rows out by ranges of these columns (SNK-9d);
    ``sorted_by`` sorts within files only, for rows that already are.
    """
    schema = spark.table(table).schema
    cols = data_columns(spark, table)
    missing = [c for c in cols if c not in src.columns]
    if missing:
        raise ValueError(f"source lacks columns {missing} of {table}")
    part_cols = [c for c in schema.fieldNames() if c not in cols]
    if sorted(part_cols) != sorted(slice_values):
        raise ValueError(f"slice keys {sorted(slice_values)} differ from partition columns {part_cols}")
    own = slice_predicate({k: slice_values[k] for k in part_cols if k in src.columns}, schema)
    if on_foreign_rows == "raise":
        own = F.when(own, True).otherwise(F.raise_error(F.lit(f"{OUTSIDE} ({table} {dict(slice_values)})")).cast("boolean"))
    rows = Observation()
    data = src.where(own).select(*[F.col(f"`{c}`").cast(schema[c].dataType).alias(c) for c in cols])
    if cluster_by:
        data = clustered(data, cluster_by=cluster_by)
    elif sorted_by:
        data = data.sortWithinPartitions(*sorted_by)
    data = data.observe(rows, F.count(F.lit(1)).alias("n"))
    location, tracked = table_storage(spark, table)
    spec = _partition_spec({k: slice_values[k] for k in part_cols}, schema)
    folder = _fresh_folder(location)
    try:
        if tracked:
            data.write.parquet(folder)
        else:
            keys = [F.expr(sql_literal(slice_values[k], schema[k].dataType)).cast(schema[k].dataType).alias(k) for k in part_cols]
            _overwrite_present(data.select("*", *keys), location, part_cols)
    except Exception as exc:
        if tracked:
            _remove(spark, folder)
        if OUTSIDE in str(exc):
            raise ValueError(f"{OUTSIDE} ({table} {dict(slice_values)})") from exc
        raise
    if not tracked:
        if not rows.get["n"]:
            clear_partition(spark, table, spec)
    elif rows.get["n"]:
        point_slices(spark, table, {spec: folder})
    else:
        drop_slice(spark, table, spec)
        _remove(spark, folder)
    spark.catalog.refreshTable(table)


def _overwrite_present(data: DataFrame, location: str, part_cols) -> None:
    """Dynamic overwrite of the partitions in ``data``, by path and option (no
    session setting changes, so other writers of the session are not affected)."""
    (data.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*part_cols)
     .format("parquet").save(location))


def clear_partition(spark: SparkSession, table: str, spec: str) -> None:
    """Static overwrite of one partition of an untracked table with no rows."""
    schema = spark.table(table).schema
    view = f"_rt_none_{uuid.uuid4().hex[:10]}"
    spark.createDataFrame([], T.StructType([schema[c] for c in data_columns(spark, table)])).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def replace_partitions(spark: SparkSession, src: DataFrame, table: str, cluster_by=()) -> list[dict]:
    """Replace every partition present in ``src`` by one write job; partitions
    absent from ``src`` are untouched and not listed.  The slices are switched
    one after the other, each whole.  Returns the keys of the replaced slices
    (bounded by the slices touched).  ``cluster_by`` lays the rows out first."""
    schema = spark.table(table).schema
    part_cols = [c for c in schema.fieldNames() if c not in data_columns(spark, table)]
    data = src.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    location, tracked = table_storage(spark, table)
    if tracked:
        data = data.withColumn(SLICE, slice_name(part_cols))
    data = clustered(data, (SLICE,) if tracked else part_cols, cluster_by) if cluster_by else data
    if not tracked:
        _overwrite_present(data, location, part_cols)
        spark.catalog.refreshTable(table)
        return []
    folder, made = _fresh_folder(location), Observation()
    found = F.collect_set(F.struct(SLICE, *[F.col(f"`{k}`") for k in part_cols]))  # one row per slice touched
    try:
        data.observe(made, found.alias("slices")).drop(*part_cols).write.partitionBy(SLICE).parquet(folder)
    except Exception:
        _remove(spark, folder)
        raise
    keys = {row[SLICE]: {k: row[k] for k in part_cols} for row in made.get["slices"]}
    point_slices(spark, table, {_partition_spec(values, schema): f"{folder}/{SLICE}={name}" for name, values in keys.items()})
    spark.catalog.refreshTable(table)
    return list(keys.values())


def replace_listed_slices(spark: SparkSession, src: DataFrame, table: str, slice_col: str, wanted,
                          fixed: Mapping[str, object] | None = None, cluster_by=()) -> list:
    """Replace the slices ``slice_col = w`` (for every ``w`` in ``wanted``, with
    the other partition columns fixed to ``fixed``).

    Source rows outside the listed slices are ignored (MERGE semantics); listed
    slices present in the source are written by one job; listed slices absent
    from the source are cleared.  The source is read once: which slices it
    holds is known from what was written.  Returns the cleared values.
    """
    fixed = dict(fixed or {})
    schema = spark.table(table).schema
    pred = F.col(slice_col).isin(list(wanted))
    if fixed:
        pred = pred & slice_predicate(fixed, schema)
    tracked = table_storage(spark, table)[1]
    existing = [r[0] for r in spark.table(table).where(pred).select(slice_col).distinct().collect()]
    if not tracked:
        present = {r[0] for r in src.where(pred).select(slice_col).distinct().collect()}
        replace_partitions(spark, src.where(pred), table, cluster_by)
    else:
        present = {keys[slice_col] for keys in replace_partitions(spark, src.where(pred), table, cluster_by)}
    cleared = [w for w in wanted if w in existing and w not in present]
    for w in cleared:
        spec = _partition_spec({**fixed, slice_col: w}, schema)
        drop_slice(spark, table, spec) if tracked else clear_partition(spark, table, spec)
    spark.catalog.refreshTable(table)
    return cleared


def replace_slice_logical(dest: DataFrame, src: DataFrame, pred: Column) -> DataFrame:
    """JN-1 / FLT-4 / FLT-5 as a relation: ``MERGE ... ON FALSE`` with slice
    predicates = target rows outside the slice, plus source rows inside it."""
    return dest.where(~pred | pred.isNull()).unionByName(src.where(pred))


def load_slice_from_staging(spark: SparkSession, staging: DataFrame, staging_table: str, table: str,
                            slice_values: Mapping[str, object], transform=None) -> None:
    """Staging truncate-load, then transform + partition replace.

    The staging table cuts the lineage (the source files are read once), and
    replacing from it never reads the table being overwritten.
    """
    truncate_load(staging, staging_table)
    staged = spark.table(staging_table)
    replace_partition(spark, transform(staged) if transform else staged, table, slice_values)


def detached(spark: SparkSession, table: str) -> DataFrame:
    """A copy of a table's rows under the scratch folder, with the table's
    catalog entry dropped: a query that made a table leaves no name behind."""
    rows, parts = spark.table(table), [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    path, writer = scratch_path(spark, "detached"), rows.write
    (writer.partitionBy(*parts) if parts else writer).parquet(path)
    location = table_storage(spark, table)[0]
    spark.sql(f"DROP TABLE {table}")
    _remove(spark, location)
    return spark.read.schema(rows.schema).parquet(path)


# --------------------------------------------------------------------------- names, queries, views
def staging_name(table: str, *parts) -> str:
    """SNK-10: slice-suffixed staging table name (``{table}_{suffix...}``)."""
    return "_".join([table, *[str(p) for p in parts]])


def query_to_table(spark: SparkSession, sql: str, table: str) -> None:
    """SNK-11: run a query into a destination table (replace)."""
    spark.sql(sql).write.mode("overwrite").format("parquet").saveAsTable(table)


def create_or_replace_view(spark: SparkSession, sql: str, name: str, temporary: bool = False) -> None:
    """SNK-12: create or replace a view over a query."""
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {name} AS {sql}")


def temp_table(df: DataFrame, name: str) -> DataFrame:
    """SNK-13: a script-scoped table: a lazy temp view (drop with
    ``spark.catalog.dropTempView``)."""
    df.createOrReplaceTempView(name)
    return df


def write_parquet(df: DataFrame, path: str, partition_by=(), mode: str = "overwrite") -> None:
    """SNK-2: typed Parquet files, optionally one folder per slice."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)

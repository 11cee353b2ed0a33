"""Image catalogs, readiness checks and path-carried slice attributes
(SRC-1a..g, SRC-6..9).

A catalog is a DataFrame ``image_id, collection, start_time, end_time,
country, year, forecast_hours`` (batch table or file-source stream).  The
selections are plain predicates, so they reach the Parquet scan as pushed
filters.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertab.functions.text import basename, strip_extension

def _ts(value) -> Column:
    return F.lit(value).cast("timestamp") if isinstance(value, str) else F.lit(value)


def select_cycle(catalog: DataFrame, date) -> DataFrame:
    """SRC-1a / SRC-1c: images whose start and end are exactly ``date``."""
    d = _ts(date)
    return catalog.where((F.col("start_time") == d) & (F.col("end_time") == d))


def select_country_year(catalog: DataFrame, country: str, year: int) -> DataFrame:
    """SRC-1b: ``country = C and year = Y``."""
    return catalog.where((F.col("country") == F.lit(country)) & (F.col("year") == F.lit(year)))


def select_from_horizon(catalog: DataFrame, date, hours: int) -> DataFrame:
    """SRC-1d: open range plus horizon: ``start >= D and forecast_hours = H``."""
    return catalog.where((F.col("start_time") >= _ts(date)) & (F.col("forecast_hours") == F.lit(hours)))


def select_year(catalog: DataFrame, year: int) -> DataFrame:
    """SRC-1e: one year."""
    return catalog.where(F.col("year") == F.lit(year))


def select_all(catalog: DataFrame) -> DataFrame:
    """SRC-1f: the whole collection."""
    return catalog


def require_nonempty(selection: DataFrame, what: str = "catalog selection") -> DataFrame:
    """SRC-1g: fail when nothing is selected (``isEmpty`` reads one row)."""
    if selection.isEmpty():
        raise ValueError(f"no image found: {what} is empty")
    return selection


# --------------------------------------------------------------------------- readiness / listings
def list_objects(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """Object listing ``path, length, modificationTime`` without reading bytes
    (the binary source skips file contents when they are not selected)."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        return reader.load(path).select("path", "length", "modificationTime")
    except Exception as exc:  # missing folder = nothing there yet
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
        raise


def ready_objects(listing: DataFrame) -> DataFrame:
    """SRC-6 predicate: an object is ready when it exists and is not empty."""
    return listing.where(F.col("length") > 0)


def object_ready(spark: SparkSession, path: str) -> bool:
    """SRC-6 for one object."""
    return not ready_objects(list_objects(spark, path)).isEmpty()


def _hadoop_path(spark: SparkSession, text: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def prefix_ready(spark: SparkSession, prefix: str) -> bool:
    """SRC-7: any object whose path starts with the text of ``prefix`` (a
    folder, or the beginning of a file or folder name).  Looks no further than
    the first object found."""
    path, files = _hadoop_path(spark, prefix + "*")
    for met in files.globStatus(path) or []:
        below = files.listFiles(met.getPath(), True)
        while below.hasNext():
            name = below.next().getPath().getName()
            if not name.startswith(("_", ".")):
                return True
    return False


def existing_folders(spark: SparkSession, folders) -> list[str]:
    """Of the named folders those that exist (one look-up each, no listing)."""
    out = []
    for folder in folders:
        path, files = _hadoop_path(spark, folder)
        if files.exists(path):
            out.append(folder)
    return out


def list_folders(spark: SparkSession, folders, glob: str | None = None) -> DataFrame:
    """Object listing ``path, length, modificationTime`` of exactly these
    folders; those that do not exist hold nothing.  With the folders of a range
    of slices (:func:`forecast_folders`, :func:`population_folders`) the cost
    follows the range, not what else is stored."""
    present = existing_folders(spark, folders)
    if not present:
        return spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    reader = spark.read.format("binaryFile")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(present).select("path", "length", "modificationTime")


def listed_names(listing: DataFrame) -> DataFrame:
    """``name, length`` of listed objects: the file name without folder and
    last extension (``.../NAME.parquet`` -> ``NAME``), which is the image name."""
    return listing.select(strip_extension(basename(F.col("path"))).alias("name"), "length")


def single_wildcard(pattern: str) -> tuple[str, str]:
    """SRC-8: split ``dir/prefix*suffix`` into (folder, glob); more than one
    ``*`` is an error."""
    if pattern.count("*") > 1:
        raise ValueError("only one wildcard is supported")
    folder, _, leaf = pattern.rpartition("/")
    return folder or ".", leaf


# --------------------------------------------------------------------------- path-carried slices (SRC-9)
def forecast_prefix_col(prefix: str, cycle: Column) -> Column:
    return F.concat(F.lit(f"{prefix}/gfs/date="), F.date_format(cycle, "yyyy-MM-dd"), F.lit("/"),
                    F.date_format(cycle, "HH"), F.lit("/parquet/"))


CYCLE_HOURS = 6  # fixed value: forecast cycles start at 00, 06, 12 and 18 UTC


def forecast_folders(prefix: str, first: datetime, last: datetime) -> list[str]:
    """The path template run forward: folders of all cycles from ``first`` to
    ``last``, both included."""
    hours = int((last - first).total_seconds() // 3600)
    cycles = [first + timedelta(hours=h) for h in range(0, hours + 1, CYCLE_HOURS)]
    return [f"{prefix}/gfs/date={c:%Y-%m-%d}/{c:%H}/parquet/" for c in cycles]


def population_folders(prefix: str, years) -> list[str]:
    return [f"{prefix}/world_pop/year={int(y)}/parquet/" for y in years]


def population_file_col(prefix: str, country: Column, year: Column) -> Column:
    y = year.cast("string")
    return F.concat(F.lit(f"{prefix}/world_pop/year="), y, F.lit("/parquet/"), country, F.lit("_"), y,
                    F.lit(".parquet"))


def productivity_file_col(prefix: str, day: Column) -> Column:
    return F.concat(F.lit(f"{prefix}/annual_npp/parquet/"), F.date_format(day, "yyyy_MM_dd"), F.lit(".parquet"))


def local_file_col(data_dir: str, prefix: str, name: Column) -> Column:
    """``$DATA_DIR/$PREFIX/$EXT/$FILE`` with EXT = the file's extension."""
    ext = F.element_at(F.split(name, r"\."), -1)
    return F.concat(F.lit(f"{data_dir}/{prefix}/"), ext, F.lit("/"), name)


def forecast_slice_from_path(path: Column) -> tuple[Column, Column]:
    """(date, hour) carried by a forecast file path (not partition discovery:
    ``date=`` is not the leaf folder)."""
    date = F.to_date(F.regexp_extract(path, r"/date=(\d{4}-\d{2}-\d{2})/", 1))
    hour = F.regexp_extract(path, r"/date=\d{4}-\d{2}-\d{2}/(\d{2})/", 1).cast("int")
    return date, hour


def population_slice_from_path(path: Column) -> tuple[Column, Column]:
    """(country, year) carried by a population file path."""
    m = r"/year=(\d{4})/parquet/([A-Za-z]+)_\d{4}\.parquet$"
    return F.regexp_extract(path, m, 2), F.regexp_extract(path, m, 1).cast("int")


def with_source_path(df: DataFrame) -> DataFrame:
    """File path of every row (``_metadata.file_path``) for path-carried slices."""
    return df.withColumn("source_path", F.col("_metadata.file_path"))

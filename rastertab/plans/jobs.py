"""Slice jobs: the function API a user calls instead of the scheduled tasks.

* :func:`select_images`        -- catalog selection for an export (SRC-1, FLT-1..3)
* :func:`convert_tiles`        -- raster tiles -> pixel Parquet / CSV, or schema text only (SNK-1/2, SCH-2)
* :func:`convert_files`        -- the same from raster files, headers first
* :func:`load_forecast_cycle`  -- staging load + ordered nest + cycle replace (3.1)
* :func:`load_population_slice`-- (country, year) slice replace (3.2)
* :func:`load_population_countries` -- every listed country of a year in one job
* :func:`load_productivity_year` -- reprojected year into its partition (3.3)
* :func:`load_productivity_from_tiles` -- the whole 3.3 flow from sinusoidal tiles
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastertab.functions.timefns import cycle_suffix
from rastertab.operators.attributes import PixelLayout, aligned_bands, infer_layouts, joint_layout
from rastertab.operators.cells import CELL_KEY_COLUMN, with_cell_key
from rastertab.operators.filters import include_exclude, plan_exports, require, require_input
from rastertab.operators.pixels import expand_pixels
from rastertab.operators.reproject import SPHERE_RADIUS, reproject_tiles, suggest_target_grid
from rastertab.plans.forecast import nest_staged
from rastertab.sinks.csv_text import mixed_csv_lines, write_csv_lines
from rastertab.sinks.tables import (OUTSIDE, create_database, create_table, replace_listed_slices, replace_partition,
                                    staging_name, truncate_load, write_parquet)
from rastertab.sources import catalog as cat
from rastertab.sources.schemas import conform, declared, enforce_required, read_declared
from rastertab.sources.tiles import RasterDecoder, image_name, list_rasters, raster_headers, read_raster_files

YEAR_RANGE = (1900, 2100)  # fixed value: integer range partitioning bounds (inclusive start, exclusive end)


# --------------------------------------------------------------------------- export side
def select_images(catalog: DataFrame, task: str, *, date=None, country: str | None = None, year: int | None = None,
                  include: str | None = None, exclude: str | None = None, rasters: DataFrame | None = None,
                  outputs: DataFrame | None = None, overwrite: bool = False) -> DataFrame:
    """Images to export for one task: ``image_id, name, needs_download,
    needs_convert`` (distributed).

    ``rasters`` and ``outputs`` are listings (``path, length``) of what exists;
    a listing that is not given holds nothing.  Only an empty catalog selection
    is an error; a selection whose work is all done gives no rows.
    """
    require(task, "task")
    if task in ("gfs", "annual_npp"):
        sel = cat.select_cycle(catalog, require(date, "date"))
    elif task == "world_pop":
        sel = cat.select_country_year(catalog, require(country, "country"), require(year, "year"))
    else:
        raise ValueError(f"unknown task {task!r}")
    sel = cat.require_nonempty(sel, f"{task} selection")
    sel = sel.withColumn("name", image_name(F.col("image_id")))
    sel = include_exclude(sel, F.col("name"), include, exclude)
    nothing = catalog.sparkSession.createDataFrame([], "path string, length bigint")
    rasters, outputs = (cat.listed_names(nothing if x is None else x) for x in (rasters, outputs))
    return plan_exports(sel, rasters, outputs, overwrite=overwrite)


def convert_tiles(tiles: DataFrame, out_path: str | None = None, fmt: str = "parquet",
                  layout: PixelLayout | None = None, partition_by=(), headers: DataFrame | None = None) -> list[str]:
    """Converter: one row or line per pixel, all images in one pass and one
    write.  Every image is typed by its own metadata and bands; images of
    several layouts share the columns of all (a band with several types gets
    the widest, what an image lacks is null), a CSV line has the fields of its
    own image.  Returns the schema text of each layout; without ``out_path``
    nothing is written.  ``headers`` are the images' headers, where reading the
    tiles for their layouts would decode them (:func:`convert_files`)."""
    layouts = [layout] if layout else infer_layouts(tiles if headers is None else headers)
    if out_path and fmt == "csv":
        write_csv_lines(mixed_csv_lines(tiles, layouts), out_path)
    elif out_path and layouts:
        one = layouts[0] if len(layouts) == 1 else joint_layout(layouts)
        keep = tuple(c for c in partition_by if c in tiles.columns)
        own = tiles if len(layouts) == 1 else aligned_bands(tiles, one)
        write_parquet(expand_pixels(own, one, keep=keep), out_path, partition_by=partition_by)
    return [one.schema_string() for one in layouts]


def convert_files(spark: SparkSession, path: str, decoder: RasterDecoder, out_path: str | None = None, fmt: str = "parquet",
                  glob: str | None = None, partition_by=()) -> list[str]:
    """Converter from raster files: layouts from the headers, pixels decoded once."""
    headers = raster_headers(list_rasters(spark, path, glob), decoder)
    return convert_tiles(read_raster_files(spark, path, decoder, glob), out_path, fmt, partition_by=partition_by, headers=headers)


def _source(spark: SparkSession, source: str | DataFrame, schema) -> DataFrame:
    """Files (a path or one-wildcard pattern, which must exist and not be
    empty) or rows, projected onto the declared schema."""
    if not isinstance(source, str):
        return conform(source, schema)
    require_input(spark, source)
    return read_declared(spark, source, schema)


# --------------------------------------------------------------------------- forecast cycle
def load_forecast_cycle(spark: SparkSession, source: str | DataFrame, table: str, cycle: datetime, *,
                        staging_db: str = "staging", location: str | None = None,
                        staging_location: str | None = None) -> None:
    """Staging truncate-load of the cycle's files, then the cycle partition of
    ``table`` is replaced by the ordered nest of the staging rows (one scan of
    the staging table and one of its sample, one exchange by ranges of the cell
    key, which lays the cycle out on both axes)."""
    require(table, "table")
    require(cycle, "cycle")
    create_database(spark, staging_db)
    stg_name = f"{staging_db}.{staging_name(table.split('.')[-1], cycle_suffix(cycle))}"
    schema = declared("gfs")
    # staging is day-partitioned on creation_time like its warehouse counterpart
    staging = enforce_required(_source(spark, source, schema), schema).withColumn("creation_date", F.to_date("creation_time"))
    truncate_load(staging, stg_name, partition_by=("creation_date",), location=staging_location, layout=False)
    create_table(spark, table, _keyed(declared("gfs_group")), partition_by=("creation_time",), location=location,
                 comment="forecast: one row per cycle and cell")
    staged = spark.table(stg_name).drop("creation_date")
    text = cycle.strftime("%Y-%m-%d %H:%M:%S")
    if not staged.where(F.col("creation_time") != F.lit(text).cast("timestamp")).isEmpty():  # one pushed column
        raise ValueError(f"{OUTSIDE} ({table} {text})")
    replace_partition(spark, nest_staged(staged, laid_out=True), table, {"creation_time": text}, sorted_by=(CELL_KEY_COLUMN,))


# --------------------------------------------------------------------------- population slice
def load_population_slice(spark: SparkSession, source: str | DataFrame, table: str, country: str, year: int, *,
                          location: str | None = None) -> None:
    """Replace the (year, country) slice; source rows of other slices are ignored
    and an empty source slice removes the slice (MERGE ... ON FALSE semantics).
    One code path for every country: large slices are just more tasks."""
    require(table, "table")
    require(country, "country")
    _check_year(year)
    schema = declared("world_pop")
    create_table(spark, table, _keyed(_reorder(schema, ["year", "country"])), partition_by=("year", "country"),
                 location=location)
    replace_partition(spark, with_cell_key(population_rows(spark, source, [country], year)), table,
                      {"year": year, "country": country}, on_foreign_rows="ignore", cluster_by=(CELL_KEY_COLUMN,))


def population_rows(spark: SparkSession, source: str | DataFrame, countries, year: int) -> DataFrame:
    """Source rows of the slices: the slice filter stands on the raw columns, so
    it reaches the scan, and REQUIRED fields are checked on what it keeps."""
    schema = declared("world_pop")
    raw = _source(spark, source, schema).where((F.col("year") == year) & F.col("country").isin(list(countries)))
    return enforce_required(raw, schema)


def load_population_countries(spark: SparkSession, source: str | DataFrame, table: str, year: int,
                              countries, *, location: str | None = None) -> list[str]:
    """Replace the (year, country) slice of every listed country in one job.

    The files of all countries are read together (a big country is just more
    file splits); rows of other years or unlisted countries are ignored; the
    slices present are written by one job; listed countries without any row
    get their slice cleared.  Returns the cleared countries.
    """
    require(table, "table")
    wanted = [c.strip() for c in (countries.split(",") if isinstance(countries, str) else countries) if c.strip()]
    require(wanted, "countries")
    _check_year(year)
    create_table(spark, table, _keyed(_reorder(declared("world_pop"), ["year", "country"])), partition_by=("year", "country"),
                 location=location)
    return replace_listed_slices(spark, with_cell_key(population_rows(spark, source, wanted, year)), table, "country", wanted,
                                 fixed={"year": year}, cluster_by=(CELL_KEY_COLUMN,))


# --------------------------------------------------------------------------- productivity year
def load_productivity_year(spark: SparkSession, source: str | DataFrame, table: str, year: int, *,
                           location: str | None = None) -> None:
    """Replace partition ``year`` (``table$YYYY``); rows of another year fail the load."""
    require(table, "table")
    _check_year(year)
    schema = declared("annual_npp")
    src = enforce_required(_source(spark, source, schema), schema)
    create_table(spark, table, _keyed(_reorder(schema, ["year"])), partition_by=("year",), location=location)
    replace_partition(spark, with_cell_key(src), table, {"year": year}, cluster_by=(CELL_KEY_COLUMN,))


def load_productivity_from_tiles(spark: SparkSession, tiles: DataFrame, table: str, year: int, src_gt,
                                 src_xsize: int, src_ysize: int, target_gt=None, target_xsize: int | None = None,
                                 target_ysize: int | None = None, *, band_names=("Npp", "Npp_QC"), band_type: str = "Int16", radius: float = SPHERE_RADIUS,
                                 block_size: int | None = None, location: str | None = None) -> None:
    """Annual productivity, end to end (3.3): sinusoidal tiles of one year, of
    one or several adjacent images -> year from the image name (RAS-11) ->
    block-wise nearest-pixel reprojection to the WGS84 grid with WKT text
    (RAS-10) -> replace partition ``year`` (SNK-4).

    Band names are matched case-insensitively to the declared columns
    (``Npp`` -> ``npp``).  Tiles of another year fail the load.  Without a
    target grid the one that ``suggest_target_grid`` gives is taken.
    """
    from rastertab.sources.tiles import BLOCK_SIZE, with_year_from_name
    layout = PixelLayout(tuple(band_names), band_type, (("year", "integer"),))
    if target_gt is None:
        target_gt, target_xsize, target_ysize = suggest_target_grid(src_gt, src_xsize, src_ysize, radius)
    out = reproject_tiles(with_year_from_name(tiles), layout, src_gt, src_xsize, src_ysize, target_gt, target_xsize,
                          target_ysize, block_size=block_size or BLOCK_SIZE, radius=radius)
    load_productivity_year(spark, out, table, year, location=location)


def _check_year(year: int) -> None:
    if not (YEAR_RANGE[0] <= int(year) < YEAR_RANGE[1]):
        raise ValueError(f"year {year} outside the partition range {YEAR_RANGE}")


def _keyed(schema: T.StructType) -> T.StructType:
    """A table's schema with the cell key that its files are laid out by, before
    the partition columns."""
    key = T.StructField(CELL_KEY_COLUMN, T.LongType(), True, {"comment": "Morton number of the cell centre, for box queries"})
    return T.StructType([key, *schema.fields])


def _reorder(schema, last):
    fields = [f for f in schema.fields if f.name not in last] + [schema[n] for n in last]
    return T.StructType(fields)

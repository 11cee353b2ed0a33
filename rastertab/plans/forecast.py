"""Forecast cycle plan: tiles -> pixels -> declared staging -> projection -> nest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastertab.operators.attributes import PixelLayout
from rastertab.operators.cells import CELL_KEY_COLUMN, cell_key
from rastertab.functions.numtext import cell_text, negative_zero_mask
from rastertab.functions.timefns import hour_diff, to_datetime
from rastertab.functions.wkt import with_cell_numbers
from rastertab.operators.nest import FORECAST_FIELDS, nest_forecast, ordered_nest, stage_projection
from rastertab.operators.pixels import expand_pixels
from rastertab.sources.schemas import conform, declared

FORECAST_ATTRIBUTES = (("creation_time", "datetime"), ("forecast_hours", "integer"), ("forecast_time", "datetime"))


def forecast_layout(band_names=FORECAST_FIELDS[:8], band_type: str = "Float32") -> PixelLayout:
    return PixelLayout(tuple(band_names), band_type, FORECAST_ATTRIBUTES)


def forecast_staging(tiles: DataFrame, layout: PixelLayout | None = None) -> DataFrame:
    """Pixel rows of forecast tiles conformed to the declared staging schema
    (absent quantities become nulls, unknown columns are dropped)."""
    pixels = expand_pixels(tiles, layout or forecast_layout())
    return conform(pixels, declared("gfs"))


def forecast_nested(tiles: DataFrame, layout: PixelLayout | None = None) -> DataFrame:
    return nest_forecast(stage_projection(forecast_staging(tiles, layout)))


CELL_NUMERIC_KEY = ("gx", "gy", "min_x", "max_x", "min_y", "max_y", "negz")


def forecast_nested_late(tiles: DataFrame, layout: PixelLayout | None = None) -> DataFrame:
    """Same table as :func:`forecast_nested`, formatted late, from tiles."""
    layout = layout or forecast_layout()
    px = expand_pixels(tiles, layout, with_text=False, with_coords=True)
    px = px.withColumn("negz", negative_zero_mask([F.col(c) for c in CELL_NUMERIC_KEY[:6]]))
    return nest_cells(px)


def nest_cells(rows: DataFrame, laid_out: bool = False) -> DataFrame:
    """The grouped forecast table from rows with the numeric cell key.
    ``laid_out``: in ranges of the Morton key of the cell, which is kept as
    ``cell_key`` (SNK-9d).

    The nest groups on the numeric cell key (centre, box edges and a sign mask
    for negative zeros, 52 bytes) instead of the two WKT strings, and the text
    is produced once per cell after the aggregation: the shuffle carries no
    text and the formatting work drops by the number of forecast hours per
    cell.  The WKT text is a function of exactly these numbers, so the grouping
    is the same as long as distinct cells are further apart than the text
    precision (true for every real grid: ``%.10g`` keeps >= 7 decimals below
    1000 degrees).
    """
    staged = rows.select(
        *CELL_NUMERIC_KEY,
        to_datetime(F.col("creation_time")).alias("creation_time"),
        F.coalesce(F.col("forecast_hours").cast("bigint"),
                   hour_diff(F.col("creation_time"), F.col("forecast_time"))).alias("forecast_hours"),
        to_datetime(F.col("forecast_time")).alias("forecast_time"),
        *[(F.col(c).cast("double") if c in rows.columns else F.lit(None).cast("double")).alias(c)
          for c in FORECAST_FIELDS],
    )
    own = [CELL_KEY_COLUMN] if laid_out else []
    if laid_out:
        staged = staged.withColumn(CELL_KEY_COLUMN, cell_key(F.col("gx"), F.col("gy")))
    nested = ordered_nest(staged, ["creation_time", *own, *CELL_NUMERIC_KEY], ["forecast_hours", "forecast_time"],
                          FORECAST_FIELDS, "forecast", renames={"forecast_hours": "hours", "forecast_time": "time"},
                          range_by=CELL_KEY_COLUMN if laid_out else None)
    text = cell_text(*[F.col(c) for c in CELL_NUMERIC_KEY])
    return nested.select("creation_time", text.geography.alias("geography"),
                         text.geography_polygon.alias("geography_polygon"), "forecast", *own)


def nest_staged(staged: DataFrame, laid_out: bool = False) -> DataFrame:
    """The grouped forecast table from staging rows with WKT text: the text is
    read back into the numeric cell key where it is scanned, so that it is not
    shuffled, and written again (in the one normal form, ``%.10g``) per cell.
    A text that is no point or no five-corner cell box is an error."""
    return nest_cells(with_cell_numbers(staged), laid_out)


def nested_summary(nested: DataFrame) -> DataFrame:
    """Flat companion of a nested forecast table: element count, ordered hour
    list and the first/last temperature (checks order without nested values)."""
    f = F.col("forecast")
    return nested.select(
        "creation_time", "geography", "geography_polygon",
        F.size(f).cast("bigint").alias("n_hours"),
        F.array_join(F.transform(f, lambda e: e["hours"].cast("string")), ",", "null").alias("hours_list"),
        f[0]["temperature_2m_above_ground"].alias("first_temperature"),
        F.element_at(f, -1)["temperature_2m_above_ground"].alias("last_temperature"),
        F.element_at(f, -1)["time"].alias("last_time"),
    )

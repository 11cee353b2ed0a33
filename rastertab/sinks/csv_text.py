"""Headerless CSV pixel lines (SNK-1, SCL-4, SCL-10 text form).

Line layout: ``"POINT(x y)","POLYGON ((...))",<attributes>,<bands>`` -- the
two geographies quoted, attributes and band values bare.  A missing value is an empty field, so every line has the same
fields.  Spark's CSV writer
would not quote ``POINT(x y)`` (no separator inside), so lines are built as
text and written with the text sink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastertab.functions.numtext import format_g, format_int
from rastertab.functions.timefns import epoch_millis_to_text
from rastertab.operators.attributes import PixelLayout, band_kind, band_kind_col
from rastertab.operators.pixels import expand_pixels


def _attribute_text(meta_value: Column, kind: str) -> Column:
    if kind == "string":
        return meta_value
    if kind == "datetime":
        return epoch_millis_to_text(meta_value)
    return format_int(meta_value.cast("int"))


def _quoted(c: str) -> Column:
    return F.concat(F.lit('"'), F.col(c), F.lit('"'))


def csv_lines(tiles: DataFrame, layout: PixelLayout, *, keep: tuple[str, ...] = (), with_position: bool = False,
              block_size: int = 256) -> DataFrame:
    """One text line per pixel (plus ``keep`` columns and optionally x, y)."""
    return mixed_csv_lines(tiles, [layout], keep=keep, with_position=with_position, block_size=block_size)


def mixed_csv_lines(tiles: DataFrame, layouts: list[PixelLayout], *, keep: tuple[str, ...] = (), with_position: bool = False,
                    block_size: int = 256) -> DataFrame:
    """Lines of images of several layouts, in one pass: each line has the
    attributes and bands of its own image.  With one layout every line has that
    layout's fields, whatever its image's metadata."""
    single = len(layouts) == 1
    attributes = sorted({a for one in layouts for a in one.attributes}) if not single else layouts[0].attributes
    fields = []
    for k, kind in attributes:
        text = F.array(F.coalesce(_attribute_text(F.col("meta").getItem(k), kind), F.lit("")))
        fields.append(text if single else F.when(F.map_contains_key("meta", k), text).otherwise(F.array().cast("array<string>")))
    most = max(len(one.band_names) for one in layouts)
    integer = {band_kind(one.band_type) == "integer" for one in layouts}
    t = tiles.withColumns({
        "_attrs": F.flatten(F.array(*fields)) if fields else F.array().cast("array<string>"),
        "_own": F.lit(most) if single else F.size("band_names"), "_whole": band_kind_col(F.col("band_type")) == "integer" if len(integer) > 1 else F.lit(True in integer),
        "bands": F.array(*[F.coalesce(F.get("bands", F.lit(i)), F.array().cast("array<double>")) for i in range(most)])
        .cast("array<array<double>>")})
    names = tuple(f"b{i}" for i in range(most))
    px = expand_pixels(t, PixelLayout(names, layouts[0].band_type, (), ("double",) * most), block_size=block_size, with_text=True,
                       with_coords=with_position, box_style="trim", keep=(*keep, "_attrs", "_own", "_whole"), band_prefix="_band_")

    def text(name: str) -> Column:
        value = F.col(f"_band_{name}")
        if integer == {True}:
            return format_int(value)
        return format_g(value) if integer == {False} else F.when(F.col("_whole"), format_int(value)).otherwise(format_g(value))

    bands = F.array(*[F.coalesce(text(n), F.lit("")) for n in names]).cast("array<string>")
    line = F.concat_ws(",", _quoted("geography"), _quoted("geography_polygon"), "_attrs", bands if single else F.slice(bands, F.lit(1), F.col("_own")))
    return px.select(*[F.col(k) for k in keep], *([F.col("x"), F.col("y")] if with_position else []), line.alias("line"))


def write_csv_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the ``line`` column as plain text files (one line per pixel)."""
    lines.select("line").write.mode(mode).text(path)

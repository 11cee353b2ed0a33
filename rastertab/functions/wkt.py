"""WKT text columns (SCL-1, SCL-2, SCL-5, SCL-6).

Geography values are WGS84 WKT strings.  The text of each number comes from
``numtext`` (exact C formatting); here the pieces are only concatenated, which
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NUM = r"-?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"
POINT_PATTERN = rf"^POINT\s*\(\s*({_NUM})\s+({_NUM})\s*\)$"
POLYGON_PATTERN = rf"^POLYGON\s*\(\((?:\s*{_NUM}\s+{_NUM}\s*,)+\s*{_NUM}\s+{_NUM}\s*\)\)$"


def point_text(cx: Column, cy: Column) -> Column:
    """``POINT(x y)`` from already formatted coordinates."""
    return F.concat(F.lit("POINT("), cx, F.lit(" "), cy, F.lit(")"))


def polygon_text(lox: Column, hix: Column, loy: Column, hiy: Column) -> Column:
    """Cell box, five vertices counter-clockwise from the lower right corner:
    ``POLYGON ((maxx miny, maxx maxy, minx maxy, minx miny, maxx miny))``."""
    sp, cm = F.lit(" "), F.lit(", ")
    return F.concat(
        F.lit("POLYGON (("),
        hix, sp, loy, cm,
        hix, sp, hiy, cm,
        lox, sp, hiy, cm,
        lox, sp, loy, cm,
        hix, sp, loy,
        F.lit("))"),
    )


def point_sql(cx: str, cy: str) -> str:
    """SQL-text form of :func:`point_text`."""
    return f"concat('POINT(', {cx}, ' ', {cy}, ')')"


def polygon_sql(lox: str, hix: str, loy: str, hiy: str) -> str:
    """SQL-text form of :func:`polygon_text`."""
    return (f"concat('POLYGON ((', {hix}, ' ', {loy}, ', ', {hix}, ' ', {hiy}, ', ', {lox}, ' ', {hiy}, ', ', "
            f"{lox}, ' ', {loy}, ', ', {hix}, ' ', {loy}, '))')")


def point_lat_lon(geog: Column) -> tuple[Column, Column]:
    """(lat, lon) doubles parsed from ``POINT(x y)`` text -- a numeric cell key
    that clusters (sorts) better than the WKT string."""
    return (F.regexp_extract(geog, POINT_PATTERN, 2).cast("double"),
            F.regexp_extract(geog, POINT_PATTERN, 1).cast("double"))


# A cell box: lower right, upper right, upper left, lower left, lower right.
BOX_PATTERN = (rf"^POLYGON\s*\(\(\s*({_NUM})\s+({_NUM})\s*,\s*\1\s+({_NUM})\s*,\s*({_NUM})\s+\3\s*,"
               rf"\s*\4\s+\2\s*,\s*\1\s+\2\s*\)\)$")


def with_cell_numbers(df: DataFrame, point: str = "geography", polygon: str = "geography_polygon") -> DataFrame:
    """``gx, gy, min_x, max_x, min_y, max_y, negz`` in place of the two texts."""
    texts = {"gx": (point, POINT_PATTERN, 1), "gy": (point, POINT_PATTERN, 2), "min_x": (polygon, BOX_PATTERN, 4),
             "max_x": (polygon, BOX_PATTERN, 1), "min_y": (polygon, BOX_PATTERN, 2), "max_y": (polygon, BOX_PATTERN, 3)}
    df = df.withColumns({f"_t_{n}": F.regexp_extract(F.col(c), pattern, group) for n, (c, pattern, group) in texts.items()})

    def number(name: str) -> Column:
        text = F.col(f"_t_{name}")
        return F.when(text != "", text.cast("double")).otherwise(F.raise_error(F.concat(
            F.lit("invalid WKT geography: "), F.substring(F.coalesce(F.col(texts[name][0]), F.lit("null")), 1, 80))))

    # grouping keys lose the sign of a zero: it rides along as a mask
    signs = [F.when(F.col(f"_t_{n}").startswith("-") & (F.col(f"_t_{n}").cast("double") == 0.0), 1 << i).otherwise(0)
             for i, n in enumerate(texts)]
    mask = signs[0]
    for one in signs[1:]:
        mask = mask + one
    return (df.withColumns({**{n: number(n) for n in texts}, "negz": mask.cast("int")})
            .drop(point, polygon, *[f"_t_{n}" for n in texts]))


def st_astext(geog: Column) -> Column:
    """Geography to WKT: geographies already are WKT strings."""
    return geog


def is_valid_wkt(geog: Column) -> Column:
    """True for the two shapes this engine produces, with WGS84 ranges for points."""
    px = F.regexp_extract(geog, POINT_PATTERN, 1)
    py = F.regexp_extract(geog, POINT_PATTERN, 2)
    point_ok = geog.rlike(POINT_PATTERN) & (F.abs(px.cast("double")) <= 360.0) & (F.abs(py.cast("double")) <= 90.0)
    return point_ok | geog.rlike(POLYGON_PATTERN)


def st_geogfromtext(geog: Column) -> Column:
    """WKT to geography: validates the text (error on invalid, like the warehouse
    function) and returns it unchanged; null stays null."""
    return F.when(geog.isNull() | is_valid_wkt(geog), geog).otherwise(
        F.raise_error(F.concat(F.lit("invalid WKT geography: "), F.substring(geog, 1, 80)))
    )

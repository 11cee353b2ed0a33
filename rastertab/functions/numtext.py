"""Number-to-text rules of the converters (SCL-3, SCL-4, SCL-2b).

C-style ``%.10g`` / ``%g`` round the *exact* binary value of a double; the JVM
formatter rounds its shortest decimal text instead and differs on ties, and it
keeps trailing zeros.  So the text is produced in Python -- but only for the
distinct grid lines of a tile (``xblock + yblock`` values per axis quantity for
a north-up grid), never once per pixel.  Pixel rows get their text by position
on the JVM side (see ``operators.pixels``).  The format-late nest formats once
per cell after its aggregation (:func:`cell_text`).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the converters' output.
CENTRE_FORMAT = "%.10g"      # point coordinates and Parquet polygon vertices
FLOAT_BAND_FORMAT = "%g"     # CSV float band values
INT_BAND_FORMAT = "%d"       # CSV integer band values
LON_LIMIT = 180.0            # box clip, longitude
LAT_LIMIT = 90.0             # box clip, latitude
BOX_DECIMALS = 8             # box vertices rounded to 8 decimals (half-even)


def c_format(values, fmt: str = CENTRE_FORMAT) -> list[str]:
    """C printf text of each double (Python's ``%`` is correctly rounded like C)."""
    return [fmt % v for v in np.asarray(values, dtype=np.float64).tolist()]


def trimmed_text(values) -> list[str]:
    """Shortest round-trip text in positional notation, trailing zeros trimmed
    (``90``, ``-179.75``, ``0.00000001``) -- the CSV polygon vertex style."""
    return [np.format_float_positional(v, trim="-") for v in np.asarray(values, dtype=np.float64)]


def round_half_even(values: np.ndarray, decimals: int = BOX_DECIMALS) -> np.ndarray:
    scale = 10.0 ** decimals
    return np.rint(values * scale) / scale


def clip_keep_nan(values: np.ndarray, limit: float) -> np.ndarray:
    return np.clip(values, -limit, limit)


def _axis_values(gt, ix, iy, xblock, yblock, block_size, row=-1):
    """Centres of one block, or of its pixel row ``row`` (-1: the whole block).

    Returns ``(separable, gx, gy)``: for a north-up grid (gt2 == gt4 == 0) the
    centre x depends only on the column and the centre y only on the row, so
    ``gx`` has ``xblock`` and ``gy`` ``yblock`` values; otherwise both hold one
    value per pixel in row-major order.  The arithmetic order equals the
    per-pixel formula ``gt0 + (x+.5)*gt1 + (y+.5)*gt2`` bit for bit (the zero
    term keeps its sign because ``x+.5`` and ``y+.5`` are positive).
    """
    g0, g1, g2, g3, g4, g5 = (float(v) for v in gt)
    xs = ix * block_size + np.arange(xblock, dtype=np.int64)
    ys = iy * block_size + (np.arange(yblock, dtype=np.int64) if row < 0 else np.array([row], dtype=np.int64))
    if g2 == 0.0 and g4 == 0.0:
        gx = (g0 + (xs + 0.5) * g1) + 0.5 * g2
        gy = (g3 + 0.5 * g4) + (ys + 0.5) * g5
        return True, gx, gy
    mx, my = np.meshgrid(xs, ys)
    gx = (g0 + (mx + 0.5) * g1 + (my + 0.5) * g2).ravel()
    gy = (g3 + (mx + 0.5) * g4 + (my + 0.5) * g5).ravel()
    return False, gx, gy


def box_edges(gx: np.ndarray, gy: np.ndarray, g1: float, g5: float):
    """(min_x, max_x, min_y, max_y): centre +- half a pixel, clipped, rounded."""
    hx, hy = 0.5 * g1, 0.5 * -g5
    return (
        round_half_even(clip_keep_nan(gx - hx, LON_LIMIT)),
        round_half_even(clip_keep_nan(gx + hx, LON_LIMIT)),
        round_half_even(clip_keep_nan(gy - hy, LAT_LIMIT)),
        round_half_even(clip_keep_nan(gy + hy, LAT_LIMIT)),
    )


AXIS_TEXT_SCHEMA = (
    "sep boolean, cx array<string>, lox array<string>, hix array<string>, "
    "cy array<string>, loy array<string>, hiy array<string>"
)


def make_axis_text_udf(block_size: int, box_style: str = "g10"):
    """Tile-level pandas UDF: text of centres and box edges per grid line.

    ``box_style`` is ``"g10"`` (Parquet converter, ``%.10g``) or ``"trim"``
    (CSV converter, shortest trimmed text).  The last argument picks one pixel
    row of the block (-1: all), as the text of rotated grids is made by rows.
    """
    box_text = c_format if box_style == "g10" else trimmed_text

    @F.pandas_udf(AXIS_TEXT_SCHEMA)
    def axis_text(gt: pd.Series, ix: pd.Series, iy: pd.Series, xb: pd.Series, yb: pd.Series, row: pd.Series) -> pd.DataFrame:
        out = {k: [] for k in ("sep", "cx", "lox", "hix", "cy", "loy", "hiy")}
        made: dict = {}  # blocks of a column or row of blocks share their grid lines: formatted once, held once

        def lines(key, centre, low, high):
            if key not in made:
                made[key] = (c_format(centre), box_text(low), box_text(high))
            return made[key]

        for n, (g, i, j, w, h, r) in enumerate(zip(gt, ix, iy, xb, yb, row)):
            sep, gx, gy = _axis_values(g, int(i), int(j), int(w), int(h), block_size, int(r))
            lo_x, hi_x, lo_y, hi_y = box_edges(gx, gy, float(g[1]), float(g[5]))
            out["sep"].append(sep)
            x_key, y_key = (("x", *g, i, w), ("y", *g, j, h)) if sep else (("x", n), ("y", n))
            for names, texts in ((("cx", "lox", "hix"), lines(x_key, gx, lo_x, hi_x)),
                                 (("cy", "loy", "hiy"), lines(y_key, gy, lo_y, hi_y))):
                for name, text in zip(names, texts):
                    out[name].append(text)
        return pd.DataFrame(out)

    return axis_text


@F.pandas_udf(T.StringType())
def _format_g(values: pd.Series) -> pd.Series:
    return pd.Series([FLOAT_BAND_FORMAT % v for v in values.to_numpy(dtype=np.float64).tolist()], dtype="object")


def format_g(col: Column) -> Column:
    """``%g`` of each double (CSV float bands); null stays null, NaN is ``nan``."""
    return F.when(col.isNotNull(), _format_g(col))


def format_int(col: Column) -> Column:
    """``%d`` of an integral column: the JVM integer text is already exact."""
    return col.cast("bigint").cast("string")


CELL_TEXT_SCHEMA = T.StructType([T.StructField("geography", T.StringType()),
                                 T.StructField("geography_polygon", T.StringType())])


def negative_zero_mask(cols) -> Column:
    """Bit i set when value i is -0.0.  Grouping keys normalise -0.0 to 0.0,
    but the text keeps the sign (``-0``), so the sign rides along as a key.
    The sign of a zero is read from its text (Spark's math functions
    normalise -0.0); the cast runs only for values equal to zero."""
    mask = F.lit(0)
    for i, c in enumerate(cols):
        neg = F.when(c == 0.0, c.cast("string").startswith("-")).otherwise(F.lit(False))
        mask = mask + F.when(neg, F.lit(1 << i)).otherwise(F.lit(0))
    return mask.cast("int")


def _restore_negative_zero(values: np.ndarray, mask: np.ndarray, bit: int) -> np.ndarray:
    out = values.astype(np.float64, copy=True)
    flagged = (mask & (1 << bit)) != 0
    out[flagged] = -0.0
    return out


@F.pandas_udf(CELL_TEXT_SCHEMA)
def cell_text(gx: pd.Series, gy: pd.Series, min_x: pd.Series, max_x: pd.Series, min_y: pd.Series,
              max_y: pd.Series, negz: pd.Series) -> pd.DataFrame:
    """WKT point and box of each cell from its numeric centre and (already
    clipped and rounded) box edges -- the format-late path: one call per cell
    after aggregation, instead of one per pixel and hour.  ``negz`` is the
    :func:`negative_zero_mask` of the six values."""
    m = negz.to_numpy().astype(np.int64)
    vals = [_restore_negative_zero(v.to_numpy(), m, i) for i, v in enumerate((gx, gy, min_x, max_x, min_y, max_y))]
    cx, cy = c_format(vals[0]), c_format(vals[1])
    lx, hx = c_format(vals[2]), c_format(vals[3])
    ly, hy = c_format(vals[4]), c_format(vals[5])
    point = [f"POINT({a} {b})" for a, b in zip(cx, cy)]
    poly = [f"POLYGON (({b} {c}, {b} {d}, {a} {d}, {a} {c}, {b} {c}))" for a, b, c, d in zip(lx, hx, ly, hy)]
    return pd.DataFrame({"geography": point, "geography_polygon": poly})

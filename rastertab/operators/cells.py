"""Cell keys: two-axis clustering of geography tables (SNK-9d, SRT-2).

The key of a cell is the Morton number of its centre: longitude and latitude
are cut into 65 536 steps each and their bits interleaved, so cells close in
the key are close on both axes.  Tables are laid out by ranges of the key and
store it, so the smallest and largest key of a file and of a row group bound a
small area, and a box query, written as a few key ranges, skips the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastertab.functions.wkt import POINT_PATTERN

CELL_KEY_COLUMN = "cell_key"
BITS = 16
# Shifts and masks that spread 16 bits over every other of 32.
SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _step(value: Column, low: float, span: float) -> Column:
    steps = 1 << BITS
    place = F.floor((value - F.lit(low)) / F.lit(span) * F.lit(float(steps)))
    # clipped by comparisons: least() would take null and NaN for the last step
    last = F.when(place >= steps, steps - 1).otherwise(place)
    inside = F.when(value <= low, 0).when(value >= low + span, steps - 1).when(value.isNotNull(), last)
    return F.when(~F.isnan(value), inside).cast("long")  # NaN is beyond every bound


def _spread(bits: Column) -> Column:
    for shift, mask in SPREAD:
        bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return bits


def cell_key(lon: Column, lat: Column) -> Column:
    """Morton number (32 bits, long) of a WGS84 place; null without one."""
    return _spread(_step(lon, -180.0, 360.0)).bitwiseOR(F.shiftleft(_spread(_step(lat, -90.0, 180.0)), 1))


def text_place(geography: Column) -> tuple[Column, Column]:
    """(lon, lat) of a ``POINT(x y)`` text; null for any other text."""
    return tuple(F.regexp_extract(geography, POINT_PATTERN, i).try_cast("double") for i in (1, 2))


def with_cell_key(df: DataFrame, geography: str = "geography") -> DataFrame:
    return df.withColumn(CELL_KEY_COLUMN, cell_key(*text_place(F.col(geography))))


def box_ranges(min_lon: float, min_lat: float, max_lon: float, max_lat: float, most: int = 64) -> list[tuple[int, int]]:
    """At most ``most`` ranges of keys that cover a box: quadrants are split
    from the largest down while they reach beyond it, and neighbours joined."""
    def step(value: float, low: float, span: float) -> int:
        return min(max(int((value - low) / span * (1 << BITS)), 0), (1 << BITS) - 1)

    x0, x1, y0, y1 = step(min_lon, -180, 360), step(max_lon, -180, 360), step(min_lat, -90, 180), step(max_lat, -90, 180)
    whole, split = [], [(0, 0, 0, BITS)]  # first key, column, row and level of a quadrant
    while split and len(whole) + len(split) + 3 <= most:
        key, x, y, level = split.pop(0)
        side = 1 << level
        if x > x1 or y > y1 or x + side <= x0 or y + side <= y0:
            continue
        if not level or (x0 <= x and x + side - 1 <= x1 and y0 <= y and y + side - 1 <= y1):
            whole.append((key, key + (1 << 2 * level) - 1))
            continue
        half = side // 2
        split += [(key + (i << 2 * (level - 1)), x + (i & 1) * half, y + (i >> 1) * half, level - 1) for i in range(4)]
    met = [(k, k + (1 << 2 * n) - 1) for k, x, y, n in split
           if not (x > x1 or y > y1 or x + (1 << n) <= x0 or y + (1 << n) <= y0)]
    out: list[tuple[int, int]] = []
    for low, high in sorted(whole + met):
        if out and low == out[-1][1] + 1:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def within_box(df: DataFrame, min_lon: float, min_lat: float, max_lon: float, max_lat: float,
               geography: str = "geography") -> DataFrame:
    """Rows whose centre lies in a box (edges included).  The key ranges reach
    the scan and skip files and row groups; the exact comparison follows."""
    key = F.col(CELL_KEY_COLUMN)
    near = F.lit(False)
    for low, high in box_ranges(min_lon, min_lat, max_lon, max_lat):
        near = near | ((key >= low) & (key <= high))
    lon, lat = text_place(F.col(geography))
    return df.where(near).where((lon >= min_lon) & (lon <= max_lon) & (lat >= min_lat) & (lat <= max_lat))

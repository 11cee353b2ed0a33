"""Tile -> pixel rows (RAS-3 .. RAS-9), the core transform.

Plan shape: tile scan -> (tile-level pandas UDF producing the text of each
grid line) -> ``posexplode(arrays_zip(bands))`` -> native arithmetic, text
lookups by index and ``concat``, fused in one whole-stage-codegen stage.  No
shuffle; Python sees O(xblock + yblock) numbers per block instead of
O(xblock * yblock).  Text of a rotated grid differs from pixel to pixel: such
tiles are cut into single rows of pixels first, so that the text that rides
with band values is that of one row (256 cells), never of a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastertab.functions.numtext import BOX_DECIMALS, LAT_LIMIT, LON_LIMIT, make_axis_text_udf
from rastertab.functions.wkt import point_sql, polygon_sql
from rastertab.operators.attributes import PixelLayout, infer_layout, typed_attribute
from rastertab.sources.tiles import BLOCK_SIZE


def _clip_sql(v: str, limit: float) -> str:
    """numpy ``clip``: NaN stays NaN (Spark's least/greatest would pick a bound)."""
    return f"(CASE WHEN isnan({v}) THEN {v} ELSE greatest(least({v}, {limit!r}D), {-limit!r}D) END)"


def _round_sql(v: str, decimals: int = BOX_DECIMALS) -> str:
    """numpy ``round``: ``rint(v * 10^d) / 10^d`` (half-even on the exact product)."""
    scale = float(10 ** decimals)
    return f"(rint({v} * {scale!r}D) / {scale!r}D)"


def _gt(i: int) -> Column:
    return F.col("_g")[i]


def expand_pixels(
    tiles: DataFrame,
    layout: PixelLayout | None = None,
    *,
    block_size: int = BLOCK_SIZE,
    with_text: bool = True,
    with_coords: bool = False,
    box_style: str = "g10",
    keep: tuple[str, ...] = (),
    band_prefix: str = "",
    num_partitions: int | None = None,
    positions: str | None = None,
) -> DataFrame:
    """One row per pixel: ``keep..., [x, y, gx, gy, min_x, max_x, min_y, max_y],
    [geography, geography_polygon], attributes..., bands...``.

    * every pixel is emitted, fill values and NaN included (RAS-9);
    * attributes are typed per tile, before the explode (RAS-8, SCH-4);
    * bands are cast to the layout's type (SCH-3).

    No shuffle: the file splits of the tiles give the tasks.  A caller whose
    tiles sit in too few splits asks for ``num_partitions``, which moves the
    tiles once.  ``positions`` names an array column with the places of the
    band values in their block, for blocks that hold only some cells.
    """
    layout = layout or infer_layout(tiles)
    nb = len(layout.band_names)

    if num_partitions:
        tiles = tiles.repartition(num_partitions)
    base = tiles.select(
        *[F.col(k) for k in keep],
        F.col("gt").alias("_g"), "ix", "iy", "xblock", "yblock", "bands",
        *([F.col(positions).alias("_at")] if positions else []),
        *[typed_attribute(F.col("meta"), k, kind).alias(k) for k, kind in layout.attributes],
    )
    zipped = [F.col("bands")[i].alias(f"b{i}") for i in range(nb)]
    row0 = "0"
    if with_text:
        axis_text = make_axis_text_udf(block_size, box_style)
        if not positions:  # blocks that hold only some cells are of north-up target grids
            row0 = "greatest(_row, 0)"
            rotated = (_gt(2) != 0.0) | (_gt(4) != 0.0)
            rows = F.when(rotated, F.sequence(F.lit(0), F.col("yblock") - 1)).otherwise(F.array(F.lit(-1)))
            base = base.withColumn("_row", F.explode(rows))
            zipped = [F.when(F.col("_row") < 0, F.col("bands")[i]).otherwise(
                F.slice(F.col("bands")[i], F.col("_row") * F.col("xblock") + 1, F.col("xblock"))).alias(f"b{i}") for i in range(nb)]
        whole = F.lit(-1) if positions else F.col("_row")
        base = base.withColumn("_ax", axis_text(F.col("_g"), F.col("ix"), F.col("iy"), F.col("xblock"), F.col("yblock"), whole))

    scalars = [F.col(k) for k in keep] + [F.col(k) for k, _ in layout.attributes]
    geo_scalars = [F.col("ix"), F.col("iy"), F.col("xblock"), *([F.col("_row")] if row0 != "0" else [])]
    if with_coords:
        geo_scalars += [_gt(i).alias(f"_g{i}") for i in range(6)]
    if with_text:
        # the per-tile text arrays ride along by reference; each pixel picks its
        # entries by index after the explode (no per-pixel arrays are built)
        geo_scalars.append(F.col("_ax"))
    if positions:
        exploded = base.select(*scalars, *geo_scalars, F.explode(F.arrays_zip(F.col("_at").alias("at"), *zipped)).alias("_p"))
        exploded = exploded.select("*", F.col("_p.at").alias("_pos"))
    else:
        exploded = base.select(*scalars, *geo_scalars, F.posexplode(F.arrays_zip(*zipped)).alias("_pos", "_p"))

    # Per-pixel expressions as SQL text: one planner call per column instead of
    # one per operator (the plan is identical; building it is ~10x cheaper).
    out: list[Column] = [F.col(k) for k in keep]
    if with_coords:
        x = f"CAST(ix * {block_size} + _pos % xblock AS BIGINT)"
        y = f"CAST(iy * {block_size} + {row0} + _pos div xblock AS BIGINT)"
        gx = f"(_g0 + ({x} + 0.5D) * _g1 + ({y} + 0.5D) * _g2)"
        gy = f"(_g3 + ({x} + 0.5D) * _g4 + ({y} + 0.5D) * _g5)"
        out += [F.expr(f"{x} AS x"), F.expr(f"{y} AS y"), F.expr(f"{gx} AS gx"), F.expr(f"{gy} AS gy")]
        hx, hy = "(0.5D * _g1)", "(0.5D * (- _g5))"
        out += [
            F.expr(f"{_round_sql(_clip_sql(f'({gx} - {hx})', LON_LIMIT))} AS min_x"),
            F.expr(f"{_round_sql(_clip_sql(f'({gx} + {hx})', LON_LIMIT))} AS max_x"),
            F.expr(f"{_round_sql(_clip_sql(f'({gy} - {hy})', LAT_LIMIT))} AS min_y"),
            F.expr(f"{_round_sql(_clip_sql(f'({gy} + {hy})', LAT_LIMIT))} AS max_y"),
        ]
    if with_text:
        # separable grid: column entry for x texts, row entry for y texts;
        # otherwise one entry per pixel of the row (element_at is 1-based).  Each string is
        # looked up once into its own column, then the WKT is concatenated from
        # column references (keeps the generated code small enough to JIT).
        xi = "CAST(CASE WHEN _ax.sep THEN _pos % xblock ELSE _pos END + 1 AS INT)"
        yi = "CAST(CASE WHEN _ax.sep THEN _pos div xblock ELSE _pos END + 1 AS INT)"
        exploded = exploded.select("*", F.expr(f"{xi} AS _xi"), F.expr(f"{yi} AS _yi"))
        exploded = exploded.select("*", *[F.expr(f"element_at(_ax.{n}, {i}) AS _t_{n}") for n, i in
                                         (("cx", "_xi"), ("lox", "_xi"), ("hix", "_xi"),
                                          ("cy", "_yi"), ("loy", "_yi"), ("hiy", "_yi"))])
        out += [F.expr(f"{point_sql('_t_cx', '_t_cy')} AS geography"),
                F.expr(f"{polygon_sql('_t_lox', '_t_hix', '_t_loy', '_t_hiy')} AS geography_polygon")]
    out += [F.col(k) for k, _ in layout.attributes]
    out += [F.expr(f"CAST(_p.b{i} AS {kind}) AS `{band_prefix}{name}`")
            for i, (name, kind) in enumerate(zip(layout.band_names, layout.band_columns()))]
    return exploded.select(*out)


def pixel_count(tiles: DataFrame) -> Column:
    """Expected number of pixel rows of a tile table: sum(xblock * yblock)."""
    return F.sum(F.col("xblock").cast("long") * F.col("yblock"))

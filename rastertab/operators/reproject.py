"""Sinusoidal grid -> WGS84 grid by nearest pixel (RAS-10), block by block.

For every target cell centre (lon, lat) the forward sinusoidal projection
``x = R * lambda * cos(phi), y = R * phi`` gives a point in the source grid;
``col = floor((x - gt0) / gt1), row = floor((y - gt3) / gt5)`` names the source
pixel that contains it.  Target cells outside the source are dropped.

What moves between tasks are blocks, never pixels, and those once: the target
grid is generated as blocks (``range``, distributed), each names the few source
blocks its cells fall into; the tiles' rectangles alone, without their bands,
are compared for overlaps; source tiles are then joined with both on the block
numbers, and each meeting of a target block with a source tile picks its cells
by array index.  The text of
the cells comes from the target block's own grid lines.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertab.operators.attributes import PixelLayout, typed_attribute
from rastertab.operators.pixels import expand_pixels
from rastertab.sources.tiles import BLOCK_SIZE

SPHERE_RADIUS = 6371007.181  # fixed value: sinusoidal sphere radius in metres
DEG = math.pi / 180.0


def sinusoidal_forward(lon_deg: Column, lat_deg: Column, radius: float = SPHERE_RADIUS) -> tuple[Column, Column]:
    lam = lon_deg * F.lit(DEG)
    phi = lat_deg * F.lit(DEG)
    return F.lit(radius) * lam * F.cos(phi), F.lit(radius) * phi


def sinusoidal_inverse(x: Column, y: Column, radius: float = SPHERE_RADIUS) -> tuple[Column, Column]:
    phi = y / F.lit(radius)
    lam = x / (F.lit(radius) * F.cos(phi))
    return lam / F.lit(DEG), phi / F.lit(DEG)


def suggest_target_grid(src_gt, src_xsize: int, src_ysize: int,
                        radius: float = SPHERE_RADIUS) -> tuple[tuple[float, ...], int, int]:
    """A north-up WGS84 grid ``(gt, xsize, ysize)`` for a sinusoidal source:
    the extent of what the source's row edges cover, projected backwards and
    cut where a parallel ends at +-180 degrees, with square cells of the size
    that gives the extent's diagonal as many cells as the source's has pixels.

    A row edge spans all longitudes between its two ends, so the ends of all
    ``ysize + 1`` edges bound the whole grid."""
    if src_gt[2] != 0 or src_gt[4] != 0:
        raise ValueError("the source grid must be north-up (gt2 = gt4 = 0)")
    phi = (src_gt[3] + np.arange(src_ysize + 1) * src_gt[5]) / radius
    phi = phi[np.abs(phi) <= math.pi / 2 * (1 + 1e-12)]
    ends = np.sort(np.array([src_gt[0], src_gt[0] + src_xsize * src_gt[1]]))
    shrink = np.maximum(radius * np.cos(phi), 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        # at a pole the parallel is one point: it has every longitude that the nearby rows have, and bounds none
        west, east = (np.where(shrink > radius * 1e-9, end / shrink / DEG, np.sign(end) * np.inf) for end in ends)
    met = (west <= 180.0) & (east >= -180.0) & (shrink > radius * 1e-9)
    if not met.any():
        raise ValueError("the source grid lies outside the projection")
    low, high = max(-180.0, float(west[met].min())), min(180.0, float(east[met].max()))
    inside = np.clip(phi / DEG, -90.0, 90.0)
    rows = inside[met | (shrink <= radius * 1e-9)]
    south, north = float(rows.min()), float(rows.max())
    cell = math.hypot(high - low, north - south) / math.hypot(src_xsize, src_ysize)
    xsize, ysize = max(1, int((high - low) / cell + 0.5)), max(1, int((north - south) / cell + 0.5))
    return (low, cell, 0.0, north, 0.0, -cell), xsize, ysize


class Grids:
    """A source grid, a north-up target grid, and the pick between them."""

    def __init__(self, src_gt, src_xsize: int, src_ysize: int, target_gt, target_xsize: int, target_ysize: int,
                 block_size: int, radius: float):
        if target_gt[2] != 0 or target_gt[4] != 0 or src_gt[2] != 0 or src_gt[4] != 0:
            raise ValueError("both grids must be north-up (gt2 = gt4 = 0)")
        self.src_gt, self.src_size = tuple(map(float, src_gt)), (src_xsize, src_ysize)
        self.target_gt, self.target_size = tuple(map(float, target_gt)), (target_xsize, target_ysize)
        self.block_size, self.radius = block_size, radius

    def pick(self, ix: int, iy: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in a target block whose centre lies in the source, and the
        source column and row of each."""
        g, s, b = self.target_gt, self.src_gt, self.block_size
        w = min(self.target_size[0] - ix * b, b)
        h = min(self.target_size[1] - iy * b, b)
        lon = (g[0] + (ix * b + np.arange(w) + 0.5) * g[1])[None, :]
        lat = (g[3] + (iy * b + np.arange(h) + 0.5) * g[5])[:, None]
        x = self.radius * (lon * DEG) * np.cos(lat * DEG)
        y = self.radius * (lat * DEG) + 0.0 * lon
        sx = np.floor((x - s[0]) / s[1]).ravel()
        sy = np.floor((y - s[3]) / s[5]).ravel()
        inside = np.flatnonzero((sx >= 0) & (sx < self.src_size[0]) & (sy >= 0) & (sy < self.src_size[1]))
        return inside, sx[inside].astype(np.int64), sy[inside].astype(np.int64)


def _block_pairs(spark: SparkSession, grids: Grids) -> DataFrame:
    """``ix, iy`` (target block) with each source block ``bx, by`` it touches."""
    nx = -(-grids.target_size[0] // grids.block_size)
    ny = -(-grids.target_size[1] // grids.block_size)

    def touched(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = []
            for block in batch.column(0).to_pylist():
                _, sx, sy = grids.pick(block % nx, block // nx)
                wide = grids.src_size[0] // grids.block_size + 1
                for key in np.unique(sy // grids.block_size * wide + sx // grids.block_size).tolist():
                    rows.append((block % nx, block // nx, key % wide, key // wide))
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["ix", "iy", "bx", "by"])

    tasks = max(1, nx * ny // 16)  # a block is 65 536 cells of arithmetic
    return spark.range(0, nx * ny, numPartitions=tasks).mapInArrow(touched, "ix long, iy long, bx long, by long")


def _blocks_apart(rectangles: DataFrame, keep) -> DataFrame:
    """``bx, by`` of the source blocks that hold tiles; fails when two tiles (of
    one ``keep`` group) cover the same source pixel.  Rectangles only, per
    source block, where few meet."""
    box = F.struct("x0", "y0", (F.col("x0") + F.col("xblock")).alias("x1"), (F.col("y0") + F.col("yblock")).alias("y1"))
    met = rectangles.groupBy(*keep, "bx", "by").agg(F.collect_list(box).alias("boxes"))
    clash = F.exists("boxes", lambda a: F.size(F.filter("boxes", lambda b: (
        (a["x0"] < b["x1"]) & (b["x0"] < a["x1"]) & (a["y0"] < b["y1"]) & (b["y0"] < a["y1"])))) > 1)
    apart = F.when(clash, F.raise_error(F.lit("source images overlap")).cast("boolean")).otherwise(F.lit(True))
    return met.select("bx", "by", apart.alias("apart")).groupBy("bx", "by").agg(F.min("apart").alias("apart")).where("apart").drop("apart")


def reproject_tiles(tiles: DataFrame, layout: PixelLayout, src_gt, src_xsize: int, src_ysize: int, target_gt,
                    target_xsize: int, target_ysize: int, *, keep: tuple[str, ...] = (), with_text: bool = True,
                    block_size: int = BLOCK_SIZE, radius: float = SPHERE_RADIUS) -> DataFrame:
    """Pixel rows ``keep..., tx, ty, lon, lat, [geography, geography_polygon],
    attributes..., bands...`` of the target grid.

    ``tiles`` may come from several images: each tile's place in the source
    grid follows from its own geotransform, images must lie on that grid's
    pixels, and images that overlap (within equal ``keep`` values) are refused.
    """
    grids = Grids(src_gt, src_xsize, src_ysize, target_gt, target_xsize, target_ysize, block_size, radius)
    s = [F.lit(v) for v in grids.src_gt]
    gt = F.col("gt")
    shift_x, shift_y = (gt[0] - s[0]) / s[1], (gt[3] - s[3]) / s[5]
    on_grid = ((F.abs(shift_x - F.round(shift_x)) < 1e-3) & (F.abs(shift_y - F.round(shift_y)) < 1e-3)
               & (F.abs(gt[1] / s[1] - 1) < 1e-9) & (F.abs(gt[5] / s[5] - 1) < 1e-9))
    tiles = tiles.select(
        *keep, *[typed_attribute(F.col("meta"), k, kind).alias(k) for k, kind in layout.attributes], "bands", "xblock", "yblock",
        F.when(on_grid, F.round(shift_x).cast("long") + F.col("ix") * block_size).otherwise(
            F.raise_error(F.lit("a source image does not lie on the source grid"))).alias("x0"),
        (F.round(shift_y).cast("long") + F.col("iy") * block_size).alias("y0"))

    def blocks(first: Column, size: Column) -> Column:
        # floor, not div: an image may begin left of or above the grid
        return F.explode(F.sequence(F.floor(first / block_size), F.floor((first + size - 1) / block_size)))

    tiles = tiles.withColumn("bx", blocks(F.col("x0"), F.col("xblock"))).withColumn("by", blocks(F.col("y0"), F.col("yblock")))
    apart = _blocks_apart(tiles.select(*keep, "x0", "y0", "xblock", "yblock", "bx", "by"), keep)
    wanted = _block_pairs(tiles.sparkSession, grids).join(apart, ["bx", "by"])  # numbers only
    met = tiles.join(wanted, ["bx", "by"])

    names = [*keep, *[k for k, _ in layout.attributes]]
    met = met.select(*names, "ix", "iy", "bx", "by", "x0", "y0", "xblock", "yblock", "bands")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in met.schema.fields if f.name in names)
    schema = f"{fields}{', ' if fields else ''}ix int, iy int, xblock int, yblock int, at array<int>, bands array<array<double>>"

    def choose(batches: Iterator) -> Iterator:
        import pyarrow as pa

        n = len(names)
        for batch in batches:
            for r in range(batch.num_rows):
                ix, iy, bx, by, x0, y0, w, h = (batch.column(n + i)[r].as_py() for i in range(8))
                at, sx, sy = grids.pick(ix, iy)
                own = (sx // block_size == bx) & (sy // block_size == by) & (sx >= x0) & (sx < x0 + w) & (sy >= y0) & (sy < y0 + h)
                at, place = at[own], ((sy - y0) * w + (sx - x0))[own]
                if not len(at):
                    continue
                lists = batch.column(n + 8)[r].values  # one list of pixels per band
                bands = [lists[i].values.take(pa.array(place)) for i in range(len(lists))]
                offsets = pa.array(np.arange(len(bands) + 1) * len(at), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.concat_arrays(bands))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(r, 1) for i in range(n)],
                     *[pa.array([v], pa.int32()) for v in (ix, iy, min(grids.target_size[0] - ix * block_size, block_size),
                                                          min(grids.target_size[1] - iy * block_size, block_size))],
                     pa.array([at], pa.list_(pa.int32())), pa.ListArray.from_arrays(pa.array([0, len(bands)], pa.int32()), lists)],
                    names=[*names, "ix", "iy", "xblock", "yblock", "at", "bands"])

    chosen = met.mapInArrow(choose, schema).withColumns({
        "gt": F.array(*[F.lit(v) for v in grids.target_gt]), "meta": F.create_map().cast("map<string,string>")})
    out = expand_pixels(chosen, PixelLayout(layout.band_names, layout.band_type), block_size=block_size, with_text=with_text,
                        with_coords=True, keep=tuple(names), positions="at")
    text = ["geography", "geography_polygon"] if with_text else []
    return out.select(*keep, F.col("x").alias("tx"), F.col("y").alias("ty"), F.col("gx").alias("lon"), F.col("gy").alias("lat"),
                      *text, *[k for k, _ in layout.attributes], *[F.col(f"`{b}`") for b in layout.band_names])

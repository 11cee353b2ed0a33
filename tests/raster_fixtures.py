"""Tile tables from small in-memory images; the blocks come from the operator
under test's own block plan (``image_blocks``), the pixels by slicing."""
import numpy as np

from rastertab.sources.tiles import BLOCK_SIZE, TILE_SCHEMA, image_blocks

NAMES = [f.split()[0] for f in TILE_SCHEMA.split(", ")]


def tiles_from_arrays(spark, images, block_size=BLOCK_SIZE):
    arrays = {im["image_id"]: np.atleast_3d(np.asarray(im["data"], float)) if np.ndim(im["data"]) == 3 else
              np.asarray(im["data"], float)[np.newaxis] for im in images}
    header = "image_id string, xsize int, ysize int, gt array<double>, band_names array<string>, band_type string, meta map<string,string>"
    heads = spark.createDataFrame(
        [(im["image_id"], arrays[im["image_id"]].shape[2], arrays[im["image_id"]].shape[1], [float(g) for g in im["gt"]],
          list(im["band_names"]), im.get("band_type", "Float64"), dict(im.get("meta", {}))) for im in images], header)
    rows = []
    for r in image_blocks(heads, block_size).collect():
        x, y = r.ix * block_size, r.iy * block_size
        block = arrays[r.image_id][:, y:y + r.yblock, x:x + r.xblock]
        rows.append({**r.asDict(), "bands": [b.ravel().tolist() for b in block]})
    return spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], TILE_SCHEMA)

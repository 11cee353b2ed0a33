"""Tile tables: the re-aimed raster input (SRC-2, RAS-1, RAS-2, RAS-11, RAS-12).

A tile row is one block of at most ``block_size`` x ``block_size`` pixels of one
image, with all bands (``bands[b]`` row-major over the block).  Tiles are the
unit of parallelism: a task never holds more than a block per row.
"""

from __future__ import annotations

import json
from typing import Callable, Iterator, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertab.sources.files import open_input

BLOCK_SIZE = 256  # fixed value: converter block edge in pixels

TILE_SCHEMA = (
    "image_id string, xsize int, ysize int, gt array<double>, band_names array<string>, "
    "band_type string, meta map<string,string>, ix int, iy int, xblock int, yblock int, "
    "bands array<array<double>>"
)
IMAGE_SCHEMA = (
    "image_id string, path string, xsize int, ysize int, gt array<double>, band_names array<string>, "
    "band_type string, meta map<string,string>"
)


# --------------------------------------------------------------------------- blocks
def block_count(size: Column, block_size: int = BLOCK_SIZE) -> Column:
    """Number of non-empty blocks along one axis (ceil)."""
    return F.ceil(size / F.lit(block_size)).cast("int")


def _index_range(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def image_blocks(images: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """RAS-1/RAS-2: one row per non-empty block of each image.

    Adds ``ix, iy, xblock, yblock``; edge blocks are smaller.  ``ceil`` yields
    exactly the non-empty blocks, so the converter's skip of empty blocks is
    implicit.  Pure column arithmetic + explode: no shuffle.
    """
    bs = F.lit(block_size)
    return (
        images.withColumn("ix", F.explode(_index_range(block_count(F.col("xsize"), block_size))))
        .withColumn("iy", F.explode(_index_range(block_count(F.col("ysize"), block_size))))
        .withColumn("xblock", F.least(F.col("xsize") - F.col("ix") * bs, bs).cast("int"))
        .withColumn("yblock", F.least(F.col("ysize") - F.col("iy") * bs, bs).cast("int"))
    )


# --------------------------------------------------------------------------- tile tables on storage
def write_tiles(tiles: DataFrame, path: str, partition_by=("image_id",), mode: str = "overwrite") -> None:
    """Persist a tile table as Parquet (one folder per image by default, so a
    later read of some images prunes the rest).  Tiles are ranged by image and
    block first: an image lies in few files, a large one in several tasks."""
    tiles = tiles.select(*[f.split()[0] for f in TILE_SCHEMA.split(", ")]).repartitionByRange("image_id", "iy", "ix")
    w = tiles.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    """Read a tile table with the declared tile schema (no inference)."""
    return spark.read.schema(TILE_SCHEMA).parquet(path)


# --------------------------------------------------------------------------- file decoders
class RasterDecoder(Protocol):
    """Caller-supplied codec.  It opens files through ``open_file(path)`` only
    (a seekable binary file on shared storage).  ``describe`` returns the image
    header (xsize, ysize, gt, band_names, band_type, meta); ``read_block``
    returns a ``bands x h x w`` array for one window, in the file's own type if
    it likes, and reads no more than the window's bytes where the format allows.
    A window may be a strip: several neighbouring blocks of one row of blocks."""

    def describe(self, path: str, open_file: Callable) -> dict: ...

    def read_block(self, path: str, open_file: Callable, x0: int, y0: int, w: int, h: int) -> np.ndarray: ...


class NpyRasterDecoder:
    """Raster stored as ``name.npy`` (bands x ysize x xsize, row-major) with a
    ``name.json`` header sidecar.  A window of whole rows is one read per band;
    a narrower one reads its part of each row."""

    @staticmethod
    def _layout(fh) -> tuple[tuple[int, int, int], np.dtype, int]:
        version = np.lib.format.read_magic(fh)
        read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
        shape, fortran, dtype = read(fh)
        if fortran:
            raise ValueError("the array must be stored row-major")
        return (shape if len(shape) == 3 else (1, *shape)), dtype, fh.tell()

    def describe(self, path: str, open_file: Callable) -> dict:
        with open_file(path) as fh:
            (nb, ysize, xsize), _, _ = self._layout(fh)
        with open_file(path[:-4] + ".json") as fh:
            head = json.loads(fh.read())
        return {"xsize": xsize, "ysize": ysize, "gt": head["gt"],
                "band_names": head.get("band_names") or [f"band_{i + 1}" for i in range(nb)],
                "band_type": head.get("band_type", "Float64"), "meta": head.get("meta", {})}

    def read_block(self, path: str, open_file: Callable, x0: int, y0: int, w: int, h: int) -> np.ndarray:
        with open_file(path) as fh:
            (nb, ysize, xsize), dtype, start = self._layout(fh)
            out, item = np.empty((nb, h, w), dtype), dtype.itemsize
            for band in range(nb):
                begin = start + ((band * ysize + y0) * xsize + x0) * item
                if w == xsize:
                    fh.seek(begin)
                    out[band] = np.frombuffer(fh.read(h * w * item), dtype).reshape(h, w)
                    continue
                for row in range(h):
                    fh.seek(begin + row * xsize * item)
                    out[band, row] = np.frombuffer(fh.read(w * item), dtype)
        return out


# --------------------------------------------------------------------------- files -> tiles
def list_rasters(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``path, length`` of raster files (``binaryFile`` without its content
    column: no bytes read); a file without bytes is an error."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    listed = reader.load(path)
    # Spark's scan passes over files without bytes, its file index does not; the
    # index's names stay in the JVM, only their number is asked for
    empty = len(listed._jdf.inputFiles()) - listed.count()
    if empty:
        raise ValueError(f"{empty} raster file(s) under {path} are empty")
    return listed.select("path", "length")


def raster_headers(files: DataFrame, decoder: RasterDecoder, open_file: Callable = open_input) -> DataFrame:
    """One row per raster file: its header (``IMAGE_SCHEMA``), no pixels read."""
    def headers(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pd.DataFrame([{"image_id": image_name_py(p), "path": p, **decoder.describe(p, open_file)} for p in pdf["path"]],
                               columns=[f.split()[0] for f in IMAGE_SCHEMA.split(", ")])

    return files.select("path").mapInPandas(headers, IMAGE_SCHEMA)


def _strips(blocks: pd.DataFrame, block_size: int, strip_bytes: int) -> Iterator[pd.DataFrame]:
    """Runs of neighbouring blocks of one row of blocks of one file, as long as
    their values (eight bytes each) stay below ``strip_bytes``; one block at least."""
    run, size = [], 0
    last = None
    for r in blocks.itertuples():
        own = 8 * int(r.xblock) * int(r.yblock) * len(r.band_names)
        if run and ((r.path, r.iy, r.ix) != (last.path, last.iy, last.ix + 1) or size + own > strip_bytes):
            yield blocks.loc[run]
            run, size = [], 0
        run.append(r.Index)
        size, last = size + own, r
    if run:
        yield blocks.loc[run]


def read_raster_files(spark: SparkSession, path: str, decoder: RasterDecoder, glob: str | None = None,
                      block_size: int = BLOCK_SIZE, strip_bytes: int = 128 * 1024 * 1024,
                      bytes_per_task: int = 64 * 1024 * 1024, open_file: Callable = open_input) -> DataFrame:
    """SRC-2: tile table from raster files.

    1. list files, without reading them;
    2. read only the headers;
    3. expand to blocks (RAS-1) and range-partition them in file / row-major
       order -- as many tasks as the files' total size needs at
       ``bytes_per_task`` (one small aggregate over the listing);
    4. each task reads the neighbouring blocks of a row of blocks as one strip
       (``strip_bytes`` of values at most) and cuts them out of it, so a file's
       bytes are read once, in few reads, whatever its width.
    """
    files = list_rasters(spark, path, glob)
    total = files.agg(F.sum("length")).first()[0] or 0
    images = raster_headers(files, decoder, open_file)
    blocks = image_blocks(images, block_size)
    # range, not hash: a task gets a contiguous run of one file's blocks
    blocks = (blocks.repartitionByRange(max(1, -(-int(total) // bytes_per_task)), "path", "iy", "ix")
              .sortWithinPartitions("path", "iy", "ix"))

    def read(it):
        import pyarrow as pa

        for batch in it:
            for run in _strips(batch.to_pandas(), block_size, strip_bytes):
                head = run.iloc[0]
                left = int(head.ix) * block_size
                strip = decoder.read_block(head.path, open_file, left, int(head.iy) * block_size, int(run["xblock"].sum()), int(head.yblock))
                # a window of blocks at a time: what is sent on is a part of the strip in double precision
                for at in range(0, len(run), 16):
                    part = run.iloc[at:at + 16]
                    yield _blocks_to_arrow(pa, part, [
                        strip[:, :, int(r.ix) * block_size - left:int(r.ix) * block_size - left + int(r.xblock)] for r in part.itertuples()])

    return blocks.mapInArrow(read, TILE_SCHEMA)


def _blocks_to_arrow(pa, part: pd.DataFrame, arrays: list[np.ndarray]):
    """Arrow batch of tile rows with ``bands`` built from the numpy buffers
    (offsets + one flat values buffer): no Python object per pixel."""
    flat, inner, outer = [], [0], [0]
    for arr in arrays:
        arr = np.asarray(arr, dtype=np.float64)
        arr = arr.reshape(arr.shape[0] if arr.ndim == 3 else 1, -1)
        for band in arr:
            flat.append(band)
            inner.append(inner[-1] + band.size)
        outer.append(outer[-1] + arr.shape[0])
    values = pa.array(np.concatenate(flat) if flat else np.zeros(0), type=pa.float64())
    inner_arr = pa.ListArray.from_arrays(pa.array(inner, type=pa.int32()), values)
    bands = pa.ListArray.from_arrays(pa.array(outer, type=pa.int32()), inner_arr)
    cols = {
        "image_id": pa.array(part["image_id"].tolist(), type=pa.string()),
        "xsize": pa.array(part["xsize"].astype("int32").tolist(), type=pa.int32()),
        "ysize": pa.array(part["ysize"].astype("int32").tolist(), type=pa.int32()),
        "gt": pa.array([list(map(float, g)) for g in part["gt"]], type=pa.list_(pa.float64())),
        "band_names": pa.array([list(b) for b in part["band_names"]], type=pa.list_(pa.string())),
        "band_type": pa.array(part["band_type"].tolist(), type=pa.string()),
        "meta": pa.array([list(m) if not isinstance(m, dict) else list(m.items()) for m in part["meta"]],
                         type=pa.map_(pa.string(), pa.string())),
        "ix": pa.array(part["ix"].astype("int32").tolist(), type=pa.int32()),
        "iy": pa.array(part["iy"].astype("int32").tolist(), type=pa.int32()),
        "xblock": pa.array(part["xblock"].astype("int32").tolist(), type=pa.int32()),
        "yblock": pa.array(part["yblock"].astype("int32").tolist(), type=pa.int32()),
        "bands": bands,
    }
    return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


# --------------------------------------------------------------------------- names
def image_name(image_id: Column) -> Column:
    """RAS-12: ``basename`` of a path-like image id."""
    return F.element_at(F.split(image_id, "/"), -1)


def image_name_py(path: str) -> str:
    base = path.rstrip("/").rsplit("/", 1)[-1]
    return base.rsplit(".", 1)[0] if "." in base else base


def with_year_from_name(tiles: DataFrame, name_col: str = "image_id") -> DataFrame:
    """RAS-11: ``year`` = first ``_`` field of the image name, added to the metadata."""
    year = F.split(image_name(F.col(name_col)), "_").getItem(0)
    return tiles.withColumn("meta", F.map_concat(
        F.map_filter("meta", lambda k, v: k != F.lit("year")), F.create_map(F.lit("year"), year)))

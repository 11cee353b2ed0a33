import json

import numpy as np

from rastertab.operators.attributes import PixelLayout
from rastertab.operators.pixels import expand_pixels
from rastertab.sources.tiles import NpyRasterDecoder, read_raster_files
from raster_fixtures import tiles_from_arrays


def test_file_decoder_equals_in_memory(spark, tmp_dir):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(2, 300, 270))
    gt = [10.0, 0.01, 0.0, 50.0, 0.0, -0.01]
    np.save(f"{tmp_dir}/2001_01_01.npy", data)
    with open(f"{tmp_dir}/2001_01_01.json", "w") as fh:
        json.dump({"gt": gt, "band_names": ["a", "b"], "band_type": "Float32", "meta": {"year": "2001"}}, fh)
    tiles = read_raster_files(spark, tmp_dir, NpyRasterDecoder(), glob="*.npy")
    assert tiles.count() == 4
    layout = PixelLayout(("a", "b"), "Float32", (("year", "integer"),))
    got = sorted(tuple(r) for r in expand_pixels(tiles, layout).collect())
    mem = tiles_from_arrays(spark, [{"image_id": "2001_01_01", "data": data, "gt": gt, "band_names": ["a", "b"],
                                     "band_type": "Float32", "meta": {"year": "2001"}}])
    want = sorted(tuple(r) for r in expand_pixels(mem, layout).collect())
    assert len(got) == 300 * 270 and got == want


def test_tile_table_round_trip(spark, tmp_dir):
    from rastertab.sources.tiles import read_tiles, write_tiles
    tiles = tiles_from_arrays(spark, [{"image_id": f"i{k}", "data": np.full((2, 3, 300), float(k)),
                                       "gt": [0.0, 1.0, 0.0, 0.0, 0.0, -1.0], "band_names": ["a", "b"]}
                                      for k in range(3)])
    write_tiles(tiles, f"{tmp_dir}/tiles")
    back = read_tiles(spark, f"{tmp_dir}/tiles")
    assert sorted(map(str, back.collect())) == sorted(map(str, tiles.select(*back.columns).collect()))
    assert "PartitionFilters: [isnotnull(image_id" in back.where("image_id = 'i1'")._jdf.queryExecution() \
        .executedPlan().toString()


def test_empty_raster_fails_the_job(spark, tmp_dir):
    import pytest
    np.save(f"{tmp_dir}/a.npy", np.ones((1, 2, 2)))
    with open(f"{tmp_dir}/a.json", "w") as fh:
        json.dump({"gt": [0, 1, 0, 0, 0, -1]}, fh)
    open(f"{tmp_dir}/b.npy", "wb").close()
    with pytest.raises(Exception, match="1 raster file.* empty"):
        read_raster_files(spark, tmp_dir, NpyRasterDecoder(), glob="*.npy").collect()


def test_decoder_reads_through_the_given_opener(spark, tmp_dir):
    from rastertab.sources.files import open_input
    np.save(f"{tmp_dir}/hidden.npy", np.arange(12.0).reshape(1, 3, 4))
    with open(f"{tmp_dir}/hidden.json", "w") as fh:
        json.dump({"gt": [0, 1, 0, 0, 0, -1]}, fh)
    open(f"{tmp_dir}/seen.raster", "wb").write(b"x")

    def opener(path):
        return open_input(path.replace("seen.raster", "hidden.npy").replace("seen.ra.json", "hidden.json").replace("seen.ras.json", "hidden.json")
                          .replace("seen.rast.json", "hidden.json"))

    tiles = read_raster_files(spark, tmp_dir, NpyRasterDecoder(), glob="*.raster", open_file=opener).collect()
    assert [t.bands[0] for t in tiles] == [[float(i) for i in range(12)]]


def counted_reads(spark, tmp_dir, shape, **options):
    from rastertab.sources.files import open_input

    class CountedFile:
        """A file that writes down how many bytes of values were read from it."""

        def __init__(self, fh, log):
            self.fh, self.log = fh, log

        def __enter__(self):
            return self

        def __exit__(self, *exc):
            self.fh.close()

        def read(self, n=-1):
            out = self.fh.read(n)
            with open(self.log, "a") as log:
                log.write(f"{len(out)}\n")
            return out

        def seek(self, at):
            return self.fh.seek(at)

        def tell(self):
            return self.fh.tell()

    data = np.arange(np.prod(shape), dtype=np.int32).reshape(shape)
    np.save(f"{tmp_dir}/wide.npy", data)
    with open(f"{tmp_dir}/wide.json", "w") as fh:
        json.dump({"gt": [0, 1, 0, 0, 0, -1], "band_type": "Int32"}, fh)
    log = f"{tmp_dir}/reads.txt"

    def opener(path):
        return CountedFile(open_input(path), log) if path.endswith(".npy") else open_input(path)

    tiles = read_raster_files(spark, tmp_dir, NpyRasterDecoder(), glob="*.npy", open_file=opener, **options)
    rows = tiles.select("ix", "iy", "xblock", "yblock", "bands").collect()
    for r in rows:
        want = data[:, r.iy * 256:r.iy * 256 + r.yblock, r.ix * 256:r.ix * 256 + r.xblock]
        assert [list(b) for b in r.bands] == want.reshape(len(want), -1).tolist()
    with open(log) as fh:
        reads = [int(n) for n in fh]
    return sum(reads), len(reads), data.nbytes, len(rows)


def test_a_wide_file_is_read_once(spark, tmp_dir):
    """2048 columns are eight blocks: a strip of them is one read per band."""
    read, calls, size, blocks = counted_reads(spark, tmp_dir, (2, 600, 2048))
    assert blocks == 24 and read <= 1.1 * size
    assert calls < 3 * (2 + 10) + 20  # three strips of two bands, and headers


def test_strips_are_bounded_and_read_no_more(spark, tmp_dir):
    """Strips of two blocks: each row's part is read on its own, nothing twice."""
    read, calls, size, _ = counted_reads(spark, tmp_dir, (1, 300, 1000), strip_bytes=2 * 256 * 256 * 8)
    assert read <= 1.1 * size and calls > 500


def test_tasks_cut_a_file_between_blocks(spark, tmp_dir):
    read, _, size, blocks = counted_reads(spark, tmp_dir, (1, 700, 1500), bytes_per_task=300_000)
    assert blocks == 18 and read <= 1.1 * size

"""Token-id files: independent zstandard frames, a document index and a
trailing seek table with a checksum per frame.

Layout (all integers little-endian):

* frames: zstandard frames with content size and checksum; their contents,
  one after the other, are the ids (unsigned 32 bit) of the file's documents;
* document index, a skippable frame (0x184D2A50): ``n`` (u64), then ``n``
  doc ids (i64), ``n`` token counts (u64), ``n`` flags (u8, 1 = id is null),
  then the crc32 (u32) of all that;
* seek table, a skippable frame (0x184D2A5E) as in the public seekable format:
  per frame compressed size, content size, low half of the content's XXH64
  (u32 each), then the number of frames (u32), a flag byte 0x80, 0x8F92EAB1.

Documents are ranged by id, so files follow each other in ascending id order;
each task streams its range into one file under a name of its own attempt and
then moves it to its place, so a task that runs again leaves the same file.

Defined results: null and empty texts hold the end id alone; rows without id
come first; rows with equal ids are ordered by a hash of the text; an empty
table gives no documents.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rastertab.llm.common import read, shuffle_width, written
from rastertab.llm.tokens import default_tokenizer, forget_encoders, worker_encoder
from rastertab.session import scratch_path

INDEX_MAGIC, TABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1  # fixed values of the format
_FOOTER, _FOOTER_SIZE = "<IBI", 9


def _store(uri: str):
    """File system and path of a uri, by Arrow (local, hdfs, object stores)."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


class TokenFileWriter:
    """Streams documents into one file; holds one frame at a time."""

    def __init__(self, out, frame_bytes: int, level: int):
        import zstandard

        self._out, self._frame_bytes = out, frame_bytes
        self._pack = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self._held, self._size, self._table, self._docs = [], 0, [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._docs.append((doc_id, len(ids) // 4))
        for i in range(0, len(ids), self._frame_bytes):
            part = ids[i:i + self._frame_bytes]
            if self._size and self._size + len(part) > self._frame_bytes:
                self._close_frame()
            self._held.append(part)
            self._size += len(part)

    def _close_frame(self) -> None:
        import xxhash

        content = b"".join(self._held)
        frame = self._pack.compress(content)
        self._out.write(frame)
        self._table.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self._held, self._size = [], 0

    def close(self) -> None:
        if self._size:
            self._close_frame()
        index = struct.pack("<Q", len(self._docs)) + np.array([d or 0 for d, _ in self._docs], "<i8").tobytes() + \
            np.array([n for _, n in self._docs], "<u8").tobytes() + bytes(d is None for d, _ in self._docs)
        index += struct.pack("<I", zlib.crc32(index))
        self._out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = np.array(self._table, "<u4").tobytes() + struct.pack(_FOOTER, len(self._table), 0x80, SEEKABLE_MAGIC)
        self._out.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)


class TokenFileReader:
    """Opens a file at its end; decompresses only the frames that hold the
    documents asked for, and checks each frame's checksum."""

    def __init__(self, source):
        self._in, size = source, source.size()
        n, _, magic = struct.unpack(_FOOTER, self._at(size - _FOOTER_SIZE, _FOOTER_SIZE))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("not a token file: no seek table at its end")
        table_at = size - _FOOTER_SIZE - 12 * n
        table = np.frombuffer(self._at(table_at, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self._sums = table[:, 2]
        self._frame_at = np.concatenate([[0], np.cumsum(table[:, 0])])
        self._content_at = np.concatenate([[0], np.cumsum(table[:, 1])])
        magic, length = struct.unpack("<II", self._at(int(self._frame_at[-1]), 8))
        index = self._at(int(self._frame_at[-1]) + 8, length)
        if magic != INDEX_MAGIC or zlib.crc32(index[:-4]) != struct.unpack("<I", index[-4:])[0]:
            raise ValueError("damaged document index")
        n_docs = struct.unpack("<Q", index[:8])[0]
        self.doc_ids = np.frombuffer(index, "<i8", n_docs, 8)
        self.n_tokens = np.frombuffer(index, "<u8", n_docs, 8 + 8 * n_docs).astype(np.int64)
        self.no_id = np.frombuffer(index, "u1", n_docs, 8 + 16 * n_docs).astype(bool)
        self.starts = np.concatenate([[0], np.cumsum(self.n_tokens)]).astype(np.int64)
        self._last = (-1, b"")

    def _at(self, offset: int, length: int) -> bytes:
        self._in.seek(offset)
        return self._in.read(length)

    def frame(self, i: int) -> bytes:
        import xxhash
        import zstandard

        if self._last[0] != i:
            content = zstandard.ZstdDecompressor().decompress(
                self._at(int(self._frame_at[i]), int(self._frame_at[i + 1] - self._frame_at[i])))
            if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self._sums[i]:
                raise ValueError(f"frame {i} is damaged")
            self._last = (i, content)
        return self._last[1]

    def ids(self, position: int) -> Iterator[bytes]:
        """The ids of the document at this place of the index, part by part."""
        lo, hi = 4 * int(self.starts[position]), 4 * int(self.starts[position + 1])
        i = int(np.searchsorted(self._content_at, lo, side="right")) - 1
        while lo < hi:
            base = int(self._content_at[i])
            part = self.frame(i)[lo - base:hi - base]
            yield part
            lo, i = lo + len(part), i + 1


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 2,
                      frame_bytes: int = 1 << 20, level: int = 1) -> DataFrame:
    """Write ``doc_id, text`` as token files under ``folder``; returns the list
    of files: ``part, file, n_docs, n_tokens``, written beside them."""
    tokenizer = tokenizer or default_tokenizer()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part, encoder, end = context.partitionId(), worker_encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        store, root = _store(folder)
        name, draft = f"part-{part:06d}.tokens", f"{root}/.draft-{part:06d}-{context.taskAttemptId()}"
        writer = out = None
        n_docs = n_tokens = 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                if writer is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(draft)
                    writer = TokenFileWriter(out, frame_bytes, level)
                ids = encoder.ids(text.as_py()) + end
                writer.add(doc_id, ids)
                n_docs, n_tokens = n_docs + 1, n_tokens + len(ids) // 4
        if writer is not None:
            writer.close()
            out.close()
            store.move(draft, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([n_docs], pa.int64()),
                 pa.array([n_tokens], pa.int64())], names=["part", "file", "n_docs", "n_tokens"])

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]  # the hash splits an id with very many rows
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .repartitionByRange(shuffle_width(docs.sparkSession), *order).sortWithinPartitions(*order))
    return written(ordered.mapInArrow(write, "part int, file string, n_docs long, n_tokens long"), "token-files-list")


def read_token_files(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files;
    ``start`` counts the ids of all documents before it."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    listed = (files.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))
              .select("file", "before").repartition(shuffle_width(files.sparkSession)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()  # that the writing tasks left in this worker process
        for b in batches:
            for file, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                store, path = _store(file)
                with store.open_input_file(path) as source:
                    reader = TokenFileReader(source)
                    crcs = np.zeros(len(reader.doc_ids), np.int64)
                    for i in range(len(crcs)):
                        crc = 0
                        for part in reader.ids(i):
                            crc = zlib.crc32(part, crc)
                        crcs[i] = crc
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(reader.doc_ids, mask=reader.no_id), pa.array(reader.starts[:-1] + base),
                         pa.array(reader.n_tokens), pa.array(crcs)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.mapInArrow(scan, "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(read(spark, sf_dir, "documents"), scratch_path(spark, "token-files")))

"""Packing by minimum bin slack.

Each document's ids are cut into full windows and one remaining piece.  How
often each remaining length occurs is a table of at most ``window`` rows; from
it the driver plans windows: the longest remaining length is laid down, and a
bitset subset-sum over the other lengths with their counts finds the multiset
that fills the window closest to its capacity, traced back to counts per
length.  A plan is used as often as the counts allow before the next is made.
Pieces are numbered within their length (slice by slice of a hash, so that a
length held by a third of all pieces is not one task's work) and their numbers
look up window and offset.

Defined results: a null or empty text is a document of one id, the end id;
repeated rows are documents of their own; rows without id are packed under a
null id; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rastertab.llm.common import read, shuffle_width, written
from rastertab.llm.tokens import default_tokenizer, worker_encoder

_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer: str, window: int, end_id: int) -> DataFrame:
    """One row per piece: full windows of each document, then its remaining ids."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = worker_encoder(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        for b in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encoder.ids(text.as_py()) + end
                n = len(ids) // 4
                rows += [(doc_id, i, min(window, n - i), zlib.crc32(ids[4 * i:4 * (i + window)]), n) for i in range(0, n, window)]
            cols = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, _PIECE)


def fill(capacity: int, counts: dict[int, int]) -> dict[int, int]:
    """The multiset of lengths, within counts, whose sum is closest to and at
    most ``capacity``: bitset subset sums, one bitset kept per length, traced back."""
    mask, reach, steps = (1 << (capacity + 1)) - 1, 1, []
    for length in sorted((x for x in counts if counts[x] and x <= capacity), reverse=True):
        steps.append((length, reach))
        left, size = min(counts[length], capacity // length), 1
        while left:  # binary split of the count
            use = min(size, left)
            reach |= reach << (use * length) & mask
            left, size = left - use, size * 2
        if reach >> capacity & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        n = 0
        while not before >> total & 1:
            total, n = total - length, n + 1
        if n:
            used[length] = n
    return used


def plan(counts: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """(lengths of a window with their counts, number of such windows)."""
    left, out = {k: v for k, v in counts.items() if v}, []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        used = fill(window - longest, rest)
        used[longest] = used.get(longest, 0) + 1
        times = min(left[k] // n for k, n in used.items())
        out.append((used, times))
        for k, n in used.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return out


def _numbered(rows: DataFrame, slices: int) -> DataFrame:
    """Number the pieces of each length from 0, without one task per length."""
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(slices)).cast("int"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long"))).drop("n"))
    own = Window.partitionBy("length", "slice").orderBy(F.col("doc_id").asc_nulls_first(), "start", "ids_crc32", "doc_tokens")
    return (rows.join(offsets, ["length", "slice"])
            .withColumn("number", F.col("before") + F.row_number().over(own) - 1).drop("slice", "before"))


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = 1024, end_id: int = 0) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    cut = written(pieces(docs, tokenizer or default_tokenizer(), window, end_id), "packing-pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= window rows
    spans: dict[int, list[tuple[int, int, int, int]]] = {}  # length -> (first number, per window, first sequence, first offset)
    used_up, sequence = dict.fromkeys(counts, 0), 0
    for used, times in plan(counts, window):
        offset = 0
        for length in sorted(used, reverse=True):
            spans.setdefault(length, []).append((used_up[length], used[length], sequence, offset))
            used_up[length] += used[length] * times
            offset += length * used[length]
        sequence += times
    tables = {k: np.array(v, dtype=np.int64) for k, v in spans.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, number = b.column(2).to_numpy(), b.column(5).to_numpy()
            sequence_id, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for one in np.unique(length):
                at, t = np.flatnonzero(length == one), tables[int(one)]
                row = t[np.searchsorted(t[:, 0], number[at], side="right") - 1]
                within = number[at] - row[:, 0]
                sequence_id[at] = row[:, 2] + within // row[:, 1]
                offset[at] = row[:, 3] + within % row[:, 1] * one
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence_id), pa.array(offset)],
                                             names=[*b.schema.names[:5], "sequence_id", "offset"])

    numbered = _numbered(cut, 4 * shuffle_width(docs.sparkSession))
    return (numbered.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "number")
            .mapInArrow(place, _PIECE + ", sequence_id long, offset long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))

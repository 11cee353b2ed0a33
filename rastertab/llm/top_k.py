"""Exact top-k search: tiled matrix products of query tiles and candidate
shards, partial selection per tile, tree merging of the per-query top lists.

Vectors are turned into integers, ``floor(scale * x)``, and the score is the
exact inner product.  Queries and candidates are packed into tiles where they
are read; query tiles are dealt to the columns and candidate tiles to the rows
of a grid of tasks, so every pair of tiles meets once and neither side is
broadcast.

Defined results: a vector that is null or holds a null or non-finite component
takes no part, nor does a row without id.  Only vectors of equal length are
compared; the empty vector scores 0 with others like it.  A query's own rows
are all rows with its id.  A repeated query row gets its list once per row, a
repeated candidate row stands in lists once per row.  Scores beyond a long
stop at its limits.  An empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertab.llm.common import read, shuffle_width

_TILE = "tile long, n long, dim int, ids binary, vectors binary"
_LIMIT = np.iinfo(np.int64)


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def _pack(rows: DataFrame, id_col: str, vec_col: str, scale: float, height: int) -> DataFrame:
    """Rows of one input partition and length become tiles of up to ``height`` vectors."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, open_tiles = TaskContext.get().partitionId(), 0, {}

        def close(dim: int) -> pa.RecordBatch:
            nonlocal made
            ids, vectors = (np.concatenate(x) for x in zip(*open_tiles.pop(dim)))
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + made], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([dim], pa.int32()),
                 pa.array([ids.tobytes()], pa.binary()), pa.array([vectors.tobytes()], pa.binary())],
                names=["tile", "n", "dim", "ids", "vectors"])

        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            lists = b.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(sizes) else sizes
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                for i in range(0, len(at), height):
                    own = at[i:i + height]
                    block = flat[(starts[own][:, None] + np.arange(dim)[None, :])] if dim else np.zeros((len(own), 0))
                    open_tiles.setdefault(int(dim), []).append((ids[own].astype(np.int64), block))
                    if sum(len(x[0]) for x in open_tiles[int(dim)]) >= height:
                        yield close(int(dim))
        for dim in list(open_tiles):
            yield close(dim)

    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    return rows.where(F.col("id").isNotNull() & _usable(F.col("v"))).mapInArrow(pack, _TILE)


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products, candidates x queries."""
    top = (np.abs(q).max(initial=0), np.abs(c).max(initial=0))
    bound = float(top[0]) * float(top[1]) * max(1, q.shape[1])
    if bound < 2.0 ** 53:
        return (q @ c.T).astype(np.int64)
    if bound < 2.0 ** 63 and max(top) < 2.0 ** 63:
        return q.astype(np.int64) @ c.astype(np.int64).T
    whole = np.array([[int(x) for x in r] for r in q], dtype=object).reshape(q.shape) @ \
        np.array([[int(x) for x in r] for r in c], dtype=object).reshape(c.shape).T
    return np.clip(whole, _LIMIT.min, _LIMIT.max).astype(np.int64)


def _select(qid: np.ndarray, cid: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query the k best candidates of the tile, ties to the smaller id."""
    order = np.argsort(cid, kind="stable")
    cid, scores = cid[order], scores[:, order]
    out = []
    cut = np.partition(scores, scores.shape[1] - k - 1, axis=1)[:, scores.shape[1] - k - 1] if scores.shape[1] > k + 1 else None
    for i in range(len(qid)):
        at = np.arange(len(cid)) if cut is None else np.flatnonzero(scores[i] >= cut[i])  # k + 1 best and all their ties
        at = at[cid[at] != qid[i]]
        if len(at) < k and cut is not None:  # several rows bear the query's id
            at = np.flatnonzero(cid != qid[i])
        best = at[np.argsort(-scores[i][at].astype(object) if scores[i].min(initial=0) == _LIMIT.min else -scores[i][at],
                             kind="stable")][:k]
        out.append((scores[i][best], cid[best]))
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: float = 256.0, tile_rows: int = 2048, query_share: float = 0.02, fan_in: int = 16) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows of ``vectors`` for each
    row of ``queries`` (a stated set, met in blocks).  ``query_share`` is the
    expected part of rows that are queries; it only shapes the grid."""
    if k < 1:
        raise ValueError("k must be positive")
    spark = vectors.sparkSession
    tasks = shuffle_width(spark)
    cols = min(tasks, math.ceil(math.sqrt(tasks / query_share)))  # query tiles are copied to each column
    rows = math.ceil(tasks / cols)
    q = _pack(queries, id_col, vec_col, scale, tile_rows)
    q = q.select(F.col("tile").alias("q_tile"), F.col("dim"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vec"),
                 F.pmod(F.xxhash64("tile"), F.lit(rows)).cast("int").alias("row"),
                 F.explode(F.sequence(F.lit(0), F.lit(cols - 1))).alias("col"))
    c = _pack(vectors, id_col, vec_col, scale, tile_rows)
    c = c.select(F.col("tile").alias("c_tile"), F.col("dim"), F.col("ids").alias("c_ids"), F.col("vectors").alias("c_vec"),
                 F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("row"),
                 F.pmod(F.xxhash64("tile"), F.lit(cols)).cast("int").alias("col"))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                q_tile, c_tile, dim, q_ids, q_vec, c_ids, c_vec = (b.column(i)[r].as_py() for i in range(7))
                qid, cid = np.frombuffer(q_ids, np.int64), np.frombuffer(c_ids, np.int64)
                qv = np.frombuffer(q_vec, np.float64).reshape(len(qid), dim)
                cv = np.frombuffer(c_vec, np.float64).reshape(len(cid), dim)
                lists = [(i + j, x) for i in range(0, len(qid), 256)
                         for j, x in enumerate(_select(qid[i:i + 256], cid, _scores(qv[i:i + 256], cv), k))]
                tops = pa.array([[{"neg": -max(int(s), -_LIMIT.max), "vec_id": int(v)} for s, v in zip(*x)] for _, x in lists],
                                pa.list_(pa.struct([("neg", pa.int64()), ("vec_id", pa.int64())])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q_tile] * len(qid), pa.int64()), pa.array([i for i, _ in lists], pa.int32()), pa.array(qid, pa.int64()),
                     pa.array([c_tile] * len(qid), pa.int64()), tops], names=["q_tile", "pos", "query_id", "node", "top"])

    pairs = q.join(c, ["dim", "row", "col"]).select("q_tile", "c_tile", "dim", "q_ids", "q_vec", "c_ids", "c_vec")
    lists = pairs.mapInArrow(multiply, "q_tile long, pos int, query_id long, node long, top array<struct<neg:long,vec_id:long>>")
    # tree merge: at most fan_in lists of k meet in a node; the tree's depth follows the width of the grid
    widths = [fan_in ** i for i in range(math.ceil(math.log(max(2, tasks * 4), fan_in)) - 1, -1, -1)]
    for width in widths:
        node = F.pmod(F.xxhash64("node"), F.lit(width)) if width > 1 else F.lit(0)
        lists = (lists.withColumn("node", node.cast("long")).groupBy("q_tile", "pos", "query_id", "node")
                 .agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top")))
    return (lists.select("query_id", F.posexplode("top").alias("at", "hit"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                    (-F.col("hit.neg")).alias("score")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(rows, rows.where(F.col("vec_id") % 50 == 0))


ORACLE = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""

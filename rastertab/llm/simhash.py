"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints (64 bits) that differ in at most ``distance`` bits, cut into
``blocks`` blocks, agree in at least ``blocks - distance`` of them.  Each
distinct fingerprint is dealt once per choice of that many blocks under the
bits of these blocks; fingerprints that meet are compared.  Within a meeting
only a spanning forest of the links is emitted, so a group of m near copies
gives at most m - 1 rows per choice of blocks, never all its pairs; meetings
that are too large for one task are first cut into parts by the same
pigeonhole argument over the bits not yet used.  Components are then labelled by alternating star
contraction over written tables.

Only distinct fingerprints take part, with or without an id, so exact copies,
however many, are one row.  A component is named by the smallest id in it.

Defined results: null, empty and word-less texts have fingerprint zero, linked
like any other; a row without id gets the component of its fingerprint, null
when no row with an id has a fingerprint linked to it; repeated rows share a
component; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertab.llm.common import read, written

SEED = 42  # fixed value of the query


def fingerprint(text: str | None, shingle: int) -> int:
    """Bits set in over half the XXH64 values of the word shingles."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and exactly the six white characters
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    line, n = b" ".join(words), max(1, len(words) - shingle + 1)
    spans = zip(starts[:n].tolist(), ends[min(shingle, len(words)) - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in spans), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 14):  # a block of bits at a time, whatever the text's length
        bits = np.unpackbits(hashes[i:i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str, shingle: int) -> DataFrame:
    """``doc_id, tie, fp``: a hash of the text, and the 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], names=["doc_id", "tie", "fp"])

    body = F.col(text).cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(body), body).mapInArrow(run, "doc_id long, tie long, fp long")


def _masks(bits: list[int], blocks: int, distance: int) -> list[int]:
    """Masks over ``bits``: every choice of blocks - distance of the blocks."""
    parts = np.array_split(np.array(bits), blocks)
    return [sum(1 << int(b) for p in chosen for b in p) for chosen in itertools.combinations(parts, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(group: np.ndarray, fps: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning forests of the links inside each run of equal ``group``
    (sorted): breadth first, so a member leaves the comparison once reached."""
    out = []
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(starts, len(group)))
    two = starts[sizes == 2]
    near = np.bitwise_count(fps[two] ^ fps[two + 1]) <= distance
    out.append((fps[two[near]], fps[two[near] + 1]))
    for at, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        left = fps[at:at + size]
        while len(left) > 1:
            reached, left = [left[0]], left[1:]
            while reached and len(left):
                one = reached.pop()
                near = np.bitwise_count(left ^ one) <= distance
                if near.any():
                    out.append((np.repeat(one, near.sum()), left[near]))
                    reached += list(left[near])
                    left = left[~near]
    return out


def links(fps: DataFrame, distance: int, blocks: int, largest: int = 4096) -> DataFrame:
    """``a, b``: links between distinct fingerprints that connect all that are
    within ``distance`` bits through others."""
    choices = _masks(list(range(64)), blocks, distance)

    def dealt(rows: DataFrame, masks: list[int]) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for m in masks])
        return rows.select("fp", F.explode(keys).alias("k")).select("fp", F.col("k.mask").alias("mask"), F.col("k.bits").alias("bits"))

    met = dealt(fps, choices)
    sizes = met.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # meetings beyond `largest` members are dealt again over the bits their mask leaves out, with as many blocks
    large = written(sizes.where(F.col("n") > largest).select("mask", "bits"), "simhash-large")
    finer = []
    if large.limit(1).count():
        hot = met.join(large, ["mask", "bits"])
        for m in choices:
            rest = [b for b in range(64) if not m >> b & 1]
            own = hot.where(F.col("mask") == F.lit(_signed(m)))
            finer.append(dealt(own, [x | m for x in _masks(rest, blocks, distance)]))
        met = met.join(large, ["mask", "bits"], "left_anti")
    for f in finer:
        met = met.unionByName(f)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3

        def found(mask, bits, fp) -> pa.RecordBatch:
            new = np.concatenate([[True], (mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])]) if len(mask) else np.empty(0, bool)
            pairs = _forest(np.cumsum(new), fp.view(np.uint64), distance)
            a, b = (np.concatenate([p[i] for p in pairs]).astype(np.uint64).view(np.int64) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            held = [np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held)]
            mask, bits, _ = held
            last = np.flatnonzero((mask != mask[-1]) | (bits != bits[-1])) if len(mask) else []
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield found(*[h[:cut] for h in held])
                held = [h[cut:] for h in held]
        if len(held[0]):
            yield found(*held)

    ranged = met.select("mask", "bits", "fp").repartition("mask", "bits").sortWithinPartitions("mask", "bits", "fp")
    return ranged.mapInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, root``: for each node of ``edges`` (``a, b``) the smallest node it
    reaches.  Large-star and small-star steps alternate over written tables
    until the edges stop changing; each step halves long paths and only
    takes minima per node, so a node with very many links is no task's burden."""
    def stars(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        return (small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
                .where("a <> b").distinct())

    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), name)
    before = None
    while (now := state(edges)) != before:
        before, edges = now, written(stars(edges), name)
    return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")


def grouped(docs: DataFrame, text: str, shingle: int, distance: int, blocks: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, tie, fp`` of every row, and ``fp, root, component_id`` of every
    fingerprint: the component's own name and the smallest id in it."""
    if not 0 <= distance < blocks <= 64:
        raise ValueError("distance must be below blocks")
    marked = written(with_fingerprints(docs, text, shingle), "simhash-fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))  # null when no row with the fingerprint has an id
    edges = written(links(nodes.select("fp"), distance, blocks), "simhash-links")
    roots = components(edges, "simhash-components").withColumnRenamed("node", "fp")
    nodes = written(nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "simhash-nodes")
    names = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    # written, so that the last join sees two plain sides and can split a fingerprint with very many rows
    return marked, written(nodes.join(names, "root").select("fp", "root", "component_id"), "simhash-classes")


def near_duplicates(docs: DataFrame, text: str = "text", shingle: int = 3, distance: int = 3, blocks: int = 5) -> DataFrame:
    """``doc_id, fp, component_id`` of every row."""
    marked, classes = grouped(docs, text, shingle, distance, blocks)
    return marked.join(classes, "fp", "left").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, text: str = "text", shingle: int = 3, distance: int = 3, blocks: int = 5) -> DataFrame:
    """One row of each component, with all its columns: the one with the
    smallest id (rows without id last), of rows that share it the one with the
    smallest hash of its text, of rows alike in both any one."""
    marked, classes = grouped(docs, text, shingle, distance, blocks)
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "tie")
    # a fingerprint has one first row, so that a component joins as many rows as it has fingerprints
    first = marked.groupBy("fp").agg(F.min(place).alias("first"))
    heads = first.join(classes, "fp").groupBy("root").agg(F.min("first").alias("first"))
    heads = written(heads.select(F.col("first.doc_id").alias("__head"), F.col("first.tie").alias("__own")), "simhash-heads")
    tie = F.xxhash64(F.col(text).cast("string"))
    rows = docs.withColumn("__tie", tie)
    kept = rows.join(heads, rows["doc_id"].cast("long").eqNullSafe(heads["__head"]) & (rows["__tie"] == heads["__own"]), "left_semi")
    return kept.dropDuplicates(["doc_id", "__tie"]).drop("__tie")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

"""The training-data pipeline: toxicity, SimHash near-duplicates, substring
dedup, mixing, packing.  Every stage works on all rows its predecessor kept;
its result is written as Parquet and read again as the next stage's input.

Defined results: an empty table passes through every stage and gives no pieces;
null, empty and white-space texts are scored like texts without terms, are one
group of near duplicates (fingerprint zero), lose nothing to substring dedup and
have no words for the mix to take; rows without id and rows that share an id are
judged by their own texts in every stage, and of repeated rows one stays in the
near-duplicate stage; very long texts are read whole.  Other columns of the
documents ride in a struct beside what an operator reads, so none can clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertab.llm.common import read, written
from rastertab.llm.mixing import mix
from rastertab.llm.packing import pack
from rastertab.llm.simhash import one_of_each
from rastertab.llm.substring_dedup import dedup_substrings
from rastertab.llm.toxicity import score_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_rest(docs: DataFrame) -> DataFrame:
    """What operators read, and the row's other columns beside it, so that no
    column of the documents can clash with one that an operator adds."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "text"]
    return docs.select("doc_id", "text", "source", F.struct(*rest).alias("__rest"))


def _columns(docs: DataFrame, **new: Column) -> list[Column]:
    """The documents' columns again, from ``text`` and ``__rest``, or as given."""
    own = {f.name: F.col("text") if f.name.lower() == "text" else F.col("__rest")[f.name] for f in docs.schema.fields}
    return [new.get(f.name.lower(), own[f.name]).cast(f.dataType).alias(f.name) for f in docs.schema.fields]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches 0.7 go.  Texts of the labelled
    examples come from the same documents."""
    scored = score_toxicity(_with_rest(docs), read(spark, sf_dir, "labels"))
    return scored.where("toxic_predicted = 0").select(*_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints stays (three-word shingles,
    three bits at most): the one with the smallest id, rows without id last; of
    rows that share the id the one with the smallest hash of its text."""
    return one_of_each(_with_rest(docs), shingle=3, distance=3).select(*_columns(docs))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 20-word windows that start earlier elsewhere go.  A document
    that loses nothing keeps its text as it was; one that loses all its words
    goes; the others keep the remaining words joined by one space."""
    found = dedup_substrings(_with_rest(docs)).where((F.size("removed") == 0) | (F.octet_length("kept") > 0))
    whole, left = F.size("removed") == 0, F.col("kept").cast("string")
    new = {"text": F.when(whole, F.col("text")).otherwise(left)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(whole, F.col("__rest")["n_chars"]).otherwise(F.length(left))
    return found.select(*_columns(docs, **new))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by weighted fair queueing: a document appears as often as it is taken."""
    return mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents of the mix, packed into windows of 1024 tokens."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: Fingerprints, neighbour votes and token ids are beyond SQL; the tests hold
#: the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

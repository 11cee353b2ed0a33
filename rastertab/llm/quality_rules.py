"""Host-level quality rules [native]: rule failures of documents are added up
by host (``source``), the failure rate of each host is shrunk towards all
hosts' rate with an empirical beta prior, and the host's verdict is joined back.

A document breaks a rule when it has few words, mostly repeated word triples,
many symbols, odd word lengths or mostly repeated lines; the first two are the
base rules and drop the document itself.  Hosts: ``reject`` (shrunk rate over
``reject_over``) drops all their documents, ``strict`` (over ``strict_over``)
drops those that break any rule, ``accept`` keeps all that pass the base rules.

Only sums per host are shuffled for the rates; in the join back a host with more
rows than a task's share is spread over as many keys as it has shares.  Such
hosts are as many as there are tasks at most, and are sent to all.

Defined results: a null or word-less text has no words and fails the base
rules; documents without source form one host; documents without id are judged
like others; repeated rows count each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertab.llm.common import SPACES, read, shuffle_width, words, written

SYMBOLS = "#*$%&|<>"  # fixed value of the query


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words``.

    Repeated word triples are found per document on hashes of the triples: when
    any hash occurs twice, (hash, place) pairs are sorted, places whose
    neighbour has the same hash are kept, and the words they cover counted."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    w, h, pairs = F.col("__w"), F.col("__h"), F.col("__pairs")
    no_pairs = F.array().cast("array<struct<h:long,i:int>>")
    twin = F.filter(pairs, lambda e, j: ((j > 0) & F.get(pairs, j - 1)["h"].eqNullSafe(e["h"]))
                    | F.get(pairs, j + 1)["h"].eqNullSafe(e["h"]))
    covered = F.aggregate(
        F.sort_array(F.transform(twin, lambda e: e["i"])), F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    out = docs.withColumns({"__w": words(F.col(text)), "__lines": lines})
    out = out.withColumns({
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.translate(body, SPACES, "")).cast("long"),
        "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__h": F.when(F.size(w) < 3, F.array().cast("array<long>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))),
    })
    out = out.withColumn("__pairs", F.when(F.size(F.array_distinct(h)) == F.size(h), no_pairs).otherwise(
        F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    out = out.withColumn("n_repeat_words", F.when(F.size(pairs) == 0, F.lit(0)).otherwise(covered).cast("long"))
    return out.drop("__w", "__lines", "__h", "__pairs")


def _base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _any_failed():
    n = F.col("n_words")
    return (_base_failed() | (10 * F.col("n_symbols") > n) | (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)
            | (2 * F.col("n_dup_lines") > F.col("n_lines")))


def host_verdicts(rated: DataFrame, reject_over: float, strict_over: float) -> DataFrame:
    """``source, docs, failed, rate, verdict``.  Prior by moments: the strength
    is what the spread of host rates beyond chance implies, from 1 to 1000."""
    hosts = rated.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.col("failed").cast("long")).alias("failed"))
    sums = hosts.agg(F.sum("docs").alias("all_docs"), F.sum("failed").alias("all_failed"), F.count(F.lit(1)).alias("hosts"),
                     F.sum((F.col("docs") * F.col("docs")).cast("decimal(38,0)")).cast("double").alias("squares"),
                     F.sum((F.col("failed") * F.col("failed") / F.col("docs")).cast("decimal(38,6)")).cast("double").alias("q"))
    s = sums.first()  # one row
    if not s["all_docs"]:
        strength = p = 0.0
    else:
        n, p = float(s["all_docs"]), s["all_failed"] / s["all_docs"]
        chance = p * (1 - p)
        spread = (s["q"] - n * p * p) / n - chance * (s["hosts"] - 1) / n
        room = chance * (1 - s["squares"] / (n * n))
        strength = min(1000.0, max(1.0, room / spread - 1)) if spread > 0 and room > 0 else 1000.0
    rate = (F.col("failed") + strength * p) / (F.col("docs") + strength)
    return (hosts.withColumn("rate", rate)
            .withColumn("verdict", F.when(rate > reject_over, "reject").when(rate > strict_over, "strict").otherwise("accept")))


def judge(docs: DataFrame, reject_over: float = 0.5, strict_over: float = 0.25) -> DataFrame:
    """``doc_id, source``, the features, ``base_failed, any_failed, host_rate,
    host_verdict, kept`` of every document."""
    rated = features(docs.select("doc_id", "source", "text")).drop("text")
    rated = rated.withColumns({"base_failed": _base_failed(), "any_failed": _any_failed()})
    rated = written(rated, "quality-features")  # the texts are read and split once
    hosts = host_verdicts(rated.withColumn("failed", F.col("any_failed")), reject_over, strict_over)
    width = shuffle_width(docs.sparkSession)
    total = hosts.agg(F.sum("docs")).first()[0] or 1  # one row
    hosts = hosts.withColumn("__parts", F.ceil(F.col("docs") * F.lit(width / total)).cast("int"))
    hot = hosts.where("__parts > 1").select(F.col("source").alias("__hot"), F.col("__parts"))  # fewer than width rows
    rated = rated.join(F.broadcast(hot), F.col("source").eqNullSafe(F.col("__hot")), "left").drop("__hot")
    hosts = hosts.select(F.col("source").alias("__host"), F.col("rate").alias("host_rate"), F.col("verdict").alias("host_verdict"),
                         F.explode(F.sequence(F.lit(0), F.greatest(F.col("__parts"), F.lit(1)) - 1)).alias("__hsalt"))
    spread = F.pmod(F.xxhash64("doc_id", "word_chars", "n_words", F.spark_partition_id()), F.coalesce("__parts", F.lit(1)))
    rated = rated.withColumn("__salt", spread.cast("int")).drop("__parts")
    kept = ~F.col("base_failed") & ((F.col("host_verdict") == "accept")
                                    | ((F.col("host_verdict") == "strict") & ~F.col("any_failed")))
    return (rated.join(hosts, F.col("source").eqNullSafe(F.col("__host")) & (F.col("__salt") == F.col("__hsalt")))
            .withColumn("kept", kept).drop("__salt", "__hsalt", "__host"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, source, coalesce(text, '') AS body,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), g AS (
  SELECT row_no, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS triple
  FROM (SELECT row_no, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
), r AS (
  SELECT row_no, i FROM (SELECT *, count(*) OVER (PARTITION BY row_no, triple) AS n FROM g) WHERE n > 1
), c AS (
  SELECT row_no, count(DISTINCT j) AS n FROM (SELECT row_no, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY row_no
), f AS (
  SELECT d.row_no, doc_id, source, len(w)::BIGINT AS n_words, len(lines) AS n_lines,
         length(regexp_replace(body, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN c USING (row_no)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f
), a AS (
  SELECT *, base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 2 * n_dup_lines > n_lines AS any_failed FROM b
), h AS (
  SELECT source, count(*) AS docs, sum(any_failed::INT) AS failed FROM a GROUP BY source
), m AS (
  SELECT sum(docs)::DOUBLE AS n, sum(failed)::DOUBLE / sum(docs) AS p, count(*) AS hosts, sum(docs * docs)::DOUBLE AS squares,
         sum((failed * failed)::DOUBLE / docs) AS q FROM h
), k AS (
  SELECT p, p * (1 - p) * (1 - squares / (n * n)) AS room,
         (q - n * p * p) / n - p * (1 - p) * (hosts - 1) / n AS spread FROM m
), s AS (
  SELECT p, CASE WHEN spread > 0 AND room > 0 THEN least(1000, greatest(1, room / spread - 1)) ELSE 1000 END AS strength FROM k
), v AS (
  SELECT source, (failed + strength * p) / (docs + strength) AS rate FROM h, s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (rate <= 0.25 OR (rate <= 0.5 AND NOT any_failed)) AS kept
FROM a JOIN v ON a.source IS NOT DISTINCT FROM v.source
"""

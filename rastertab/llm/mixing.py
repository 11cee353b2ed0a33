"""Mixing sources to target weights by weighted fair queueing [native].

Documents of a source are shuffled (by a digest of seed and id) and served in
that order, up to ``max_repeats`` rounds.  A copy's virtual finish time is the
source's words up to and with it, divided by the source's target.  All copies
are ranged by that time and the line is cut at the total budget; of the copy
that the cut falls into, ``taken`` counts the words before the cut, ``copies``
counts whole copies.

Targets: sources in code point order (null last) weigh ``weights`` in turn and
share the budget, which is the words of all documents; a target stops at
``max_repeats`` times its source's words and the excess is shared by weight
among the rest.

No source is summed in one task: words are added up per (source, slice of the
shuffle) and per slice of virtual time, both of even width, so a source with a
third of all rows spreads over all tasks.  Only sums per source and slice pass
through small ordered windows.

Defined results: null texts have size 0; documents of size 0 are not taken (0);
rows without id are shuffled by their size; repeated rows are served one after the
other; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from rastertab.llm.common import n_words, read, written

WEIGHTS = (1, 2, 3)  # fixed values of the query
MAX_REPEATS = 3
SLICES = 1024  # slices of virtual time per unit of it


def targets(totals: DataFrame, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    """``source_size -> weight, target`` per source.  With sources in the order
    of limit per weight, those before the first that its share does not fill
    are held at their limit; the rest share what is left by weight."""
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    t = totals.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), at % len(weights) + 1).cast("long"))
    t = t.withColumn("most", F.col("source_size") * max_repeats)
    by_fill = Window.orderBy(F.col("most") / F.col("weight"), "sk")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    t = (t.withColumn("held", F.coalesce(F.sum("most").over(before), F.lit(0).cast("long")))
         .withColumn("rest", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0).cast("long")))
         .withColumn("budget", F.sum("source_size").over(everything))
         .withColumn("level", (F.col("budget") - F.col("held")) / F.col("rest")))
    first_free = F.min(F.when(F.col("most") > F.col("level") * F.col("weight"), F.struct("held", "rest"))).over(everything)
    share = (F.col("budget") - first_free["held"]) / first_free["rest"]
    return (t.withColumn("target", F.coalesce(F.least(F.col("most").cast("double"), share * F.col("weight")),
                                              F.col("most").cast("double")))
            .select("sk", "source_size", "weight", "target", "budget"))


def _source_key(source: Column) -> Column:
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source.cast("string")))


_PLACE = ("time", "sk", "key", "doc_id", "size")


def _place_order() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in _PLACE]


def _before(time: Column, round_no: int, cut: Row) -> Column:
    """Whether a copy stands before the cut, in the order time, place, round."""
    earlier = F.lit(round_no < cut["round"])
    for name in reversed(_PLACE):
        here, there = time if name == "time" else F.col(name), F.lit(cut[name])
        less = here.isNull() & there.isNotNull() | F.coalesce(here < there, F.lit(False))
        earlier = less | here.eqNullSafe(there) & earlier
    return earlier


def serve(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = "mix") -> DataFrame:
    """Add ``source_size, target, copies, taken, virtual_time`` to rows with
    ``doc_id, source, size``.  Reads ``sized`` three times: give it a written
    table."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"),
                                                                     F.concat(F.lit("-"), F.col("size").cast("string")))))
    rows = (sized.withColumns({"sk": _source_key(F.col("source")), "key": key})
            .withColumn("slice", F.substring("key", 1, 3)))
    sums = rows.groupBy("sk", "slice").agg(F.sum("size").alias("words"), F.min("source").alias("source"))
    per_source = targets(sums.groupBy("sk").agg(F.sum("words").alias("source_size"), F.min("source").alias("source")),
                         weights, max_repeats)
    before = Window.partitionBy("sk").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sums.withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0).cast("long")))
               .select("sk", "slice", "offset").join(per_source, "sk"))
    served = Window.partitionBy("sk", "slice").orderBy("key", F.col("doc_id").asc_nulls_first(), "size")
    rows = (rows.join(offsets, ["sk", "slice"])
            .withColumn("upto", F.col("offset") + F.sum("size").over(served.rowsBetween(Window.unboundedPreceding, 0))))

    # virtual finish times of all rounds; the cut is the first copy beyond the budget
    def finish(round_no: Column) -> Column:
        return (round_no * F.col("source_size") + F.col("upto")) / F.nullif(F.col("target"), F.lit(0.0))

    copies = (rows.where("size > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("round"))
              .withColumn("time", finish(F.col("round")))
              .withColumn("part", F.least(F.floor(F.col("time") * SLICES), F.lit(4 * SLICES).cast("long"))))
    line = Window.orderBy("part")
    parts = (copies.groupBy("part").agg(F.sum("size").alias("words"), F.first("budget").alias("budget"))
             .withColumn("upto_part", F.sum("words").over(line)))
    crossing = (parts.where("upto_part > budget").orderBy("part").limit(1)
                .select("part", (F.col("upto_part") - F.col("words")).alias("before_part")))
    inside = Window.partitionBy("part").orderBy(*_place_order(), "round")
    cut = (copies.join(F.broadcast(crossing), "part")  # one row
           .withColumn("line", F.col("before_part") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
           .where("line > budget").select(*_PLACE, "round", (F.col("budget") - F.col("line") + F.col("size")).alias("part"))
           .orderBy(*_place_order(), "round").first())
    taken_rounds = F.lit(0)
    for i in range(max_repeats):
        served_before = F.lit(True) if cut is None else _before(finish(F.lit(i)), i, cut)
        taken_rounds = taken_rounds + F.when((F.col("size") > 0) & served_before, 1).otherwise(0)
    part = F.lit(0)
    if cut is not None:  # the copy at the cut gives the words that are left of the budget
        here = finish(F.lit(cut["round"])).eqNullSafe(F.lit(cut["time"]))
        for name in _PLACE[1:]:
            here = here & F.col(name).eqNullSafe(F.lit(cut[name]))
        part = F.when(here, F.lit(cut["part"])).otherwise(0)
    return (rows
            .withColumn("copies", taken_rounds)
            .withColumn("taken", (F.col("copies") * F.col("size") + part).cast("long"))
            .withColumn("virtual_time", finish(F.lit(0)))
            .drop("sk", "key", "slice", "offset", "weight", "budget", "upto"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = "mix") -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, ranged by
    virtual finish time."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    same = F.xxhash64(F.col("doc_id"), F.col("source"), F.col("text"))
    nth = Window.partitionBy("doc_id", "same").orderBy("source")  # identical rows are told apart by number
    keyed = docs.select("doc_id", "source", same.alias("same"), n_words(F.col("text")).alias("size"), row.alias("row"))
    sized = written(keyed.drop("row"), "mix-sizes")
    chosen = (serve(sized, weights, max_repeats, seed).where("copies > 0").withColumn("nth", F.row_number().over(nth))
              .select(F.col("doc_id").alias("id"), F.col("same").alias("as"), "nth", "copies", "virtual_time",
                      (F.col("source_size") / F.col("target")).alias("lap")))
    rows = keyed.withColumn("nth", F.row_number().over(nth)).select("doc_id", "same", F.col("nth").alias("number"), "row")
    met = rows.join(chosen, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("same") == F.col("as")) & (F.col("number") == F.col("nth")))
    return (met.withColumn("lap_no", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
            .select("row", (F.col("virtual_time") + F.col("lap_no") * F.col("lap")).alias("time"))
            .repartitionByRange("time").sortWithinPartitions("time").select("row.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    sized = written(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "op10-sizes")
    return serve(sized).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = """
WITH d AS (
  SELECT doc_id, source, size, md5('mix:' || coalesce(doc_id::VARCHAR, '-' || size)) AS key FROM (
    SELECT doc_id, source,
           len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS size
    FROM documents)
), t AS (
  SELECT source, sum(size)::BIGINT AS s,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source
), l AS (
  SELECT *, 3 * s AS most, coalesce(sum(3 * s) OVER b, 0) AS held,
         sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS rest, sum(s) OVER () AS budget
  FROM t WINDOW b AS (ORDER BY 3 * s / w::DOUBLE, coalesce('s' || source, 'n')
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT held AS held0, rest AS rest0 FROM l
  WHERE most > (budget - held)::DOUBLE / rest * w ORDER BY held LIMIT 1
), g AS (
  SELECT source, s, budget,
         coalesce(least(most::DOUBLE, (budget - held0)::DOUBLE / rest0 * w), most::DOUBLE) AS target
  FROM l LEFT JOIN f ON true
), u AS (
  SELECT d.*, g.s, g.target, g.budget, coalesce('s' || d.source, 'n') AS sk,
         sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS FIRST, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         row_number() OVER () AS row_no
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
), c AS (
  SELECT row_no, size, budget, sum(size) OVER (
           ORDER BY (e * s + upto)::DOUBLE / target, sk, key, doc_id NULLS FIRST, size, e
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS line
  FROM u, range(3) r(e) WHERE size > 0
), k AS (
  SELECT row_no, sum(least(size, budget - (line - size))) AS taken FROM c WHERE line - size < budget GROUP BY row_no
)
SELECT doc_id, size, s AS source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM u LEFT JOIN k USING (row_no)
"""

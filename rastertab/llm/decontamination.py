"""Benchmark decontamination [native] with a distributed positional inverted index.

The index holds one posting (row, term, place) for every occurrence of a test
term in the documents, written once, sharded as the documents are.  A window is
ten consecutive words of an item (all words of a shorter one).  Its terms are
ordered by the length of their lists, rarest first: the places of the rarest,
less its offset in the window, are the first candidates; the list of the second
is intersected with them on (row, place); what is left is intersected with all
further lists.  A place that every list names is an exact phrase match.

Proximity matches take the same index: around each place of the rarest term all
other terms of the window must stand, in any order, within a stretch of ``width``
words; the narrowest stretch is returned.

Joins are on (row, place, term), so a frequent word is spread like any other
posting; only the first join is on the term, of the rarest terms' lists with
their windows, and a long list is dealt in parts there.  Postings are dealt to the last lists once, at
every size of the input.
Nothing holds a whole document or a whole list.

Defined results: null and word-less texts have no words and no hits; a null or
word-less item has no windows; repeated rows, rows that share an id and rows
without id are judged each by their own text; repeated items, and items that
share an id, count once by id, items without id as one item with an empty name;
a window that several items share is a hit for each.  Very long texts are
postings like others.  Equal list lengths are ordered by offset.  Columns besides
``doc_id, text`` and ``item_id, text`` are not read, so none can clash.  Without
documents the result is empty, without items no document is contaminated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertab.llm.common import read, shuffle_width, written

# What stands between words, and the letters that are lowered.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = 0  # term of the posting behind the last word of every row: its place is the number of words


def words(text: Column) -> Column:
    """Words of a text; null for null."""
    ascii_only = F.octet_length(text) == F.length(text)  # where lower() touches A-Z only
    return F.array_remove(F.split(F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER)), BETWEEN), "")


# --------------------------------------------------------------------------- test side
def item_windows(items: DataFrame, size: int = 10) -> tuple[DataFrame, DataFrame]:
    """Distinct windows ``window, terms`` (words) and ``window, item``."""
    w = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("w"))
    w = w.where(F.size("w") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))).alias("i")
    every = written(w.select("item", "w", starts).select("item", F.slice("w", F.col("i"), size).alias("terms")), "leak-items")
    windows = written(every.select("terms").distinct().withColumn("window", F.monotonically_increasing_id()), "leak-windows")
    named = written(every.join(windows, "terms").select("window", "item").distinct(), "leak-names")
    return windows, named


def vocabulary(windows: DataFrame) -> DataFrame:
    """``word, term``: numbers of the test words, and of the end mark."""
    terms = windows.select(F.explode("terms").alias("word")).distinct()
    terms = terms.withColumn("term", F.monotonically_increasing_id() + 1)
    end = windows.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(END).cast("long").alias("term"))
    return written(terms.unionByName(end), "leak-terms")


def ranked_lists(windows: DataFrame, vocab: DataFrame, index: DataFrame) -> DataFrame:
    """``window, size, lists``: (n, offset, term) of a window's words, rarest
    first.  A window with a word that no document has cannot match and is left out."""
    lengths = index.where(F.col("term") != END).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    places = windows.select("window", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "word"))
    known = places.join(vocab, "word").join(lengths, "term")
    lists = known.groupBy("window", "size").agg(F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("lists"))
    return written(lists.where(F.size("lists") == F.col("size")), "leak-lists")


# --------------------------------------------------------------------------- training side
def build_index(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """``row, doc_id, place, term``: postings of the test words, and of the end
    of every row, which alone has the id."""
    ended = F.concat(F.coalesce(words(F.col("text")), F.array().cast("array<string>")), F.array(F.lit("")))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", ended.alias("w"))
    postings = rows.select("row", "doc_id", F.posexplode("w").alias("place", "word"))
    named = F.when(F.col("term") == END, F.col("doc_id")).alias("doc_id")
    return written(postings.join(vocab, "word").select("row", named, "place", "term"), "leak-index")


def _of_terms(index: DataFrame, lists: DataFrame, rank: int) -> DataFrame:
    """Postings of the terms that are ``rank``-th of some window."""
    terms = lists.where(F.col("size") > rank).select(F.col("lists")[rank]["term"].alias("term")).distinct()
    return index.select("row", "place", "term").join(terms, "term", "left_semi")


def phrase_matches(index: DataFrame, lists: DataFrame) -> DataFrame:
    """``row, window, start, size``: every place where a window's words stand."""
    # a frequent term that is some window's rarest: its list is dealt in parts no longer than a task's share of all
    rarest = lists.select(F.col("lists")[0]["term"].alias("term"), F.col("lists")[0]["n"].alias("n")).distinct()
    total = rarest.agg(F.sum("n")).first()[0] or 1  # one row
    parts = F.ceil(F.col("n") * F.lit(shuffle_width(index.sparkSession) / total)).cast("int")
    rarest = rarest.select("term", F.greatest(parts, F.lit(1)).alias("parts"))
    first = lists.select("window", "size", F.col("lists")[0]["term"].alias("term"), F.col("lists")[0]["offset"].alias("offset"),
                         F.get("lists", F.lit(1)).alias("second"))
    first = first.join(rarest, "term").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    postings = index.select("row", "place", "term").join(rarest, "term")
    postings = postings.select("row", "place", "term", F.pmod(F.xxhash64("row", "place"), F.col("parts")).cast("int").alias("part"))
    found = (postings.join(first, ["term", "part"])
             .withColumn("start", F.col("place") - F.col("offset")).where("start >= 0"))
    singles = found.where("size = 1").select("row", "window", "start", "size")
    wanted = found.where("size > 1").select("row", "window", "start", "size", F.col("second.term").alias("term"),
                                            (F.col("start") + F.col("second.offset")).alias("place"))
    both = written(wanted.join(_of_terms(index, lists, 1), ["row", "place", "term"], "left_semi")
                   .select("row", "window", "start", "size"), "leak-candidates")
    pairs = both.where("size = 2")
    further = F.explode(F.slice("lists", 3, F.col("size") - 2)).alias("one")
    open_lists = (both.where("size > 2").join(lists.select("window", "lists"), "window")
                  .select("row", "window", "start", "size", further)
                  .select("row", "window", "start", "size", F.col("one.term").alias("term"),
                          (F.col("start") + F.col("one.offset")).alias("place")))
    # every posting is dealt once, the few open lists are what a task holds
    whole = (index.where(F.col("term") != END).select("row", "place", "term")
             .join(open_lists.hint("shuffle_hash"), ["row", "place", "term"])
             .groupBy("row", "window", "start", "size").agg(F.count(F.lit(1)).alias("n")).where("n = size - 2").drop("n"))
    return written(singles.unionByName(pairs).unionByName(whole), "leak-matches")


def proximity_matches(index: DataFrame, lists: DataFrame, width: int) -> DataFrame:
    """``row, window, at, first, last``: for each place ``at`` of a window's
    rarest term the narrowest stretch of at most ``width`` words around it that
    holds every word of the window once or more, in any order (ties: the first)."""
    postings = index.where(F.col("term") != END).select("row", "place", "term")
    rarest = F.col("lists")[0]["term"]
    others = F.array_remove(F.array_distinct(F.transform("lists", lambda x: x["term"])), rarest)
    anchors = postings.join(lists.select("window", rarest.alias("term"), others.alias("others")), "term")
    anchors = anchors.select("row", "window", F.col("place").alias("at"), "others")
    block = F.floor(F.col("place") / width).alias("block")
    open_lists = anchors.select("row", "window", "at", F.explode("others").alias("term"))
    open_lists = open_lists.withColumn("block", F.explode(F.sequence(F.floor((F.col("at") - width + 1) / width),
                                                                     F.floor((F.col("at") + width - 1) / width))))
    met = (open_lists.join(postings.select("row", "place", "term", block), ["row", "term", "block"])
           .where(F.abs(F.col("place") - F.col("at")) < width))
    around = met.groupBy("row", "window", "at").agg(F.collect_list(F.struct("place", "term")).alias("around"))  # below 2 * width
    none = F.array().cast("array<struct<place:int,term:long>>")
    around = anchors.join(around, ["row", "window", "at"], "left").withColumn("around", F.coalesce("around", none))

    def stretch(s: Column) -> Column:
        nearest = F.transform("others", lambda t: F.array_min(F.transform(
            F.filter("around", lambda p: (p["term"] == t) & (p["place"] >= s)), lambda p: p["place"])))
        missing = F.exists(nearest, lambda p: p.isNull())
        last = F.greatest(F.col("at"), F.coalesce(F.array_max(nearest), F.col("at")))
        return F.when(~missing, F.struct((last - s).alias("span"), s.alias("first"), last.alias("last")))

    begins = F.concat(F.array("at"), F.transform(F.filter("around", lambda p: p["place"] < F.col("at")), lambda p: p["place"]))
    best = around.withColumn("best", F.array_min(F.transform(begins, stretch))).where(F.col("best.span") < width)
    return best.select("row", "window", "at", "best.first", "best.last")


# --------------------------------------------------------------------------- verdicts
def verdicts(index: DataFrame, named: DataFrame, matches: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, items`` (names, sorted as strings) of every row."""
    places = F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("place")
    hits = matches.select("row", places).distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    items = (matches.select("row", "window").distinct().join(named, "window").select("row", "item").distinct()
             .groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items")))
    rows = index.where(F.col("term") == END).select("row", "doc_id", F.col("place").cast("long").alias("n_words"))
    out = rows.join(hits.join(items, "row"), "row", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """``doc_id, n_words, n_hit, items`` of every document: words inside exact
    occurrences of the items' windows of ``size`` words."""
    windows, named = item_windows(items, size)
    vocab = vocabulary(windows)
    index = build_index(docs, vocab)
    return verdicts(index, named, phrase_matches(index, ranked_lists(windows, vocab, index)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), g AS (
  SELECT row_no, i, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT row_no, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM d, (SELECT DISTINCT size FROM win) WHERE len(w) >= size)
), m AS (
  SELECT row_no, i, g.size, item FROM g JOIN win ON g.phrase = win.phrase AND g.size = win.size
), h AS (
  SELECT row_no, count(DISTINCT p) AS n_hit FROM (SELECT row_no, unnest(range(i, i + size)) AS p FROM m) GROUP BY row_no
), n AS (
  SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row_no, item FROM m) GROUP BY row_no
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (row_no) LEFT JOIN n USING (row_no)
"""

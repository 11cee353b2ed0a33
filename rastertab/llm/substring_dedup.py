"""Substring dedup by suffix automata: words covered by a window of words that
also starts earlier are removed.

The passages that may repeat (see ``passages``) meet in shards.  A shard's
reference automaton holds every passage read so far; the next passage is
streamed through it word by word, the longest suffix of what was read that the
reference already holds is its matching statistic, and where that reaches the
threshold the span of the window is removed.  Spans that touch are joined, so
maximal spans go.  The threshold counts on the input, not on what is left.

Automata are not sent to all documents: as many automata as the corpus has
shards would each have to meet all documents.  Instead each document's
candidate passages are sent to the one automaton that can hold their match.

Defined results: null, empty and word-less texts have no words and lose none;
rows that share an id stand in the order of a hash of their texts, identical
rows remove nothing from each other; rows without id come after all others; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertab.llm.common import read
from rastertab.llm.passages import Scheme, Words, merged, remove_repeats


class Automaton:
    """Suffix automaton of several strings, extended symbol by symbol."""

    def __init__(self):
        self.link, self.length, self.next = [-1], [0], [{}]

    def read(self, symbols: list[int]) -> list[int]:
        """Add a string; for each of its ends, the length of the longest
        suffix that was there before (elsewhere, or ending earlier in it)."""
        link, length, follow = self.link, self.length, self.next
        last, matched = 0, []
        for symbol in symbols:
            target = follow[last].get(symbol)
            if target is not None:  # all of the string so far was there
                if length[target] != length[last] + 1:
                    target = self._split(last, symbol, target)
                last = target
                matched.append(length[last])
                continue
            new = len(link)
            link.append(0)
            length.append(length[last] + 1)
            follow.append({})
            state = last
            while state >= 0 and symbol not in follow[state]:
                follow[state][symbol] = new
                state = link[state]
            if state >= 0:
                target = follow[state][symbol]
                link[new] = target if length[target] == length[state] + 1 else self._split(state, symbol, target)
            matched.append(length[link[new]])
            last = new
        return matched

    def _split(self, state: int, symbol: int, target: int) -> int:
        link, length, follow = self.link, self.length, self.next
        clone = len(link)
        link.append(link[target])
        length.append(length[state] + 1)
        follow.append(dict(follow[target]))
        link[target] = clone
        while state >= 0 and follow[state].get(symbol) == target:
            follow[state][symbol] = clone
            state = link[state]
        return clone


class Decide:
    def __init__(self, window: int):
        self.window = window

    def __call__(self, contents: list[bytes], ids: np.ndarray) -> list[list[tuple[int, int]]]:
        automaton, numbers, out = Automaton(), {}, []
        for content in contents:
            words = [numbers.setdefault(w, len(numbers)) for w in content.split(b" ")]
            matched = automaton.read(words)
            out.append(merged([(end + 1 - self.window, end + 1) for end, n in enumerate(matched) if n >= self.window]))
        return out


def dedup_substrings(docs: DataFrame, window: int = 20, gram: int = 8) -> DataFrame:
    """All columns of ``docs``, then ``n_symbols`` (words), ``removed`` (spans
    of words), ``kept`` (kept words joined by one space, as bytes)."""
    scheme = Scheme(symbols=Words(), window=window, gram=min(gram, window), by_document=False, stretch=256)
    return remove_repeats(docs, scheme, Decide(window), shard_bytes=4 << 20)  # an automaton needs much memory per word


def removed_symbols() -> Column:
    return F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("n_symbols").alias("n_words"), removed_symbols().alias("n_removed"),
                        F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), g AS (
  SELECT row_no, doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
  FROM (SELECT row_no, doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)
), e AS (
  SELECT row_no, i FROM (SELECT *, min(row(coalesce(doc_id, 9223372036854775807), i)) OVER (PARTITION BY s) AS m FROM g)
  WHERE m < row(coalesce(doc_id, 9223372036854775807), i)
), c AS (
  SELECT row_no, list(DISTINCT j) AS gone FROM (SELECT row_no, unnest(range(i, i + 20)) AS j FROM e) GROUP BY row_no
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, k: gone IS NULL OR NOT list_contains(gone, k)), ' ')) AS kept_sha256
FROM d LEFT JOIN c USING (row_no)
"""

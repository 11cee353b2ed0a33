"""Toxicity by the nearest labelled examples.

Examples are a bounded sample of the labelled documents (``per_class`` of each
label, by a hash of the id, of those with texts up to ``example_chars``).  Terms
are all character 4- and 5-grams of the examples' words (with marks at both
ends), weighted by idf and by how far their presence tells the labels apart; a
term that tells nothing keeps a small weight (``LEAST``), none is dropped.  Of
near copies among the examples (five-word shingles, a similarity of 0.8 or more,
compared exactly) the first is compared; idf counts all of them.  Each
document is compared with the examples by exact TF-IDF cosine, through an
inverted index cut into blocks of examples: lists of the rarer terms are added
up, frequent terms stand in blocks of a dense array; the largest weight of each
frequent term in each block bounds what the block can hold, blocks are opened
from the highest bound down for the documents that need them, and
the search ends when the next bound is below the k-th best.  The neighbours
vote by their closeness; votes become chances by a logistic curve fitted on
the examples' own left-out votes, weighted to the labels' shares of all labelled rows.

One task fits the model from the bounded sample and writes it to the shared
folder; the scoring workers load it from there once each.  The driver holds two
counts and a path.  Documents are scored a batch at a time, whatever their
length: a very long text needs some twenty bytes a character and those of its
own terms.  Terms are told apart by 64-bit hashes.

Defined results: null, empty and term-less texts have no neighbours and score
as the examples without terms do; rows without id are scored and count as not
held out; an id labelled both ways counts as toxic, and of the texts that share
an id the least is the example; repeated rows score alike; equal cosines go to
the example of the smaller place; without labelled examples of both labels
every score is the share of toxic labels (0 without any); an empty table gives
an empty result.  Input columns called ``toxic_score, toxic_predicted,
toxic_evidence`` (any case) are replaced, other columns stay.
"""

from __future__ import annotations

import contextlib
import ctypes
import math
import pickle
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertab.llm.common import read
from rastertab.session import scratch_path
from rastertab.sources.files import open_input, open_output

_WORD = re.compile(r"[^\W\d_]+")
SIZES = (4, 5)
LEAST = 0.05  # weight of a term that tells nothing


def held_out(doc_id: Column) -> Column:
    """The fold whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


# --------------------------------------------------------------------------- terms
_SIDE = np.array([1, 2], np.uint64)  # marks at both ends of a word; no letter has these numbers
_TIMES = np.uint64(0x9E3779B97F4A7C15)
_letters: list[np.ndarray] = []


def _is_letter(points: np.ndarray) -> np.ndarray:
    """Whether each code point is one of ``[^\\W\\d_]``, by a table made once."""
    if not _letters:
        _letters.append(np.array([bool(_WORD.match(chr(i))) for i in range(1 << 16)]))
    out = _letters[0][np.minimum(points, 0xFFFF)]
    for i in np.unique(points[points > 0xFFFF]).tolist():
        out[points == i] = bool(_WORD.match(chr(i)))
    return out


def gram_keys(texts: list[str | None], window: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, 64-bit hash) of every 4- and 5-gram of every word of
    some texts, a window of places at a time."""
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _is_letter(points)
    before = np.concatenate([[False], letter[:-1]]) if len(letter) else letter
    first = np.flatnonzero(letter & ~before)  # of each word
    if not len(first):
        return
    last = np.flatnonzero(letter & ~np.append(letter[1:], False))
    size = last - first + 3  # with its marks
    begin = np.cumsum(size) - size
    symbols = np.empty(int(size.sum()), np.uint64)
    word = np.repeat(np.arange(len(first), dtype=np.int32), size)
    inside = np.ones(len(symbols), bool)
    inside[begin] = inside[begin + size - 1] = False
    symbols[inside] = points[letter]
    symbols[begin], symbols[begin + size - 1] = _SIDE
    ends = np.cumsum([len(t) + 1 for t in lowered])
    text = np.searchsorted(ends, first, side="right").astype(np.int64)  # of each word
    for low in range(0, len(symbols), window):
        own, of = symbols[low:low + window + max(SIZES) - 1], word[low:low + window + max(SIZES) - 1]
        key = own.copy()
        for n in range(2, max(SIZES) + 1):
            key = key[:-1] * _TIMES + own[n - 1:] if len(key) > 1 else key[:0]
            if n in SIZES:
                m = min(len(key), window)
                good = of[:m] == of[n - 1:n - 1 + m]
                mixed = key[:m][good] + np.uint64(n)
                yield text[of[:m][good]], (mixed ^ (mixed >> np.uint64(29))) * _TIMES


def _shingles(text: str, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles."""
    words = text.lower().split()
    some = {" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}
    return np.unique(np.array([xxhash.xxh64_intdigest(one.encode("utf-8", "surrogatepass")) for one in some], np.uint64))


def first_of_copies(examples: list[tuple[int, str, int]], size: int = 5, similarity: float = 0.8) -> list[tuple[int, str, int]]:
    """Examples without near copies of earlier kept ones of their label: a text
    that was copied often must not make its own rare words look telling, nor
    fill a vote with itself.  Sets this similar share one of their smallest
    hashes (the fifth of them that the similarity leaves out), which finds the
    pairs; all their hashes decide."""
    holders: dict[tuple[int, int], list[int]] = {}
    out, sets = [], []
    for row in examples:
        own = _shingles(row[1], size)
        first = own[:len(own) - math.ceil(similarity * len(own)) + 1].tolist()
        met = {i for one in first for i in holders.get((row[2], one), ())}
        for i in met:
            n = len(np.intersect1d(own, sets[i], assume_unique=True))
            if n >= similarity * (len(own) + len(sets[i]) - n):
                break
        else:
            for one in first:
                holders.setdefault((row[2], one), []).append(len(out))
            out.append(row)
            sets.append(own)
    return out


Vector = tuple[np.ndarray, np.ndarray]  # terms, weights


class Terms:
    """Counts of known terms (sorted 64-bit hashes) in texts, by an open table."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.bits = keys, max(8, int(len(keys)).bit_length() + 2)
        self.table = np.full(1 << self.bits, -1, np.int32)
        left, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(left):
            free = self.table[slot] < 0
            self.table[slot[free]] = left[free]
            again = self.table[slot] != left
            left, slot = left[again], (slot[again] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def ids(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 for unknown ones."""
        slot = self._slot(keys)
        out = self.table[slot]
        open_ = np.flatnonzero(out >= 0)
        open_ = open_[self.keys[out[open_]] != keys[open_]]
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            out[open_] = found = self.table[slot[open_]]
            open_ = open_[found >= 0]
            open_ = open_[self.keys[out[open_]] != keys[open_]]
        return out

    def many(self, texts: list[str | None]) -> list[Vector]:
        """Terms and how often they stand in each text."""
        out, low = [], 0
        while low < len(texts):
            high, chars = low + 1, len(texts[low] or "")
            while high < len(texts) and chars + len(texts[high] or "") <= 1 << 18:
                chars += len(texts[high] or "")
                high += 1
            out += self._some(texts[low:high])
            low = high
        return out

    def _some(self, texts: list[str | None]) -> list[Vector]:
        places, times = np.empty(0, np.int64), np.empty(0, np.int64)
        for text, keys in gram_keys(texts):
            ids = self.ids(keys)
            known = ids >= 0
            both = text[known] << 32 | ids[known]
            both.sort()
            heads = np.flatnonzero(np.diff(both, prepend=-1))
            places = np.concatenate([places, both[heads]])
            times = np.concatenate([times, np.diff(heads, append=len(both))])
        order = np.argsort(places, kind="stable")
        places, times = places[order], times[order]
        heads = np.flatnonzero(np.diff(places, prepend=-1))
        times = np.add.reduceat(times, heads).astype(float) if len(heads) else times.astype(float)
        places = places[heads]
        cuts = np.searchsorted(places, np.arange(1, len(texts)) << 32)
        return list(zip(np.split((places & 0xFFFFFFFF).astype(np.int32), cuts), np.split(times, cuts)))


class BlockMaxIndex:
    """Exact top-k cosine over postings cut into blocks of examples, for weights
    that are not negative.  Terms in
    more than ``frequent`` of the examples (``most`` at most) stand in a dense
    array of single precision, which is not sent but made where it is used; the
    examples it leaves in question are compared again in double precision."""

    def __init__(self, vectors: list[dict[int, float] | Vector], n_terms: int, block: int = 64, frequent: float = 0.05, most: int = 8192):
        pairs = [(np.array(list(v), np.int32), np.array(list(v.values()), float)) if isinstance(v, dict) else v for v in vectors]
        self.block, self.n, self.n_terms = block, len(pairs), n_terms
        self.n_blocks = max(1, -(-self.n // block))
        sizes = [len(t) for t, _ in pairs]
        terms = np.concatenate([np.empty(0, np.int32), *(t for t, _ in pairs)]).astype(np.int32)
        weights = np.concatenate([np.empty(0), *(w for _, w in pairs)])
        df = np.bincount(terms, minlength=n_terms)
        often = np.argsort(-df, kind="stable")[:most]
        often = often[df[often] > frequent * self.n]
        self.column = np.full(n_terms, -1, np.int32)  # of each frequent term
        self.column[often] = np.arange(len(often))
        example, at = np.repeat(np.arange(self.n, dtype=np.int32), sizes), self.column[terms]
        heavy, rare = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        self.heavy_begin = np.searchsorted(example[heavy], np.arange(self.n + 1))
        self.heavy_column, self.heavy_weight = at[heavy].astype(np.min_scalar_type(len(often))), weights[heavy]
        rare = rare[np.argsort(terms[rare], kind="stable")]
        self.post_example, self.post_weight = example[rare].astype(np.min_scalar_type(self.n)), weights[rare]
        self.post_begin = np.searchsorted(terms[rare], np.arange(n_terms + 1))
        self._dense = self._maxima = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_dense": None, "_maxima": None}

    def _make(self) -> None:
        width = int(self.column.max(initial=-1)) + 1
        self._dense = np.zeros((self.n_blocks * self.block, width), np.float32)
        for i in range(self.n):
            lo, hi = self.heavy_begin[i], self.heavy_begin[i + 1]
            self._dense[i, self.heavy_column[lo:hi]] = self.heavy_weight[lo:hi]
        self._maxima = self._dense.reshape(self.n_blocks, self.block, width).max(axis=1)

    def _rare(self, queries: list[Vector], together: int = 1 << 18, part: int = 1 << 16) -> np.ndarray:
        """Sums over rare terms, for each query and example.  Queries (up to
        ``together`` terms) go through the lists in the order of the lists, a
        part of them at a time: what one query read is at hand for the next."""
        sums, first = np.zeros((len(queries), self.n_blocks * self.block)), 0
        while first < len(queries):
            last, held = first + 1, len(queries[first][0])
            while last < len(queries) and held + len(queries[last][0]) <= together:
                held += len(queries[last][0])
                last += 1
            some, own = queries[first:last], sums[first:last].reshape(-1)
            first = last
            terms, weights = (np.concatenate(one) for one in zip(*some))
            row = np.repeat(np.arange(len(some)) * sums.shape[1], [len(t) for t, _ in some])
            order = np.argsort(terms, kind="stable")
            terms, weights, row = terms[order], weights[order], row[order]
            n = self.post_begin[terms + 1] - self.post_begin[terms]
            ends = np.cumsum(n)
            low = self.post_begin[terms] - ends + n
            cuts = np.searchsorted(ends, np.arange(0, ends[-1] if len(ends) else 0, part))
            cuts = np.unique(np.append(cuts, len(n))).tolist()
            for i, j in zip(cuts, cuts[1:]):
                at = np.repeat(low[i:j], n[i:j])
                at += np.arange(ends[i] - n[i], ends[j - 1])
                parts = np.repeat(weights[i:j], n[i:j])
                parts *= self.post_weight.take(at)
                place = np.repeat(row[i:j], n[i:j])
                place += self.post_example.take(at)
                np.add.at(own, place, parts)
        return sums

    def search(self, query: dict[int, float] | Vector, k: int, without: int = -1) -> list[tuple[float, int]]:
        """(cosine, example) of the k nearest with a positive cosine, ties to the smaller example."""
        return self.search_many([query], k, [without])[0]

    def search_many(self, queries: list, k: int, without: list[int] | None = None, ahead: int = 2) -> list[list[tuple[float, int]]]:
        """Each query opens the ``ahead`` blocks of its own highest bounds first:
        what it finds there closes more of the others."""
        if self._dense is None:
            self._make()
        queries = [(np.array(list(q), np.int32), np.array(list(q.values()), float)) if isinstance(q, dict) else q for q in queries]
        width, block = self._dense.shape[1], self.block
        # sums of parts that are not negative, in single precision, are off by this share of themselves at most
        sure = 1 - 2 * (width + 8) * 2.0 ** -23
        heavy, frequent, others = np.zeros((len(queries), width), np.float32), [], []
        for r, (terms, weights) in enumerate(queries):
            at = self.column[terms]
            often = at >= 0
            frequent.append((at[often], weights[often]))
            heavy[r, frequent[r][0]] = frequent[r][1]
            others.append((terms[~often], weights[~often]))
        rare = self._rare(others)
        scores = rare.astype(np.float32)
        bounds = heavy @ self._maxima.T + rare.reshape(len(queries), self.n_blocks, block).max(axis=2)
        early = np.zeros(bounds.shape, bool)
        np.put_along_axis(early, np.argsort(-bounds, axis=1, kind="stable")[:, :ahead], True, axis=1)
        best, held = np.zeros((len(queries), k)), np.empty_like(heavy)
        order = np.argsort(-bounds.sum(axis=0), kind="stable").tolist()
        for b, first in [(b, True) for b in order] + [(b, False) for b in order]:
            opened, own = early[:, b], slice(b * block, (b + 1) * block)
            if not first:
                opened = ~opened & (bounds[:, b] >= best[:, 0] * sure)
                scores[~opened & ~early[:, b], own] = 0
            rows = np.flatnonzero(opened)
            if len(rows):
                some = np.take(heavy, rows, axis=0, out=held[:len(rows)], mode="clip") if len(rows) < len(queries) else heavy
                found = scores[rows, own] + some @ self._dense[own].T
                for j, r in enumerate(rows.tolist()) if without is not None else ():
                    if 0 <= without[r] - b * block < block:
                        found[j, without[r] - b * block] = 0
                scores[rows, own] = found
                best[rows] = np.sort(np.partition(np.concatenate([best[rows], found], axis=1), block, axis=1)[:, block:], axis=1)
        out, whole = [], np.zeros(width)
        for r, (at, weights) in enumerate(frequent):
            whole[at] = weights
            near = []
            for i in np.flatnonzero((scores[r] > 0) & (scores[r] >= best[r, 0] * sure)).tolist():
                lo, hi = self.heavy_begin[i], self.heavy_begin[i + 1]
                near.append((-float(rare[r, i] + whole.take(self.heavy_column[lo:hi]) @ self.heavy_weight[lo:hi]), i))
            whole[at] = 0
            out.append([(-s, i) for s, i in sorted(near)[:k]])
        return out


class ToxicityModel:
    def __init__(self, examples: list[tuple[int, str, int]], labelled: dict[int, int], k: int = 16):
        self.k, self.base = k, labelled.get(1, 0) / max(1, sum(labelled.values()))
        every, examples = examples, first_of_copies(examples)
        n = Counter(y for _, _, y in examples)
        self.ready = bool(n[0] and n[1])
        if not self.ready:
            return
        self.share = {y: labelled[y] / n[y] for y in (0, 1)}  # labelled rows that an example stands for
        texts, first = [t for _, t, _ in every], {i for i, _, _ in examples}
        found = [np.empty(0, np.uint64)]
        for low in range(0, len(texts), 64):
            found.append(np.unique(np.concatenate([np.empty(0, np.uint64), *(keys for _, keys in gram_keys(texts[low:low + 64]))])))
        self.terms = np.unique(np.concatenate(found))
        del found
        counter = Terms(self.terms)
        df, seen, counts = np.zeros(len(self.terms)), np.zeros((2, len(self.terms))), []
        for (i, _, y), own in zip(every, counter.many(texts)):
            df[own[0]] += 1
            if i in first:
                seen[y, own[0]] += 1
                counts.append(own)
        self.weight = np.log(1 + len(every) / np.maximum(df, 1)) * self._telling(seen, n)
        vectors = [self._vector(c) for c in counts]
        del counts
        order = self._order(vectors)
        self.ids, self.labels = [examples[i][0] for i in order], [examples[i][2] for i in order]
        vectors = [vectors[i] for i in order]
        self.index = BlockMaxIndex(vectors, len(self.terms) or 1)
        left_out = []
        for at in range(0, len(vectors), 256):
            some = range(at, min(at + 256, len(vectors)))
            left_out += [self._vote(near) for near in self.index.search_many([vectors[i] for i in some], k, list(some))]
        self._fit_curve(np.array(left_out), np.array(self.labels))
        self.index = BlockMaxIndex(vectors, len(self.terms) or 1)  # without what the search made

    def state(self) -> dict:
        """Plain values to write; the dense part is made where it is used."""
        return {**vars(self), "index": self.index.__getstate__()} if self.ready else dict(vars(self))

    @staticmethod
    def from_state(state: dict) -> ToxicityModel:
        model = ToxicityModel.__new__(ToxicityModel)
        model.__dict__.update(state)
        if model.ready:
            model.index = BlockMaxIndex.__new__(BlockMaxIndex)
            model.index.__dict__.update(state["index"])
        return model

    def _order(self, vectors: list[Vector], directions: int = 5, rounds: int = 6) -> list[int]:
        """An order in which like examples stand together, so that blocks differ
        in what they can hold: by the side on which each lies along the main
        directions of all (power steps from a fixed start), then along the last."""
        terms = np.concatenate([np.empty(0, np.int32), *(t for t, _ in vectors)])
        weights = np.concatenate([np.empty(0), *(w for _, w in vectors)])
        row = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        mean = np.bincount(terms, weights, len(self.terms)) / len(vectors)
        basis = np.linalg.qr(np.random.default_rng(0).normal(size=(len(self.terms), directions)))[0]

        def along(v: np.ndarray) -> np.ndarray:
            return np.stack([np.bincount(row, weights * v[terms, j], len(vectors)) - mean @ v[:, j] for j in range(directions)], axis=1)

        for _ in range(rounds):
            u = along(basis)
            basis = np.stack([np.bincount(terms, weights * u[row, j], len(self.terms)) - mean * u[:, j].sum() for j in range(directions)], axis=1)
            basis = np.linalg.qr(basis)[0]
        u = along(basis)
        side = (u[:, :-1] > 0) @ (1 << np.arange(directions - 1)[::-1])
        return np.lexsort((u[:, -1], side)).tolist()

    @staticmethod
    def _telling(seen: np.ndarray, n) -> np.ndarray:
        """How far a term's presence tells the labels apart, from ``LEAST`` to 1:
        chi-square over what the most telling of as many terms reaches by chance."""
        (b, a), total = seen, n[0] + n[1]
        rest = (a + b) * (total - a - b)
        chi = np.divide(total * (a * n[0] - b * n[1]) ** 2, n[1] * n[0] * rest, out=np.zeros(len(a)), where=rest > 0)
        return np.clip(chi / (2 * math.log(2 + len(a))), LEAST, 1)

    def _vector(self, counts: Vector) -> Vector:
        terms, n = counts
        w = (1 + np.log(n)) * self.weight[terms]
        norm = math.sqrt(float(w @ w))
        return (terms, w / norm) if norm else (terms[:0], w[:0])

    def _vote(self, near: list[tuple[float, int]]) -> float:
        """Log odds of the votes; each neighbour counts for the labelled rows
        it stands for, by its cosine over its distance, against a small prior."""
        votes = {0: 0.5 * (1 - self.base) + 1e-6, 1: 0.5 * self.base + 1e-6}
        for cosine, i in near:
            votes[self.labels[i]] += self.share[self.labels[i]] * cosine / (1.05 - min(1.0, cosine))
        return math.log(votes[1] / votes[0])

    def _fit_curve(self, x: np.ndarray, y: np.ndarray) -> None:
        weight = np.where(y == 1, self.share[1], self.share[0])
        weight, self.curve = weight / weight.sum(), np.zeros(2)
        design = np.stack([x, np.ones(len(x))], axis=1)
        for _ in range(50):  # Newton steps with a small ridge
            p = 1 / (1 + np.exp(-np.clip(design @ self.curve, -30, 30)))
            slope = design.T @ (weight * (p - y)) + 1e-4 * self.curve
            bend = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-4 * np.eye(2)
            self.curve -= np.linalg.solve(bend, slope)

    def score(self, counter: Terms, texts: list[str | None]) -> list[tuple[float, list[tuple[float, int]]]]:
        near = self.index.search_many([self._vector(c) for c in counter.many(texts)], self.k)
        return [(float(1 / (1 + math.exp(-max(-30.0, min(30.0, self.curve[0] * self._vote(x) + self.curve[1]))))), x) for x in near]


def _examples(docs: DataFrame, labels: DataFrame, per_class: int, example_chars: int) -> tuple[DataFrame, dict[int, int]]:
    """``doc_id, text, toxic`` of at most ``2 * per_class`` examples outside the
    held-out fold, and the number of labelled documents of each label."""
    own = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    labelled = {r["toxic"]: r["n"] for r in own.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    short = docs.where(F.length("text") <= example_chars)
    present = own.join(short.select("doc_id"), "doc_id", "left_semi")  # ids only
    chosen = None
    for y in (0, 1):
        some = present.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = short.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most 2 * per_class ids
    return texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), labelled


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 2048, example_chars: int = 20_000) -> tuple[str | None, float]:
    """Fit in one task, from at most ``2 * per_class`` examples; gives the path
    of the written model (None without examples) and the share of toxic labels."""
    texts, labelled = _examples(docs, labels, per_class, example_chars)
    folder = scratch_path(docs.sparkSession, "toxicity-model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for b in batches for row in zip(*(b.column(i).to_pylist() for i in range(3)))]
        if rows:
            path = f"{folder}/{uuid.uuid4().hex}"  # a repeated task writes another; the one it reports counts
            model = ToxicityModel(sorted(rows), labelled)
            with open_output(path) as out:
                pickle.dump(model.state(), out, protocol=5)
            del model, rows
            hand_back()
            yield pa.RecordBatch.from_arrays([pa.array([path])], names=["path"])

    made = texts.select("doc_id", "text", "toxic").repartition(1).mapInArrow(run, "path string").collect()  # one row
    return (made[0]["path"] if made else None), labelled.get(1, 0) / max(1, sum(labelled.values()))


def hand_back() -> None:
    """Give freed memory back to the system, where the C library can."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


_loaded: dict[str, ToxicityModel] = {}


def load_model(path: str) -> ToxicityModel:
    """The model at ``path``, read once per worker process."""
    if path not in _loaded:
        _loaded.clear()
        with open_input(path) as source:
            _loaded[path] = ToxicityModel.from_state(pickle.loads(source.read()))
    return _loaded[path]


def score_toxicity(docs: DataFrame, labels: DataFrame, examples_from: DataFrame | None = None, threshold: float = 0.7) -> DataFrame:
    """Add ``toxic_score, toxic_predicted, toxic_evidence`` (nearest examples:
    id, cosine, label).  ``examples_from`` holds the labelled documents' texts
    when they are not in ``docs``."""
    path, base = learn(docs if examples_from is None else examples_from, labels)
    made = ("toxic_score", "toxic_predicted", "toxic_evidence")
    kept = docs.drop(*made)
    at = [c.lower() for c in kept.columns].index("text")
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(path) if path else None
        ready = model is not None and model.ready
        counter = Terms(model.terms) if ready else None
        for b in batches:
            scores, why = [], []
            texts = b.column(at).to_pylist()
            for low in range(0, len(texts), 256):
                some = texts[low:low + 256]
                for s, near in model.score(counter, some) if ready else [(base, [])] * len(some):
                    scores.append(s)
                    why.append([{"doc_id": model.ids[i], "cosine": c, "toxic": model.labels[i]} for c, i in near[:3]])
            predicted = pa.array([int(s >= threshold) for s in scores], pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64()), predicted, pa.array(why, evidence)],
                                             names=[*b.schema.names, *made])
        hand_back()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(score, f"{fields}, toxic_score double, toxic_predicted int, "
                                  "toxic_evidence array<struct<doc_id:long,cosine:double,toxic:int>>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    return score_toxicity(docs, labels).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxic_score").alias("score"),
        F.col("toxic_predicted").alias("predicted"), F.col("toxic_evidence").alias("evidence"))

"""Where windows of documents may repeat, and what becomes of them: the
exchange that the substring operators share.

A window is ``window`` consecutive symbols (words or bytes) of one document.
Every window has an anchor, the ``gram``-symbol string in it with the smallest
hash, so equal windows have equal anchors, and neighbouring windows mostly
share theirs.  Documents are dealt into chunks of a few MB, then

1. each chunk sends its distinct anchors (hash, first place, bytes of the
   distinct contexts it has there) to buckets by hash;
2. each bucket finds anchors that occur more than once and answers each chunk
   with a passage key: the stretch of the document where the anchor stands
   first; where the contexts of a stretch's anchors may exceed a shard, a key of
   the anchor's own; and where the anchor's contexts alone are a large part of a
   shard, or very many chunks hold it, the mark "by window";
3. each chunk cuts out the passages whose windows have such anchors, joins
   neighbours with one key, and sends each distinct passage once to a shard by
   key (windows marked "by window" each go by their own hash, so that a passage
   which a third of all documents share, or the different contexts of a line
   that they share, are spread over shards);
4. each shard decides exactly, on the symbols themselves, which windows stand
   earlier elsewhere (a suffix automaton or a suffix array) and answers;
5. each chunk applies the answers to its documents.

Hashes only decide which passages meet; equal windows always meet.  The chunks
are one shuffle that all three passes over them read.  A chunk sends equal
anchors and equal passages once, whatever the size of a group of copies.

Rows are compared by (doc_id, hash of the text, start): rows that share an id
stand in the order of that hash, identical rows never come before each other.
Rows without id come last.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastertab.llm.common import shuffle_width
from rastertab.llm.tokens import forget_encoders

NO_ID = np.iinfo(np.int64).max
_U = np.uint64


# -- arrays in binary columns -------------------------------------------------

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays byte plane by byte plane, so that the shuffle's codec sees runs."""
    out = [struct.pack("<B", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        out.append(struct.pack("<2sq", a.dtype.str[1:].encode(), len(a)))
        out.append(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b"")
    return b"".join(out)


def unpack(blob: bytes) -> list[np.ndarray]:
    out, at = [], 1
    for _ in range(blob[0]):
        kind, n = struct.unpack_from("<2sq", blob, at)
        kind, at = np.dtype("<" + kind.decode()), at + 10
        planes = np.frombuffer(blob, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n) if n else np.empty(0, kind))
        at += n * kind.itemsize
    return out


# -- hashing ------------------------------------------------------------------

def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def _slide(a: np.ndarray, width: int, least: Callable) -> np.ndarray:
    """Minimum or maximum of every ``width`` consecutive values, by doubling."""
    have = 1
    while 2 * have <= width:
        a, have = least(a[:-have], a[have:]), 2 * have
    return least(a[:have - width], a[width - have:]) if have < width else a


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one integer (zeros past the end)."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    out = np.empty(len(data), _U)
    for o in range(min(8, len(data))):
        n = len(out[o::8])
        out[o::8] = padded[o:o + 8 * n].view("<u8")
    return out


# -- symbols ------------------------------------------------------------------

class Bytes:
    """Symbols are the bytes of the text in UTF-8."""

    def normal(self, text: bytes) -> bytes:
        return text

    def join(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """data, first symbol of each text, first and end byte of each symbol."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        places = np.arange(len(data) + 1, dtype=np.int64)
        return data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64), places, places[1:]

    def grams(self, data: np.ndarray, places: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
        eight, n = _eights(data), len(data) - size + 1
        h = eight[:n] * _U(0x9E3779B97F4A7C15)
        for at in range(8, size, 8):
            at = min(at, size - 8)
            h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9) + eight[at:at + n] * _U(0x94D049BB133111EB)
        return _mix(h)


class Words:
    """Symbols are words, kept joined by one space."""

    def normal(self, text: bytes) -> bytes:
        return b" ".join(text.split())

    def join(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        data = np.frombuffer(b" ".join(t for t in texts if t), np.uint8)
        gaps = np.flatnonzero(data == 32)
        counts = [t.count(b" ") + 1 if t else 0 for t in texts]
        places = np.concatenate([[0], gaps + 1]) if len(data) else np.empty(0, np.int64)
        ends = np.concatenate([gaps, [len(data)]]) if len(data) else np.empty(0, np.int64)
        return data, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), places, ends

    def grams(self, data: np.ndarray, places: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
        padded = np.zeros(len(data) + 16, np.uint8)
        padded[:len(data)] = data
        sizes = ends - places
        rows = np.lib.stride_tricks.sliding_window_view(padded, 8)
        word = sizes.astype(_U) * _U(0x9E3779B97F4A7C15)
        for at in (0, 8):
            eight = np.ascontiguousarray(rows[np.minimum(places + at, len(data))]).view("<u8").reshape(-1)
            left = np.clip(sizes - at, 0, 8).astype(_U)
            keep = np.where(left == 8, _U(0xFFFFFFFFFFFFFFFF), (_U(1) << (left * _U(8) % _U(64))) - _U(1))
            word = (word ^ (word >> _U(31))) * _U(0xBF58476D1CE4E5B9) + (eight & keep)
        whole = data.tobytes()
        for i in np.flatnonzero(sizes > 16).tolist():
            word[i] = _hash(whole[places[i]:ends[i]])
        word = _mix(word)
        n = len(word) - size + 1
        h = word[:n].copy()
        for at in range(1, size):
            h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9) + word[at:at + n]
        return _mix(h)


def _hash(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data)


# -- chunks -------------------------------------------------------------------

@dataclass(frozen=True)
class Scheme:
    symbols: Bytes | Words
    window: int
    gram: int
    by_document: bool  # a window counts as earlier only in a smaller document
    stretch: int  # symbols of a passage key's stretch
    hot: int = 4096  # chunks that hold an anchor before it is dealt by window


class Chunk:
    """The documents of a chunk in (id, text) order, with their anchors."""

    def __init__(self, scheme: Scheme, table: pa.Table):
        self.scheme = scheme
        ids = table.column("doc_id").cast(pa.int64())
        texts = [(t or b"") for t in table.column("text").cast(pa.binary()).to_pylist()]
        keys = [(NO_ID if i is None else i, _hash(t) >> 1) for i, t in zip(ids.to_pylist(), texts)]
        self.rows = sorted(range(len(keys)), key=lambda r: (keys[r], texts[r]))
        self.ids, self.ties = (np.array([keys[r][k] for r in self.rows], dtype=np.int64) for k in (0, 1))
        self.texts = [scheme.symbols.normal(texts[r]) for r in self.rows]
        self.data, self.begin, self.places, self.ends = scheme.symbols.join(self.texts)
        self._anchors()

    def place(self, doc: int, start: int) -> tuple[int, int, int]:
        return int(self.ids[doc]), int(self.ties[doc]), start

    def _anchors(self) -> None:
        s, total = self.scheme, int(self.begin[-1])
        width = s.window - s.gram + 1
        if total < s.window:
            self.at, self.low, self.high, hashes = (np.empty(0, np.int64),) * 3 + (np.empty(0, _U),)
        else:
            grams = s.symbols.grams(self.data, self.places, self.ends, s.gram)
            least = _slide(grams, width, np.minimum)
            inside = np.zeros(len(least) + 1, np.int32)
            start, end = self.begin[:-1], self.begin[1:]
            long_enough = end - start >= s.window
            np.add.at(inside, start[long_enough], 1)
            np.add.at(inside, end[long_enough] - s.window + 1, -1)
            least = np.where(np.cumsum(inside)[:-1] > 0, least, _U(0))  # no window crosses documents
            edge = np.zeros(width - 1, _U)
            padded = np.concatenate([edge, least, edge])
            self.at = np.flatnonzero(_slide(padded, width, np.maximum) == grams)
            hashes = grams[self.at]
            self._least, self._width, self._grams = least, width, grams
        _, first, inverse, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        order = np.argsort(first, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.entry = rank[inverse.reshape(-1)]  # of each anchor: its number among the distinct ones
        self.first, self.counts = first[order], counts[order]
        self.hash = hashes[self.first]

    def buckets(self, n: int) -> Iterator[tuple[int, np.ndarray]]:
        """Numbers of the distinct anchors of each bucket, ascending."""
        bucket = ((self.hash >> _U(20)) % _U(n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for own in np.split(order, cuts):
            if len(own):
                yield int(bucket[own[0]]), own

    def anchor_blob(self, own: np.ndarray) -> bytes:
        at = self.at[self.first[own]]
        doc = np.searchsorted(self.begin, at, side="right") - 1
        docs, local = np.unique(doc, return_inverse=True)
        return pack(self.hash[own], 2 * self.load[own] + (self.counts[own] > 1), np.diff(local.reshape(-1), prepend=0).astype(np.uint32),
                    (at - self.begin[doc]).astype(np.uint32), self.ids[docs])

    def measure(self) -> None:
        """``load``: of each distinct anchor, the bytes of its distinct contexts
        (all symbols that share a window with it); contexts are told apart by
        the hashes of grams that cover them, as only sizes depend on it."""
        self.load = np.zeros(len(self.first), np.uint32)
        if not len(self.at):
            return
        doc = np.searchsorted(self.begin, self.at, side="right") - 1
        begin, end, reach = self.begin[doc], self.begin[doc + 1], self._width - 1
        low, high = np.maximum(self.at - reach, begin), np.minimum(self.at + reach + self.scheme.gram, end)
        size = self.ends[high - 1] - self.places[low]
        twice = np.flatnonzero(self.counts[self.entry] > 1)  # all others have one context
        mark = np.zeros(len(twice), _U)
        steps = -(-reach // self.scheme.gram)
        for step in range(-steps, steps + 1):
            at = np.clip(self.at[twice] + step * reach // max(1, steps), begin[twice], end[twice] - self.scheme.gram)
            mark = (mark ^ (mark >> _U(31))) * _U(0xBF58476D1CE4E5B9) + self._grams[at]
        order = np.lexsort((mark, self.entry[twice]))
        entry, mark = self.entry[twice][order], mark[order]
        new = np.ones(len(order), bool)
        new[1:] = (entry[1:] != entry[:-1]) | (mark[1:] != mark[:-1])
        once = np.ones(len(self.at), bool)
        once[twice[order[~new]]] = False
        load = np.bincount(self.entry[once], weights=size[once], minlength=len(self.first))
        self.load = np.minimum(load, 2 ** 31 - 1).astype(np.uint32)

    def passages(self, answers: list[tuple[int, bytes]], n_buckets: int) -> "Passages":
        """Passages from the buckets' answers (bucket, blob)."""
        key = np.zeros(len(self.first), _U)
        keyed = np.zeros(len(self.first), bool)
        own = dict(self.buckets(n_buckets)) if answers else {}
        for bucket, blob in answers:
            number, keys = unpack(blob)
            entries = own[bucket][number.astype(np.int64)]
            key[entries], keyed[entries] = keys, True
        at = np.flatnonzero(keyed[self.entry])  # anchors that repeat, in order of place
        return Passages(self, self.at[at], key[self.entry[at]])


class Passages:
    """Distinct passages of a chunk and where they stand."""

    def __init__(self, chunk: Chunk, at: np.ndarray, key: np.ndarray):
        s = chunk.scheme
        starts, counts, keys = [np.empty(0, np.int64)] * 2 + [np.empty(0, _U)]
        if len(at):
            width, least = chunk._width, chunk._least
            # the windows of an anchor are those around it whose smallest hash is the anchor's
            value = chunk.hash[chunk.entry[np.searchsorted(chunk.at, at)]]
            low, high = np.full(len(at), -1, np.int64), np.full(len(at), -1, np.int64)
            for back in range(width):
                w = at - width + 1 + back
                own = (w >= 0) & (w < len(least))
                own[own] = least[w[own]] == value[own]
                low = np.where(own & (low < 0), w, low)
                high = np.where(own, w, high)
            some = low >= 0
            low, high, key = low[some], high[some], key[some]
            doc = np.searchsorted(chunk.begin, low, side="right") - 1
            by_window = key == 0
            goes_on = np.zeros(len(low), bool)
            goes_on[1:] = (doc[1:] == doc[:-1]) & (key[1:] == key[:-1]) & (low[1:] <= high[:-1] + 1) & ~by_window[1:]
            head = np.flatnonzero(~goes_on)
            if len(head):
                starts, keys = low[head], key[head]
                counts = np.maximum.reduceat(high, head) - starts + 1
            lone = np.flatnonzero(keys == 0)
            if len(lone):  # one passage per window, under a key of its own
                w = np.unique(np.concatenate([np.arange(a, a + n) for a, n in zip(starts[lone], counts[lone])]))
                rest = keys != 0
                starts, counts, keys = (np.concatenate(x) for x in ((starts[rest], w), (counts[rest], np.ones(len(w), np.int64)),
                                                                    (keys[rest], np.ones(len(w), _U))))
        self.chunk, self.length = chunk, counts + s.window - 1
        doc = np.searchsorted(chunk.begin, starts, side="right") - 1
        whole, found = chunk.data.tobytes(), {}
        self.of, self.where = np.empty(len(starts), np.int64), []
        self.contents: list[bytes] = []
        self.keys: list[int] = []
        self.lone: list[bool] = []  # a window sent by its own hash
        within = starts - chunk.begin[doc] if len(starts) else starts
        order = np.lexsort((within, chunk.ties[doc], chunk.ids[doc])) if len(starts) else np.empty(0, np.int64)
        for i in order.tolist():
            a, n = int(starts[i]), int(self.length[i])
            content = whole[chunk.places[a]:chunk.ends[a + n - 1]]
            k = int(keys[i]) if keys[i] != 1 else _hash(content) | 2
            j = found.setdefault((k, content), len(self.contents))
            if j == len(self.contents):
                self.contents.append(content)
                self.keys.append(k)
                self.lone.append(bool(keys[i] == 1))
                self.where.append((int(doc[i]), int(within[i])))
            self.of[i] = j
        self.doc, self.start = doc, within

    def shards(self, n: int) -> Iterator[tuple[int, np.ndarray]]:
        shard = np.array([(k >> 17) % n for k in self.keys], dtype=np.int64)
        for one in np.unique(shard):
            yield int(one), np.flatnonzero(shard == one)

    def blob(self, own: np.ndarray) -> bytes:
        docs = np.array([self.where[j][0] for j in own], dtype=np.int64)
        contents = [self.contents[j] for j in own]
        return pack(self.chunk.ids[docs], self.chunk.ties[docs], np.array([self.where[j][1] for j in own], np.int64),
                    np.array([len(c) for c in contents], np.int64), np.array([self.lone[j] for j in own], np.uint8), np.frombuffer(b"".join(contents), np.uint8))

    def removed(self, answers: list[tuple[int, bytes]], n_shards: int) -> list[list[tuple[int, int]]]:
        """Spans (symbols from, to) to remove from each document of the chunk."""
        spans: list[list[tuple[int, int]]] = [[] for _ in self.contents]
        own = dict(self.shards(n_shards))
        for shard, blob in answers:
            number, low, high = unpack(blob)
            for j, a, b in zip(own[shard][number.astype(np.int64)].tolist(), low.tolist(), high.tolist()):
                spans[j].append((a, b))
        chunk, out = self.chunk, [[] for _ in self.chunk.ids]
        for i, j in enumerate(self.of.tolist()):
            doc, start = int(self.doc[i]), int(self.start[i])
            if later(chunk.scheme, chunk.place(doc, start), chunk.place(*self.where[j])):
                out[doc].append((start, start + int(self.length[i])))
            else:
                out[doc] += [(start + a, start + b) for a, b in spans[j]]
        return [merged(x) for x in out]


def later(scheme: Scheme, place: tuple, first: tuple) -> bool:
    """Whether all windows of a passage here also stand earlier, there."""
    return place[0] > first[0] if scheme.by_document else place > first


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


# -- the exchange -------------------------------------------------------------

def _give_back(run: Callable) -> Callable:
    """Worker processes live on between groups and jobs: let go of what earlier
    jobs keep in them, and hand the memory that a group freed back to the system."""
    def wrapped(*tables: pa.Table) -> pa.Table:
        import ctypes
        import gc

        forget_encoders()
        out = run(*tables)
        gc.collect(0)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # not every C library has it
            pass
        return out

    # Spark counts the function's parameters
    return (lambda table: wrapped(table)) if run.__code__.co_argcount == 1 else (lambda table, answers: wrapped(table, answers))


#: (distinct passage contents in the order of their first places, owners' ids)
#: -> spans of each that also stand earlier
Decide = Callable[[list[bytes], np.ndarray], list[list[tuple[int, int]]]]
_ANSWER = "chunk long, step int, part int, blob binary"


def _answers(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    cols = list(zip(*rows)) or [(), (), (), ()]
    return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()),
                     pa.array(cols[3], pa.binary())], names=["chunk", "step", "part", "blob"])


def _repeated(scheme: Scheme, table: pa.Table, shard_bytes: int) -> pa.Table:
    """Step 2: one bucket's anchors that occur more than once."""
    chunks, bucket = table.column("chunk").to_pylist(), table.column("part")[0].as_py()
    parts = []
    for row, blob in enumerate(table.column("blob").to_pylist()):
        h, load, doc, at, ids = unpack(blob)
        parts.append((h, load, ids[np.cumsum(doc)], at, np.arange(len(h), dtype=np.uint32), np.full(len(h), row, np.int32)))
    h, load, doc, at, number, row = (np.concatenate(x) for x in zip(*parts))
    del parts
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    keep = np.zeros(len(h), bool)
    keep[1:] |= same
    keep[:-1] |= same
    order = order[keep | (load[order] & 1 > 0)]
    h, load, doc, at, number, row = (x[order] for x in (h, load, doc, at, number, row))
    if not len(h):
        return _answers([])
    group = np.cumsum(np.concatenate([[False], h[1:] != h[:-1]]))
    first = np.lexsort((at, doc, group))
    head = first[np.searchsorted(group[first], np.arange(group[-1] + 1))]
    stretch = at[head].astype(_U) // _U(scheme.stretch)
    key = _mix(doc[head].view(_U) * _U(0x9E3779B97F4A7C15) + stretch) | _U(2)  # never 0 or 1
    # an anchor's bytes, and about as many anchors as a stretch has, in other buckets too
    load, around = np.bincount(group, weights=load >> np.uint32(1)), -(-2 * scheme.stretch // (scheme.window - scheme.gram + 2))
    key = np.where(load * around > shard_bytes, _mix(h[head] * _U(0xBF58476D1CE4E5B9)) | _U(2), key)
    key = np.where((np.bincount(group) > scheme.hot) | (4 * load > shard_bytes), _U(0), key)[group]
    order = np.lexsort((number, row))
    number, key, row = number[order], key[order], row[order]
    cuts = np.flatnonzero(np.diff(row)) + 1
    return _answers([(chunks[int(r[0])], 2, bucket, pack(n, k)) for n, k, r in
                     zip(np.split(number, cuts), np.split(key, cuts), np.split(row, cuts))])


def _decided(scheme: Scheme, decide: Decide, table: pa.Table) -> pa.Table:
    """Step 4: one shard's passages; equal ones are decided once, by their first
    place.  A window sent by its own hash equals no other passage's windows (they
    would have its anchor), so its first place decides it."""
    chunks, shard = table.column("chunk").to_pylist(), table.column("part")[0].as_py()
    contents: dict[bytes, int] = {}
    by_window: list[np.ndarray] = []
    parts = []
    for row, blob in enumerate(table.column("blob").to_pylist()):
        ids, ties, starts, sizes, lone, data = unpack(blob)
        by_window.append(lone)
        ends, whole = np.cumsum(sizes), data.tobytes()
        own = [contents.setdefault(whole[a:b], len(contents)) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
        parts.append((np.array(own, np.int64), ids, ties, starts, np.full(len(own), row, np.int32), np.arange(len(own))))
    del table
    kind, *place, row, number = (np.concatenate(x) for x in zip(*parts))
    del parts
    texts = list(contents)
    order = np.lexsort((*place[::-1], kind))
    head = order[np.searchsorted(kind[order], np.arange(len(texts)))]
    first = [x[head] for x in place]  # of each content: id, tie and start of its first place
    order = np.lexsort(first[::-1])
    order = order[np.concatenate(by_window)[head][order] == 0]
    found = decide([texts[k] for k in order.tolist()], first[0][order])
    spans: list = [None] * len(texts)
    for k, some in zip(order.tolist(), found):
        spans[k] = some
    beyond = np.zeros(len(kind), bool)
    for x, f in list(zip(place, first))[:1 if scheme.by_document else 3][::-1]:
        beyond = (x > f[kind]) | (x == f[kind]) & beyond
    out: dict[int, list[tuple[int, int, int]]] = {}
    for k, r, i, gone in zip(kind.tolist(), row.tolist(), number.tolist(), beyond.tolist()):
        if gone or spans[k]:
            out.setdefault(r, []).extend((i, a, b) for a, b in ([(0, _symbols(scheme, texts[k]))] if gone else spans[k]))
    return _answers([(chunks[r], 4, shard, pack(*(np.array(x, np.uint32) for x in zip(*some)))) for r, some in out.items()])


def _symbols(scheme: Scheme, content: bytes) -> int:
    return content.count(b" ") + 1 if isinstance(scheme.symbols, Words) else len(content)


def _split(answers: pa.Table, step: int) -> list[tuple[int, bytes]]:
    rows = zip(answers.column("step").to_pylist(), answers.column("part").to_pylist(), answers.column("blob").to_pylist())
    return [(part, blob) for s, part, blob in rows if s == step]


def chunk_of(n_chunks: int) -> Column:
    """Chunk of a row.  Rows that share an id are spread by their texts, identical
    rows by the input partition, which, unlike a row's place in it, stays the same
    when a task is repeated."""
    return F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(n_chunks)).cast("long")


def remove_repeats(docs: DataFrame, scheme: Scheme, decide: Decide, chunk_bytes: int = 2 << 20, part_bytes: int = 16 << 20,
                   shard_bytes: int = 8 << 20) -> DataFrame:
    """All columns of ``docs``, then ``n_symbols`` (of the text), ``removed``
    (spans of symbols) and ``kept`` (bytes of the kept symbols, words joined by
    one space).  Text per chunk, per bucket of anchors and per shard of passages
    bounds what a task holds at once."""
    made = ("n_symbols", "removed", "kept")
    docs = docs.drop(*made, "chunk")
    width = shuffle_width(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    n_chunks, n_parts, n_shards = (max(least, -(-total // size)) for least, size in (
        (2 * width, chunk_bytes), (width, part_bytes), (width, shard_bytes)))
    chunks = docs.withColumn("chunk", chunk_of(n_chunks))
    tasks = max(width, -(-n_chunks // 4))
    chunks = chunks.repartition(tasks, "chunk")  # one exchange, read by steps 1, 3 and 5

    def send_anchors(table: pa.Table) -> pa.Table:
        chunk, no = Chunk(scheme, table), table.column("chunk")[0].as_py()
        chunk.measure()
        return _answers([(no, 1, b, chunk.anchor_blob(own)) for b, own in chunk.buckets(n_parts)])

    def send_passages(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or not answers.num_rows:
            return _answers([])
        found, no = Chunk(scheme, table).passages(_split(answers, 2), n_parts), table.column("chunk")[0].as_py()
        return _answers([(no, 3, shard, found.blob(own)) for shard, own in found.shards(n_shards)])

    fields = [f for f in chunks.schema.fields if f.name != "chunk"]
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([*fields, T.StructField("n_symbols", T.LongType()), T.StructField("removed", T.ArrayType(span)),
                           T.StructField("kept", T.BinaryType())])
    arrow_span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def apply(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(scheme, table)
        spans = chunk.passages(_split(answers, 2), n_parts).removed(_split(answers, 4), n_shards) if answers.num_rows else [[]] * len(chunk.ids)
        table = table.take(pa.array(chunk.rows, pa.int64())).drop_columns(["chunk"])
        kept, counts, whole = [], np.diff(chunk.begin), chunk.data.tobytes()
        for doc, (own, text) in enumerate(zip(spans, chunk.texts)):
            if own:
                a, parts = int(chunk.begin[doc]), []
                for low, high in [*zip([0, *(b for _, b in own)], [*(a for a, _ in own), int(counts[doc])])]:
                    if low < high:
                        parts.append(whole[chunk.places[a + low]:chunk.ends[a + high - 1]])
                text = (b" " if isinstance(scheme.symbols, Words) else b"").join(parts)
            kept.append(text)
        removed = pa.array([[{"start": a, "end": b} for a, b in own] for own in spans], arrow_span)
        for name, col in zip(made, (pa.array(counts, pa.int64()), removed, pa.array(kept, pa.binary()))):
            table = table.append_column(name, col)
        return table

    sent = chunks.groupBy("chunk").applyInArrow(_give_back(send_anchors), _ANSWER)
    repeated = sent.groupBy("part").applyInArrow(_give_back(lambda t: _repeated(scheme, t, shard_bytes)), _ANSWER).repartition(tasks, "chunk")
    moved = chunks.groupBy("chunk").cogroup(repeated.groupBy("chunk")).applyInArrow(_give_back(send_passages), _ANSWER)
    decided = moved.groupBy("part").applyInArrow(_give_back(lambda t: _decided(scheme, decide, t)), _ANSWER)
    return (chunks.groupBy("chunk").cogroup(repeated.unionByName(decided).groupBy("chunk"))
            .applyInArrow(_give_back(lambda t, a: apply(t, a) if t.num_rows else schema_table(schema)), schema))


def schema_table(schema: T.StructType) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema).empty_table()

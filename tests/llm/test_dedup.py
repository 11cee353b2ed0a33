import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm.cases import awkward_docs, frame, words
from rastertab.llm import passages, simhash, substring_dedup, suffix_dedup

LAST = 2 ** 63 - 1


def cover(n, starts, width):
    gone = np.zeros(n, bool)
    for s in starts:
        gone[s:s + width] = True
    return gone


def tie(text):
    import xxhash

    return xxhash.xxh64_intdigest((text or "").encode()) >> 1


def brute_words(rows, width):
    first = {}
    for doc, text, *_ in rows:
        w = words(text)
        for i in range(len(w) - width + 1):
            key, place = tuple(w[i:i + width]), (LAST if doc is None else doc, tie(text), i)
            first[key] = min(first.get(key, place), place)
    out = []
    for doc, text, *_ in rows:
        w = words(text)
        own = [i for i in range(len(w) - width + 1) if first[tuple(w[i:i + width])] < (LAST if doc is None else doc, tie(text), i)]
        gone = cover(len(w), own, width)
        out.append((doc, len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


def brute_bytes(rows, width):
    first = {}
    for doc, text, *_ in rows:
        b = (text or "").encode()
        for i in range(len(b) - width + 1):
            first[b[i:i + width]] = min(first.get(b[i:i + width], LAST), LAST if doc is None else doc)
    out = []
    for doc, text, *_ in rows:
        b = (text or "").encode()
        gone = cover(len(b), [i for i in range(len(b) - width + 1) if first[b[i:i + width]] < (LAST if doc is None else doc)], width)
        out.append((doc, len(b), int(gone.sum()), np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return sorted(out, key=repr)


def got(df):
    rows = df.select("doc_id", "n_symbols", substring_dedup.removed_symbols().alias("gone"), "kept").collect()
    return sorted([(r[0], r[1], r[2], bytes(r[3])) for r in rows], key=repr)


@pytest.mark.parametrize("hot", [4096, 1])
def test_substring_dedup_matches_brute_force(spark, hot):
    rows = awkward_docs(1)
    scheme = passages.Scheme(passages.Words(), 20, 8, False, 256, hot=hot)
    found = passages.remove_repeats(frame(spark, rows), scheme, substring_dedup.Decide(20), chunk_bytes=4000, part_bytes=9000, shard_bytes=5000)
    assert got(found) == brute_words(rows, 20)


@pytest.mark.parametrize("hot", [4096, 1])
def test_suffix_dedup_matches_brute_force(spark, hot):
    rows = awkward_docs(2)
    scheme = passages.Scheme(passages.Bytes(), 50, 24, True, 2048, hot=hot)
    found = passages.remove_repeats(frame(spark, rows), scheme, suffix_dedup.Decide(50), chunk_bytes=4000, part_bytes=9000, shard_bytes=5000)
    assert got(found) == brute_bytes(rows, 50)


def common_line(n=600):
    """A line of sixteen words in every document, each time in another context."""
    line = " ".join(f"line{i:x}" for i in range(16))
    return [(d, " ".join([f"a{d}w{i}" for i in range(22)] + [line] + [f"b{d}w{i}" for i in range(22)]), "en", "s1", 1) for d in range(n)]


def shard_sizes(rows, scheme, n_chunks, n_parts, n_shards, shard_bytes):
    """Passage bytes that each shard gets, by the steps of the exchange."""
    tables = [pa.table({"doc_id": pa.array([r[0] for r in rows[c::n_chunks]], pa.int64()),
                        "text": pa.array([r[1] for r in rows[c::n_chunks]], pa.string())}) for c in range(n_chunks)]
    chunks, sent, answers = [passages.Chunk(scheme, t) for t in tables], {}, {}
    for no, chunk in enumerate(chunks):
        chunk.measure()
        for b, own in chunk.buckets(n_parts):
            sent.setdefault(b, []).append((no, 1, b, chunk.anchor_blob(own)))
    for found in sent.values():
        for r in passages._repeated(scheme, passages._answers(found), shard_bytes).to_pylist():
            answers.setdefault(r["chunk"], []).append((r["part"], r["blob"]))
    sizes = [0] * n_shards
    for no, chunk in enumerate(chunks):
        found = chunk.passages(answers.get(no, []), n_parts)
        for shard, own in found.shards(n_shards):
            sizes[shard] += sum(len(found.contents[j]) for j in own)
    return sizes


@pytest.mark.parametrize("scheme", [passages.Scheme(passages.Words(), 20, 8, False, 256), passages.Scheme(passages.Bytes(), 50, 24, True, 2048)])
def test_contexts_of_a_common_line_are_spread_over_shards(scheme):
    sizes = shard_sizes(common_line(), scheme, 4, 4, 12, 16_000)
    assert sum(sizes) > 12 * 4000 and max(sizes) < 2 * sum(sizes) / 12


@pytest.mark.parametrize("shard_bytes", [16_000, 200_000, 8 << 20])  # by window, by anchor, by stretch
def test_common_line_matches_brute_force(spark, shard_bytes):
    rows = common_line(300) + common_line(310)[290:] + awkward_docs(6)
    for symbols, decide, brute in ((passages.Words(), substring_dedup.Decide(20), brute_words), (passages.Bytes(), suffix_dedup.Decide(50), brute_bytes)):
        words_ = isinstance(symbols, passages.Words)
        scheme = passages.Scheme(symbols, *((20, 8, False, 256) if words_ else (50, 24, True, 2048)))
        found = passages.remove_repeats(frame(spark, rows), scheme, decide, chunk_bytes=40_000, part_bytes=90_000, shard_bytes=shard_bytes)
        assert got(found) == brute(rows, scheme.window)


def test_rows_of_one_id_and_copies_without_id_are_spread_over_chunks(spark):
    rows = [(7, f"text {i}", "en", "s", 1) for i in range(400)] + [(None, "one text", "en", "s", 1)] * 400
    chunks = frame(spark, rows).repartition(16).withColumn("chunk", passages.chunk_of(16))
    for some in ("doc_id = 7", "doc_id IS NULL"):
        assert max(r["count"] for r in chunks.where(some).groupBy("chunk").count().collect()) < 200
    assert got(substring_dedup.dedup_substrings(frame(spark, awkward_docs(8)).repartition(5), window=12, gram=5)) == brute_words(awkward_docs(8), 12)


def test_dedup_general_interface_and_extra_columns(spark):
    rows = awkward_docs(3)
    docs = frame(spark, rows).withColumns({"chunk": F.lit("own"), "removed": F.lit(1), "part": F.lit(2), "blob": F.lit(None).cast("binary")})
    assert got(substring_dedup.dedup_substrings(docs, window=12, gram=5)) == brute_words(rows, 12)
    assert got(suffix_dedup.dedup_bytes(docs, window=30, gram=16)) == brute_bytes(rows, 30)
    empty = docs.limit(0)
    assert substring_dedup.dedup_substrings(empty).count() == 0 and suffix_dedup.dedup_bytes(empty).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=25), min_size=1, max_size=6))
def test_automaton_gives_longest_earlier_match(strings):
    automaton, before = substring_dedup.Automaton(), []
    for s in strings:
        matched = automaton.read(s)
        for end in range(1, len(s) + 1):
            best = 0
            for n in range(1, end + 1):
                piece = s[end - n:end]
                earlier = any(t[i:i + n] == piece for t in before for i in range(len(t) - n + 1)) or any(
                    s[i:i + n] == piece for i in range(end - n))
                best = n if earlier else best
            assert matched[end - 1] == best
        before.append(s)


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=200).map(lambda b: bytes(x % 4 + 1 for x in b)), st.integers(1, 9))
def test_induced_order(body, block):
    text = np.frombuffer(body + b"\0", np.uint8)
    order = np.concatenate([*suffix_dedup.SuffixOrder(text, 12, block=block, memory=16).descending()]).tolist()
    assert sorted(order) == list(range(len(body)))
    keys = [(body + b"\0")[i:i + 12] for i in order]
    assert keys == sorted(keys, reverse=True)


@given(st.lists(st.lists(st.integers(0, 2 ** 40), max_size=20), min_size=1, max_size=4))
def test_arrays_survive_packing(lists):
    arrays = [np.array(x, np.uint64) for x in lists]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, passages.unpack(passages.pack(*arrays))))


# -- SimHash ------------------------------------------------------------------

def brute_fingerprint(text, shingle=3):
    import xxhash

    w = [x.lower() for x in words(text)]
    if not w:
        return 0
    grams = [b" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, distance):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(fps))]


def test_simhash_matches_brute_force(spark):
    rows = awkward_docs(4)
    long_text = next(t for d, t, *_ in rows if d == 906).split(" ")
    for i in range(40):  # near copies of a long text
        copy = list(long_text)
        copy[50 * i:50 * i + 1 + i % 7] = ["changed"]
        rows.append((2000 + i, " ".join(copy).upper() if i % 5 == 0 else " ".join(copy), "en", "s1", 1))
    fps = [brute_fingerprint(r[1]) for r in rows]
    want = sorted(zip([r[0] for r in rows], fps, brute_components([r[0] for r in rows], fps, 3)), key=repr)
    found = simhash.near_duplicates(frame(spark, rows)).collect()
    assert sorted([(r.doc_id, r.fp % 2 ** 64, r.component_id) for r in found], key=repr) == want
    assert len({c for _, _, c in want}) < len({f for _, f, _ in want})


@pytest.mark.parametrize("largest", [4096, 5])
def test_links_connect_all_close_fingerprints(spark, largest):
    import random

    rng = random.Random(5)
    fps = set()
    for _ in range(30):
        centre = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 25)):
            centre ^= sum(1 << rng.randrange(64) for _ in range(rng.randrange(0, 4)))
            fps.add(centre & (2 ** 64 - 1))
    fps = sorted(fps)
    signed = [f - 2 ** 64 if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.links(df, 3, 5, largest=largest).collect()
    assert all(bin((e.a ^ e.b) % 2 ** 64).count("1") <= 3 for e in edges)
    want = brute_components(list(range(len(fps))), fps, 3)
    root = {f: f for f in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for e in edges:
        root[find(e.a)] = find(e.b)
    groups, expected = {}, {}
    for f, c in zip(signed, want):
        groups.setdefault(find(f), set()).add(f)
        expected.setdefault(c, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_long_path(spark):
    path = spark.range(300).selectExpr("id as a", "id + 1 as b")
    assert {r.root for r in simhash.components(path).collect()} == {0}
    assert simhash.components(path.limit(0)).count() == 0


def test_rows_without_id_link_fingerprints(spark, monkeypatch):
    rows = [(5, "0"), (None, "3"), (9, "f"), (None, "f0"), (None, "f000000"), (4, "f000001"), (None, "ffffffff")]
    marked = spark.createDataFrame([(d, int(f, 16)) for d, f in rows], "doc_id long, fp long")
    monkeypatch.setattr(simhash, "with_fingerprints", lambda docs, *_: docs)
    want = zip([d for d, _ in rows], [int(f, 16) for _, f in rows], brute_components([d for d, _ in rows], [int(f, 16) for _, f in rows], 3))
    found = sorted([(r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(marked).collect()], key=repr)
    assert found == sorted(want, key=repr) and (9, 15, 5) in found and (None, 3, 5) in found


def test_simhash_empty(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0

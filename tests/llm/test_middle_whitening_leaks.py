"""Fill-in-middle, embedding whitening and benchmark decontamination against
brute-force versions."""
import hashlib
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.cases import awkward_docs, frame
from rastertab.llm import decontamination as dec
from rastertab.llm import fill_middle as fim
from rastertab.llm import whitening as wh

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


# --------------------------------------------------------------------------- fill-in-middle
def members_of(kind):
    rng = random.Random(kind)
    return {"array": sorted(rng.sample(range(fim.GROUP), 500)),
            "bitmap": sorted(rng.sample(range(fim.GROUP), 20_000)),
            "runs": [*range(7, 3000), *range(5000, 5001), *range(60_000, fim.GROUP)]}[kind]


@pytest.mark.parametrize("kind, form", [("array", fim.ArrayContainer), ("bitmap", fim.BitmapContainer), ("runs", fim.RunContainer)])
def test_container_selects_every_member(kind, form):
    members = members_of(kind)
    made = fim.container(np.array(members))
    assert isinstance(made, form) and len(made) == len(members)
    assert [made.select(i) for i in range(len(members))] == members


def test_set_selects_over_groups_of_all_forms():
    whole, want = fim.BoundarySet(), []
    for group, kind in ((0, "runs"), (3, "bitmap"), (4, "array"), (9, "runs")):
        whole.add_group(group, np.array(members_of(kind)))
        want += [group * fim.GROUP + m for m in members_of(kind)]
    whole.add_group(11, np.empty(0, int))
    assert len(whole) == len(want) and [whole.select(i) for i in range(0, len(want), 37)] == want[::37]
    with pytest.raises(IndexError):
        whole.select(len(want))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t\x0b\x1c aé日😀<P>", max_size=60))
def test_boundaries_are_the_unit_ends(text):
    data = np.frombuffer(text.encode(), np.uint8)
    ends = np.cumsum([0] + [len(u.encode()) for u in UNIT.findall(text)]).tolist()
    made = fim.boundaries(data)
    assert [made.select(i) for i in range(len(made))] == ends
    chars = np.cumsum([0] + [len(c.encode()) for c in text]).tolist()
    made = fim.boundaries(data, "characters")
    assert [made.select(i) for i in range(len(made))] == chars


@pytest.mark.parametrize("shift", [0, 1, 2])
def test_boundaries_of_a_text_over_many_groups(shift):
    text = "x" * shift + "ab é " * 40_000 + "long" * 30_000 + " a b" * 50_000 + "  "
    data, ends = np.frombuffer(text.encode(), np.uint8), np.cumsum([0] + [len(u.encode()) for u in UNIT.findall(text)])
    made = fim.boundaries(data)
    assert len(made) == len(ends) and all(made.select(i) == ends[i] for i in range(0, len(ends), 101))
    chars = fim.boundaries(data, "characters")
    assert any(isinstance(c, fim.RunContainer) for c in chars.containers) and len(chars) == len(text) + 1


def middle_of(doc_id, text, seed=42, rate=50, spm=80):
    text, h = text or "", hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    units = UNIT.findall(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < spm else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc_id, len(units), form, len(p), len(m), out


def test_fill_in_middle_matches_brute_force(spark):
    rows = awkward_docs(11) + [(2000 + i, t, "en", "s", 1) for i, t in enumerate(
        ["<P> in the text", "a <M", "<", "<S", " lead", "trail ", "a", "日本 語 ", " \n ", "x " * 50_000, "é" * 70_000 + " z"] * 4)]
    docs = frame(spark, rows).withColumnRenamed("lang", "FIM").withColumn("output", F.lit(1))
    for rate, spm in ((50, 80), (100, 0), (0, 50), (100, 100)):
        found = fim.fill_in_middle(docs, rate=rate, spm_rate=spm)
        found = found.withColumn("back", fim.restored(F.col("fim.form"), F.col("fim.output")))
        assert [c for c in found.columns if c.lower() == "fim"] == ["fim"] and "output" in found.columns
        got = found.select("doc_id", "text", "back", "fim.*").collect()
        assert all(r.back == (r.text or "") for r in got)
        assert sorted((repr(tuple(r)[:1] + tuple(r)[3:]) for r in got)) == sorted(repr(middle_of(r[0], r[1], 42, rate, spm)) for r in rows)
    assert fim.fill_in_middle(frame(spark, [])).count() == 0


# --------------------------------------------------------------------------- whitening
def vectors_frame(spark, rows):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                           T.StructField("Whitened", T.StringType())])
    return spark.createDataFrame([(i, v, "x") for i, v in rows], schema).repartition(3)


def plain_whitening(x, k):
    n, c = len(x), x - x.mean(axis=0)
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return c @ q / np.sqrt(e), e, (c * c).sum() / n


def check_whitening(spark, rows, k, usable):
    out, model = wh.whiten(vectors_frame(spark, rows), components=k)
    got = sorted(out.collect(), key=lambda r: (r.vec_id is not None, r.vec_id or 0, tuple(r.embedding)))
    assert [r.vec_id for r in got] == [i for i, _ in usable] and "Whitened" not in out.columns
    ints = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in usable]
    n, sums = len(ints), [sum(col) for col in zip(*ints)]
    assert [r.deviation for r in got] == [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in ints]
    white, e, trace = plain_whitening(np.array(ints, float), model.components.shape[1])
    assert np.allclose(model.eigenvalues, e, rtol=1e-9) and np.allclose(model.explained, e / trace, rtol=1e-9)
    y = np.array([r.whitened for r in got])
    assert model.identity_error < 1e-9 and np.allclose(y.T @ y / n, np.eye(y.shape[1]), atol=1e-9)
    assert np.allclose(model.components.T @ model.components, np.eye(y.shape[1]), atol=1e-10)
    return y, white, model


def test_whitening_matches_a_full_decomposition(spark):
    rng = np.random.default_rng(1)
    good = [(i, (rng.normal(size=12) * np.arange(1, 13) + 3).tolist()) for i in range(80)]
    good += [(None, [1.5] * 12), (5, (rng.normal(size=12) * 4).tolist()), good[7], good[7]]
    bad = [(100, None), (101, []), (102, [1.0] * 11 + [None]), (103, [float("nan")] + [0.0] * 11), (104, [float("inf")] + [0.0] * 11),
           (105, [1.0] * 11)]
    usable = sorted(good, key=lambda r: (r[0] is not None, r[0] or 0, tuple(r[1])))
    y, white, model = check_whitening(spark, good + bad, 5, usable)
    for i in range(5):  # either sign, the same for all rows
        assert min(np.abs(y[:, i] - white[:, i]).max(), np.abs(y[:, i] + white[:, i]).max()) < 1e-8


def test_whitening_of_few_dimensions_and_no_variance(spark):
    usable = [(i, [float(i % 4), 2.0 * (i % 4), 7.0]) for i in range(20)]  # one direction of variance
    _, _, model = check_whitening(spark, usable, 32, usable)
    assert model.components.shape == (3, 1)
    out, model = wh.whiten(vectors_frame(spark, [(1, [2.0, 3.0])] * 3))
    assert [(r.deviation, r.whitened) for r in out.collect()] == [(0, [])] * 3 and model.identity_error == 0
    out, model = wh.whiten(vectors_frame(spark, []))
    assert out.count() == 0 and model.n == 0


def test_whitening_of_large_entries_is_exact(spark):
    usable = [(i, [1e15 * (-1) ** i, float(i)]) for i in range(6)]
    out, model = wh.whiten(vectors_frame(spark, usable))
    assert {r.deviation for r in out.collect()} == {None} and model.identity_error < 1e-6  # beyond a long


def test_short_runs_find_repeated_values(spark):
    """Whatever a run that stops early misses of a repeated value, the runs
    after it find."""
    rng, d = np.random.default_rng(3), 300
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    spectrum = np.concatenate([[50.0, 50.0, 50.0, 40.0], 1.0 / np.arange(1, d - 3)])
    x = np.linalg.qr(rng.normal(size=(2 * d, d)))[0] * spectrum @ q.T

    def product(left, w):
        u = x @ w
        return float(u @ u), (x @ left).T @ u, x.T @ u

    values, vectors, steps = wh.bidiagonalise(product, d, 4, np.zeros((d, 0)), np.random.default_rng(5))
    assert steps < 60 and np.allclose(values[0], 50, rtol=1e-10)
    found, rng = vectors, np.random.default_rng(6)
    for _ in range(3):
        value, more, _ = wh.bidiagonalise(product, d, 1, found, rng)
        values, found = np.append(values, value), np.column_stack([found, more])
    assert np.allclose(np.sort(values)[::-1][:4], [50, 50, 50, 40], rtol=1e-10)
    assert np.allclose(found.T @ found, np.eye(found.shape[1]), atol=1e-10)


def test_whitening_stops_early_and_merges_runs(spark):
    rng = np.random.default_rng(8)
    scale = np.concatenate([[90.0, 60.0], np.full(78, 0.4)])
    usable = [(i, (rng.normal(size=80) * scale).tolist()) for i in range(200)]
    y, white, model = check_whitening(spark, usable, 2, usable)
    assert model.steps < 80
    assert min(np.abs(y[:, 0] - white[:, 0]).max(), np.abs(y[:, 0] + white[:, 0]).max()) < 1e-7


# --------------------------------------------------------------------------- decontamination
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def leaks(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = lowered(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = lowered(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                names = windows.get(tuple(w[i:i + n]))
                if names:
                    hit |= set(range(i, i + n))
                    found |= names
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return out


ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("place", T.LongType())])


def leak_case(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "É", "İx", "naïve", "日本", "A1"] + [f"w{i}" for i in range(25)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (30, 12, 10, 9, 1, 2, 3, 40)]
    items = [(i, t) for i, t in enumerate(texts)] + [(0, texts[3]), (12, texts[1]), (None, texts[5] + " w3"), (20, None), (21, " .,;"),
                                                     (22, "absent " + texts[0]), (23, "the the the the the the the the the the the")]
    docs = [(900, None), (901, ""), (902, " --- "), (None, texts[0]), (None, texts[0]), (7, texts[1]), (7, texts[7]),
            (903, "the " * 3000), (904, " ".join(rng.choice(vocabulary) for _ in range(20_000)))]
    for i in range(60):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 80))]
        if rng.random() < .5:
            own = rng.choice(texts).split()
            low = rng.randrange(len(own))
            w[rng.randrange(len(w)):0] = own[low:low + rng.randrange(1, 25)]
        docs.append((i, rng.choice([" ", ", ", "\n", " THE-"]).join(x.upper() if rng.random() < .1 else x for x in w)))
    return docs, items


def leak_frames(spark, docs, items):
    d = frame(spark, [(i, t, "en", "s", 1) for i, t in docs]).withColumnRenamed("lang", "row").withColumnRenamed("source", "term")
    return d.repartition(3), spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)


@pytest.mark.parametrize("seed", [1, 2])
def test_decontamination_matches_brute_force(spark, seed):
    docs, items = leak_case(seed)
    d, b = leak_frames(spark, docs, items)
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in dec.decontaminate(d, b).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, leaks(docs, items)))
    assert sum(r[2] > 0 for r in got) > 10


def test_decontamination_of_empty_tables(spark):
    docs, items = leak_case(3)
    d, b = leak_frames(spark, docs, items)
    assert dec.decontaminate(d.limit(0), b).count() == 0
    assert {(r.n_hit, len(r["items"])) for r in dec.decontaminate(d, b.limit(0)).collect()} == {(0, 0)}


@pytest.mark.parametrize("width", [10, 13])
def test_proximity_matches_brute_force(spark, width):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(14)]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 70)))) for i in range(40)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate((1, 2, 4, 5, 6, 3, 11))]
    d, b = leak_frames(spark, docs, items)
    windows, _ = dec.item_windows(b)
    vocab = dec.vocabulary(windows)
    index = dec.build_index(d, vocab)
    lists = dec.ranked_lists(windows, vocab, index)
    rows = {r.row: r.doc_id for r in index.where("term = 0").select("row", "doc_id").collect()}
    terms = {r.window: tuple(r.terms) for r in windows.collect()}
    got = {(rows[r.row], terms[r.window], r.at, r.first, r["last"]) for r in dec.proximity_matches(index, lists, width).collect()}
    by_term = {r.term: r.word for r in vocab.collect()}
    want = set()
    for one in lists.collect():
        need, rarest = set(terms[one.window]), by_term[one.lists[0].term]
        for doc_id, text in docs:
            w = lowered(text)
            for at in (i for i, x in enumerate(w) if x == rarest):
                spans = [(last - first, first, last) for first in range(max(0, at - width + 1), at + 1)
                         for last in range(at, min(len(w), first + width)) if need <= set(w[first:last + 1])]
                if spans:
                    _, first, last = min(spans)
                    want.add((doc_id, terms[one.window], at, first, last))
    assert got == want and len(want) > 50

import zlib
from collections import Counter

import corpus_pipeline
import xxhash
from conftest import SF_SMALL
from llm.cases import awkward_docs, frame, words
from llm.test_dedup import brute_fingerprint, brute_words
from llm.test_rules_search import brute_mix, plain_model
from llm.test_tokens_packing import check_packing, whole_ids
from pyspark.sql import functions as F


def rows_of(df):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def brute_clean(rows, labels):
    """Rows that a plain model of the same description leaves."""
    truth = {}
    for i, y in labels:
        if i is not None and y in (0, 1) and zlib.crc32(str(i).encode()) % 3 != 1:
            truth[i] = max(y, truth.get(i, 0))
    texts = {}
    for i, text, *_ in rows:
        if i in truth and text is not None and len(text) <= 20_000:
            texts[i] = min(text, texts.get(i, text))
    score = plain_model(sorted((i, t, truth[i]) for i, t in texts.items()), Counter(truth.values()))
    return [r for r in rows if score(r[1]) < 0.7]


def tie(text):
    return xxhash.xxh64_intdigest(text.encode(), 42) - (1 << 64 if xxhash.xxh64_intdigest(text.encode(), 42) >> 63 else 0) if text is not None else 42


def brute_single(rows, distance=3):
    """One row of each component of fingerprints: smallest id, nameless last, then the text's hash."""
    fps = [brute_fingerprint(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                root[find(i)] = find(j)
    best = {}
    for i, r in enumerate(rows):
        key = (r[0] is None, r[0] or 0, tie(r[1]))
        if find(i) not in best or key < best[find(i)][0]:
            best[find(i)] = (key, r)
    return [r for _, r in best.values()]


def brute_left(rows):
    kept = {}
    for d, _, gone, text in brute_words(rows, 20):
        kept.setdefault(d, []).append((gone, text.decode()))
    out = []
    for d, t, lang, source, n in rows:
        [(gone, text)] = kept[d]
        if not gone or text:
            out.append((d, t, lang, source, n) if not gone else (d, text, lang, source, len(text)))
    return out


def test_each_stage_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").select("doc_id", "toxic").collect()]
    by_name = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash near-dedup", "substring dedup", "mixing", "packing"]

    clean = by_name["toxicity"](spark, docs, SF_SMALL)
    rows = brute_clean(rows_of(docs), labels)
    assert clean.columns == docs.columns and sorted(rows_of(clean)) == sorted(rows) and len(rows) < docs.count()

    single = by_name["simhash near-dedup"](spark, clean, SF_SMALL)
    rows = brute_single(rows)
    assert single.columns == docs.columns and sorted(rows_of(single)) == sorted(rows)

    left = by_name["substring dedup"](spark, single, SF_SMALL)
    rows = brute_left(rows)
    assert left.columns == docs.columns and sorted(rows_of(left)) == sorted(rows)

    mixed = by_name["mixing"](spark, left, SF_SMALL)
    copies = {d: t // s for d, s, _, _, t in brute_mix(rows) if t and t >= s}
    assert mixed.columns == docs.columns
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == copies

    packed = by_name["packing"](spark, mixed, SF_SMALL).collect()
    padding, n = check_packing(packed, rows_of(mixed), 1024, 0)
    assert padding <= 2 * 1024

    # run() writes and rereads every stage: documents, copies and tokens of the chained plain versions
    texts = {r[0]: r[1] for r in rows}
    want = Counter({(d, len(whole_ids(texts[d])) + 1): n for d, n in copies.items()})
    found = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert Counter((r.doc_id, r.doc_tokens) for r in found if r.start == 0) == want
    assert sum(r.length for r in found) == sum(n * tokens for (_, tokens), n in want.items())


def test_near_duplicates_keep_one_row_of_each_group(spark):
    """Different texts under one id are their own groups; copies without id go
    beside one with an id, and of copies without any id one stays."""
    rng_words = [f"w{i}" for i in range(400)]
    text = [" ".join(rng_words[i * 50:i * 50 + 50]) for i in range(8)]
    rows = [(1, text[0], "en", "a", 1), (1, text[1], "en", "a", 1), (None, text[0], "en", "a", 1), (None, text[0], "de", "b", 2),
            (None, text[2], "en", "a", 1), (None, text[2], "en", "a", 1), (None, text[3], "en", "a", 1), (5, text[4], "en", "a", 1),
            (5, text[4], "en", "a", 1), (6, text[4], "en", "a", 1), (7, None, "en", "a", 0), (8, "", "en", "a", 0), (9, " ", "en", "a", 0)]
    kept = dict(corpus_pipeline.STAGES)["simhash near-dedup"](spark, frame(spark, rows), SF_SMALL)
    assert sorted(map(repr, rows_of(kept))) == sorted(map(repr, [rows[0], rows[1], rows[4], rows[6], rows[7], rows[10]]))
    rows = awkward_docs(16)
    kept = dict(corpus_pipeline.STAGES)["simhash near-dedup"](spark, frame(spark, rows), SF_SMALL)
    assert sorted(repr(r[:2]) for r in rows_of(kept)) == sorted(repr(r[:2]) for r in brute_single(rows))


def test_stages_stand_awkward_and_empty_input(spark):
    rows = awkward_docs(14)
    for some in (rows, []):
        docs = frame(spark, some)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == docs.columns
            kept = out.collect()
            assert len(kept) <= 3 * max(1, len(some))
            if name == "simhash near-dedup":
                assert len(kept) == len(brute_single(some))
            if name == "mixing":
                assert all(words(r.text) for r in kept)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() >= len(some)


def test_extra_columns_pass_through(spark):
    names = ("removed", "kept", "n_symbols", "chunk", "size", "fp", "time", "copies", "target", "row", "same", "nth", "slice",
             "toxic_score", "toxic_predicted", "component_id", "length", "number", "blob", "part")
    docs = frame(spark, awkward_docs(15)).withColumns({n: F.lit(f"own {n}") for n in names})
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        assert [tuple(r) for r in out.select(*names).distinct().collect()] == [tuple(f"own {n}" for n in names)]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() > 0

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.cases import awkward_docs, frame
from rastertab.llm import packing, token_files, tokens
from rastertab.session import scratch_path

PATH = tokens.default_tokenizer()
WHOLE = Tokenizer.from_file(PATH)
ENCODER = tokens.Encoder(PATH, remembered=50)


def whole_ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=" \n\t\u00a0\u2003\x1c'stre.,1é日😀ab<|>", max_size=60) | st.text(max_size=40))
def test_pieces_give_the_ids_of_whole_texts(text):
    assert np.frombuffer(ENCODER.ids(text), "<u4").tolist() == whole_ids(text)


def test_pieces_give_the_ids_of_documents():
    for _, text, *_ in awkward_docs(6):
        assert np.frombuffer(ENCODER.ids(text), "<u4").tolist() == whole_ids(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=" \n'\"sté_-#*.!?()<|>µª1", max_size=40))
def test_marks_and_lines_give_the_ids_of_whole_texts(text):
    assert np.frombuffer(ENCODER.ids(text), "<u4").tolist() == whole_ids(text)


def test_words_with_runs_of_marks_and_at_line_starts_use_the_known_words(monkeypatch):
    encoder, asked, new = tokens.Encoder(PATH), [], []
    monkeypatch.setattr(encoder, "_pieces", lambda words: new.extend(words) or tokens.Encoder._pieces(encoder, words))
    word = encoder._word
    monkeypatch.setattr(encoder, "_word", lambda w, space=" ": asked.append(space + w) or word(w, space))
    texts = ["So retirement is near", "a retirement*** near,### near.\nretirement... (so", "near!! retirement)\nretirement is it's near;"]
    for text in texts:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == whole_ids(text)
    assert asked.count(" retirement") == asked.count("retirement") == asked.count(" near") == 1
    assert sorted(new) == ["(so", "it's"]


def test_ascii_words_are_not_spelled_out_and_long_words_are_not_kept():
    class Spelled(dict):
        asked = set()

        def __getitem__(self, byte):
            self.asked.add(byte)
            return super().__getitem__(byte)

    encoder = tokens.Encoder(PATH, remembered=6)
    encoder._letters = Spelled(encoder._letters)
    long = "ab" * 40
    texts = [f"so near {long}... and {long} near??", f"and\nnear {long}!! so far {long} * near", "near so", "so and far away it's near by"]
    for text in texts * 2:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == whole_ids(text)
        assert max(map(len, [*encoder._young, *encoder._old])) < 64 and len(encoder._young) <= 6
    assert Spelled.asked == {32}
    assert np.frombuffer(encoder.ids("über né"), "<u4").tolist() == whole_ids("über né") and len(Spelled.asked) > 1


def expected_rows(rows, end):
    return [(doc, np.array(whole_ids(text) + [end], "<u4").tobytes()) for doc, text, *_ in rows]


def test_token_files_round_trip(spark):
    rows = awkward_docs(7)
    docs = frame(spark, rows).withColumn("part", F.lit(1))
    files = token_files.write_token_files(docs, scratch_path(spark, "test-files"), frame_bytes=1 << 10)
    found = token_files.read_token_files(files).collect()
    want = sorted(expected_rows(rows, 2), key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found) == sorted(
        (d is not None, d or 0, len(b) // 4, zlib.crc32(b)) for d, b in want)
    by_start = sorted(found, key=lambda r: r.start)
    assert [r.start for r in by_start] == np.cumsum([0] + [r.n_tokens for r in by_start])[:-1].tolist()
    assert [r.doc_id for r in by_start] == [d for d, _ in want]


def test_reader_opens_only_the_frames_asked_for(tmp_dir):
    from pyarrow import fs

    with fs.LocalFileSystem().open_output_stream(f"{tmp_dir}/a.tokens") as out:
        writer = token_files.TokenFileWriter(out, 64, 3)
        texts = [np.arange(i, i + n, dtype="<u4").tobytes() for i, n in enumerate((1, 40, 3, 0, 100, 2))]
        for i, t in enumerate(texts):
            writer.add(None if i == 2 else i, t)
        writer.close()
    with fs.LocalFileSystem().open_input_file(f"{tmp_dir}/a.tokens") as source:
        reader = token_files.TokenFileReader(source)
        opened = []
        frame_of = reader.frame
        reader.frame = lambda i: opened.append(i) or frame_of(i)
        assert b"".join(reader.ids(5)) == texts[5] and len(opened) == 1
        assert [b"".join(reader.ids(i)) for i in range(6)] == texts and reader.no_id.tolist() == [False, False, True, False, False, False]
    data = bytearray(open(f"{tmp_dir}/a.tokens", "rb").read())
    data[10] ^= 1
    open(f"{tmp_dir}/b.tokens", "wb").write(bytes(data))
    with fs.LocalFileSystem().open_input_file(f"{tmp_dir}/b.tokens") as source, pytest.raises(Exception):
        list(token_files.TokenFileReader(source).ids(0))


def test_files_are_seekable_zstandard(tmp_dir):
    import zstandard
    from pyarrow import fs

    with fs.LocalFileSystem().open_output_stream(f"{tmp_dir}/a.tokens") as out:
        writer = token_files.TokenFileWriter(out, 64, 3)
        writer.add(1, bytes(range(200)))
        writer.close()
    with open(f"{tmp_dir}/a.tokens", "rb") as f:  # any zstandard reader skips index and table
        assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read() == bytes(range(200))


def test_reading_lets_go_of_encoders(spark, tmp_dir, monkeypatch):
    import pyarrow as pa
    import tokenizers
    from pyarrow import fs

    with fs.LocalFileSystem().open_output_stream(f"{tmp_dir}/a.tokens") as out:
        writer = token_files.TokenFileWriter(out, 64, 3)
        writer.add(1, bytes(range(200)))
        writer.close()
    files = spark.createDataFrame([(0, f"{tmp_dir}/a.tokens", 1, 50)], "part int, file string, n_docs long, n_tokens long")
    scans = []
    monkeypatch.setattr(type(files), "mapInArrow", lambda self, scan, schema: scans.append(scan) or self)
    token_files.read_token_files(files)
    tokens.worker_encoder(PATH)
    [found] = scans[0](iter([pa.record_batch({"file": [f"{tmp_dir}/a.tokens"], "before": [7]})]))
    assert found.to_pylist() == [{"doc_id": 1, "start": 7, "n_tokens": 50, "ids_crc32": zlib.crc32(bytes(range(200)))}]
    assert not tokenizers.__dict__.get("_encoders_by_path")


def test_token_files_of_nothing(spark):
    files = token_files.write_token_files(frame(spark, []), scratch_path(spark, "test-files"))
    assert token_files.read_token_files(files).count() == 0


def check_packing(found, rows, window, end):
    ids = [b for _, b in expected_rows(rows, end)]
    pieces = defaultdict(list)
    for r in found:
        assert 1 <= r.length <= window
        pieces[(r.doc_id, r.doc_tokens, r.start)].append(r)
    want = defaultdict(list)
    for (doc, *_), b in zip(rows, ids):
        n = len(b) // 4
        for s in range(0, n, window):
            want[(doc, n, s)].append(zlib.crc32(b[4 * s:4 * (s + window)]))
    assert {k: sorted(r.ids_crc32 for r in v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding, len(sequences)


def test_packing_matches_contract(spark):
    rows = awkward_docs(8)
    found = packing.pack(frame(spark, rows).withColumn("number", F.lit(1)), window=128).collect()
    padding, n = check_packing(found, rows, 128, 0)
    assert padding <= 2 * 128 and n >= sum(len(b) // 4 for _, b in expected_rows(rows, 0)) / 128
    assert packing.pack(frame(spark, [])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 6), max_size=8), st.integers(0, 60))
def test_fill_is_the_closest_multiset(counts, capacity):
    reach = {0}
    for length, n in counts.items():
        reach = {r + length * k for r in reach for k in range(n + 1) if r + length * k <= capacity}
    used = packing.fill(capacity, counts)
    assert all(0 < n <= counts[k] for k, n in used.items())
    assert sum(k * n for k, n in used.items()) == max(reach)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
def test_plan_uses_every_piece_once(counts):
    used = defaultdict(int)
    for lengths, times in packing.plan(counts, 64):
        assert sum(k * n for k, n in lengths.items()) <= 64
        for k, n in lengths.items():
            used[k] += n * times
    assert dict(used) == counts

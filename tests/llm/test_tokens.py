"""Operators 2 and 10, and the encoder that they share."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rateweave.llm import packing, queries, token_files
from rateweave.llm import tokens as T

PATH = queries.tokenizer_file()
SCHEMA = "doc_id long, text string"
ROWS = [(5, "the cat sat on the mat\n\nand  then "), (3, None), (4, ""), (None, "null id"), (5, "again 5"), (5, "again 5"),
        (9, " lead"), (8, "x" * 5000), (7, "a\n b \n c   d\t e"), (-2, "word " * 3000), (10, "<|endoftext|> é ñ 'll"),
        (11, "日本 語 😀   x")]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t abé'sl!<>|1日", max_size=30), max_size=5))
def test_encoder_equals_tokenizer(texts):
    enc = T.encoder(PATH)
    t = enc.tokenizer
    got = enc.encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [ids_of(t, x) for x in texts]


def test_encoder_on_documents_and_with_a_full_table(spark, tokenizer, monkeypatch):
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    want = [ids_of(tokenizer, x) for x in texts]
    monkeypatch.setattr(T, "KEPT_MOST", 500)
    enc = T.Encoder(PATH)
    got = [g for a, z in T.groups(texts, 50_000) for g in enc.encode(texts[a:z])]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want


def check_packing(rows, docs, tokenizer, capacity):
    want = Counter()
    for i, t in docs:
        ids = np.array(ids_of(tokenizer, t) + [0], "<u4")
        n = len(ids)
        cut = [0] + list(range(n % capacity or capacity, n + 1, capacity)) if n > capacity else [0, n]
        for k, (a, z) in enumerate(zip(cut, cut[1:])):
            want[(i, k, a, z - a, zlib.crc32(ids[a:z].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= capacity
    return len(bins)


def test_packing_small(spark, tokenizer):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("part", F.lit(1)).withColumn("length", F.lit("clash"))
    for capacity in (2048, 16):
        got = packing.pack(df.repartition(3), PATH, capacity=capacity)
        rows = got.collect()
        check_packing(rows, ROWS, tokenizer, capacity)
        assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)


def test_packing_documents(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack(docs, PATH, with_ids=False).collect()
    n = check_packing(rows, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], tokenizer, 2048)
    assert n <= 1.005 * -(-sum(r.length for r in rows) // 2048) + 1


def test_packing_empty(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_plan_beats_plain_greedy_and_uses_every_piece():
    r = random.Random(4)
    for capacity in (10, 64):
        for _ in range(30):
            counts = {x: r.randint(1, 40) for x in r.sample(range(1, capacity + 1), 8)}
            used, bins = Counter(), 0
            for lengths, times in packing.plan_bins(counts, capacity):
                assert sum(lengths) <= capacity
                bins += times
                for x in lengths:
                    used[x] += times
            assert used == Counter(counts)
            greedy = []
            for x in sorted(Counter(counts).elements(), reverse=True):
                fit = [k for k, g in enumerate(greedy) if g >= x]
                if fit:
                    greedy[min(fit, key=lambda k: greedy[k])] -= x
                else:
                    greedy.append(capacity - x)
            assert bins <= len(greedy)
    assert packing.plan_bins({6: 4, 5: 2, 3: 4, 2: 2}, 10) and packing._best_pair(np.bincount([2, 3, 3]), 7) == (3, 3)
    assert packing._best_pair(np.bincount([2, 3]), 7) == (3, 2) and packing._best_pair(np.bincount([9]), 5) is None


def test_segments_round_trip_and_checksums():
    rng = np.random.default_rng(1)
    for n, top in ((1, 1), (31, 3), (8192, 50_000), (50_001, 50_257), (20_000, 2), (9000, 5_000_000)):
        ids = (rng.zipf(1.3, n) % top).astype(np.uint32)
        sizes = np.array([n], np.uint32)
        raw = token_files.encode_segment(ids, np.array([7]), np.array([False]), sizes)
        s = token_files.Segment(raw)
        assert np.array_equal(s.decode(), ids)
        for k in range(s.blocks):
            assert np.array_equal(s.decode(k, k + 1), ids[k * token_files.BLOCK_IDS:(k + 1) * token_files.BLOCK_IDS])
        if n == 50_001:
            assert len(raw) < 2 * n
            bad = bytearray(raw)
            bad[-100] ^= 1
            with pytest.raises(ValueError):
                token_files.Segment(bytes(bad)).decode()


@pytest.mark.parametrize("segment_ids", [40, 1 << 20])
def test_token_files(spark, tmp_path, tokenizer, segment_ids):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("part", F.lit("clash"))
    token_files.write_tokens(df.repartition(4), str(tmp_path / "t"), PATH, segment_ids=segment_ids)
    got = sorted(token_files.read_tokens(spark, str(tmp_path / "t")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted([i for i, _ in ROWS], key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32
    want = Counter((i, tuple(ids_of(tokenizer, t) + [0])) for i, t in ROWS)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want


def test_token_files_empty(spark, tmp_path):
    token_files.write_tokens(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"), PATH)
    assert token_files.read_tokens(spark, str(tmp_path / "e")).count() == 0


MARKED = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y\n<|endoftext|>", "<|endoftext|> <|endoftext|>", "a <|endoftext| > b",
          "plain words", "<|endoftext|", " <|endoftext|>é", "the cat<|ENDOFTEXT|> sat", "word " * 3000 + "<|endoftext|> end"]


@pytest.fixture(scope="module")
def untouched():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_marks_of_the_vocabulary_in_texts_are_marks(untouched):
    assert untouched.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    got = T.Encoder(PATH).encode(MARKED + MARKED)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [ids_of(untouched, x) for x in MARKED + MARKED]


def test_random_texts_with_marks(untouched):
    r = random.Random(8)
    bits = ["<|endoftext|>", "<|endo", "ftext|>", " ", "\n", "a", "é", "'s", "the cat", "日", "!"]
    texts = ["".join(r.choices(bits, k=r.randint(0, 12))) for _ in range(2000)]
    got = T.Encoder(PATH).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [ids_of(untouched, x) for x in texts]


def test_packing_and_token_files_with_marks(spark, tmp_path, untouched):
    docs = list(enumerate(MARKED))
    df = spark.createDataFrame(docs, SCHEMA)
    for capacity in (2048, 16):
        check_packing(packing.pack(df.repartition(3), PATH, capacity=capacity).collect(), docs, untouched, capacity)
    token_files.write_tokens(df.repartition(3), str(tmp_path / "t"), PATH)
    got = sorted(token_files.read_tokens(spark, str(tmp_path / "t")).collect(), key=lambda r: r.start)
    at = 0
    for (i, text), r in zip(docs, got):
        want = np.array(ids_of(untouched, text) + [0], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(want), zlib.crc32(want.tobytes()))
        at += len(want)

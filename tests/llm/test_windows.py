"""Operator 11: near-equal windows, against the tokenizer as it is loaded."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rateweave.llm import queries, window_packing, word_tokens

PATH = queries.tokenizer_file("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"
ROWS = [(5, "The cat sat on the mat, don't\n\nit?  42 "), (3, None), (4, ""), (None, "null id"), (None, None), (5, "again 5"),
        (5, "again 5"), (9, " lead"), (8, "x" * 5000), (7, "a\x1cb \u0085 c d\t e"), (-2, "word, " * 9000),
        (10, "<|endoftext|> É ñ 'll <|startoftext|>x"), (11, "日本 語 😀   x İstanbul ﬁ é"), (2**62, "big id")]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\x1c\x85abZé'sÉİ!<>|1日́-", max_size=30), max_size=5))
def test_encoder_equals_tokenizer(texts):
    enc = word_tokens.encoder(PATH)
    got = enc.encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [enc.tokenizer.encode(x, add_special_tokens=False).ids for x in texts]


def test_encoder_on_documents_and_with_a_full_table(spark, tokenizer, monkeypatch):
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    monkeypatch.setattr(word_tokens, "KEPT_MOST", 500)
    got = word_tokens.WordEncoder(PATH).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [ids_of(tokenizer, t)[:-1].tolist() for t in texts]


def test_differencing_is_near_equal_and_uses_every_piece_once():
    r = random.Random(2)
    for _ in range(200):
        n, m = r.randint(1, 60), r.randint(1, 12)
        lengths = np.array([r.randint(1, 100) for _ in range(n)])
        dealt = window_packing.difference(lengths, m)
        assert sorted(i for w in dealt for i in w) == list(range(n)) and len(dealt) <= m and all(dealt)
        sums = [int(lengths[w].sum()) for w in dealt] + [0] * (m - len(dealt))
        assert max(sums) - min(sums) <= max(lengths)
    # the textbook case: 8 7 6 5 4 by two windows differ by 2 after differencing
    sums = sorted(sum((8, 7, 6, 5, 4)[i] for i in w) for w in window_packing.difference([8, 7, 6, 5, 4], 2))
    assert sums == [14, 16]
    # three windows, where taking the largest first into the lightest gives a spread of 3
    assert {sum((5, 5, 4, 4, 3, 3, 3)[i] for i in w) for w in window_packing.difference([5, 5, 4, 4, 3, 3, 3], 3)} <= {8, 9, 10}


def test_windows_are_full_and_only_held_pieces_are_cut():
    r = random.Random(1)
    for _ in range(300):
        capacity, n = r.choice([4, 16, 100]), r.randint(0, 60)
        lengths = np.array([r.randint(1, capacity - 1) for _ in range(n)], np.int64)
        windows, rest = window_packing.fill_windows(lengths, np.array([r.random() < .2 for _ in range(n)], bool), capacity)
        assert all(sum(z - a for _, a, z in w) == capacity for w in windows)
        assert sum(z - a for _, a, z in rest) < capacity
        at = dict.fromkeys(range(n), 0)
        for i, a, z in sorted(p for w in [*windows, rest] for p in w):
            assert at[i] == a < z
            at[i] = z
        assert list(at.values()) == lengths.tolist()


def check_windows(rows, docs, tokenizer, capacity):
    """Every id in one piece; sequences gapless and within capacity; returns how many."""
    want = defaultdict(list)
    for i, t in docs:
        want[i].append(ids_of(tokenizer, t))
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    assert set(pieces) == set(want)
    for i, texts in want.items():
        left = sorted(pieces[i])
        for ids in sorted(texts, key=len):
            at = 0
            while at < len(ids):                         # a piece that goes on from here with these very ids
                fits = [p for p in left if p[0] == at and p[3] == len(ids) and zlib.crc32(ids[at:at + p[1]].tobytes()) == p[2]]
                assert fits, (i, at)
                left.remove(fits[0])
                at += fits[0][1]
            assert at == len(ids)
        assert not left
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


def test_small(spark, tokenizer):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("part", F.lit("clash")).withColumn("cut", F.lit(1))
    for capacity, group in ((4096, 256), (16, 4), (1, 2)):
        rows = window_packing.pack_windows(df.repartition(3), PATH, capacity=capacity, group_windows=group).collect()
        total = sum(r.length for r in rows)
        assert check_windows(rows, ROWS, tokenizer, capacity) == -(-total // capacity)      # as few as can be
        assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)


def test_documents_and_a_hot_length(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = window_packing.pack_windows(docs.repartition(5), PATH, with_ids=False).collect()
    n = check_windows(rows, [(r.doc_id, r.text) for r in docs.collect()], tokenizer, 4096)
    assert n == -(-sum(r.length for r in rows) // 4096)
    short = [r for r in rows if r.doc_tokens <= 4096]
    whole = sum(r.length == r.doc_tokens for r in short)
    assert whole >= 0.9 * len({r.doc_id for r in short})
    hot = spark.range(40_000).selectExpr("id AS doc_id", "CAST(null AS STRING) AS text")
    rows = window_packing.pack_windows(hot.repartition(2), PATH, with_ids=False).collect()
    assert len(rows) == 40_000 and len({r.sequence_id for r in rows}) == -(-40_000 // 4096)


def test_empty(spark):
    assert window_packing.pack_windows(spark.createDataFrame([], SCHEMA), PATH).count() == 0

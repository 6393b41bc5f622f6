"""Operator 1 against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rateweave.llm import suffix_dedup as S

SCHEMA = "doc_id long, text string"


def brute(rows, length=100):
    docs = sorted(((i if i is not None else 1 << 62), k, (t or "").encode()) for k, (i, t) in enumerate(rows))
    seen, out = set(), []
    for i, _, b in docs:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        runs = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((None if i == 1 << 62 else i, len(b), sum(gone), runs,
                    hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, parts=3, **kw):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("block", F.lit("clash")).withColumn("share", F.lit(1))
    got = S.remove_repeats(df.repartition(parts), keep_bytes=False, **kw).collect()
    return sorted((tuple(r) for r in got), key=str)


def corpus(seed, n=60):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdeé", k=r.randint(1, 7))) for _ in range(80)]
    prose = lambda k: " ".join(r.choice(words) for _ in range(k))
    shared = [prose(30) for _ in range(4)]
    line = prose(12)[:70]
    rows = [(0, None), (1, ""), (2, "a" * 900), (3, "ab" * 300 + "a" * 250), (4, "a" * 99), (5, "\0" * 240)]
    for i in range(6, n):
        parts = [prose(r.randint(1, 60))]
        if r.random() < 0.5:
            parts.append(r.choice(shared))
        parts += [line, prose(r.randint(1, 40))]
        if r.random() < 0.4:                             # short periodic stretches, equal to themselves only
            parts.insert(r.randint(0, 2), (r.choice(words) + r.choice([" ", "", f"{i}"])) * r.randint(8, 40))
        rows.append((i, r.choice(rows)[1] if r.random() < 0.2 else " ".join(parts)))
    return rows


def test_suffix_array_is_sorted_by_depth():
    rng = np.random.default_rng(0)
    for depth, letters in ((5, 2), (7, 3), (4, 1)):
        texts = [bytes(rng.integers(97, 97 + letters, rng.integers(depth, 60)).astype(np.uint8)) for _ in range(40)]
        flat = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        array = S.two_stage_suffix_array(flat, bounds, sizes - depth + 1, depth)
        assert len(array) == int((sizes - depth + 1).sum()) == len(set(array.tolist()))
        keys = [flat[p:p + depth].tobytes() for p in array]
        assert keys == sorted(keys)
        lcp = S.common_prefixes(flat, array, depth)
        assert all((a == b) == (c == depth) for a, b, c in zip(keys, keys[1:], lcp[1:]))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_hot_strings_are_ranked_last(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT_LEAST", 3)
    monkeypatch.setattr(S, "HOT_MOST", 10**9)
    rows = corpus(3)
    assert run(spark, rows, parts=5) == brute(rows)


def test_empty_table_and_repeated_rows(spark):
    assert run(spark, [(1, None)], parts=1) == brute([(1, None)])
    assert spark.createDataFrame([], SCHEMA).transform(S.remove_repeats).count() == 0
    rows = [(7, "x" * 150), (7, "x" * 150), (None, "x" * 150)]
    got = run(spark, rows, parts=1)
    assert sorted(r[2] for r in got) == [149, 150, 150]


def test_texts_and_blocks_are_shuffled_once(spark, monkeypatch):
    rows, tables, cut = corpus(4), [], S.cut_lineage
    monkeypatch.setattr(S, "cut_lineage", lambda df: tables.append(df.columns) or cut(df))
    df = S.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3), keep_bytes=False)
    assert sorted((tuple(r) for r in df.collect()), key=str) == brute(rows)
    assert tables and not any("data" in t for t in tables)      # candidate texts are in no written table
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 1                    # the blocks of both cogroups


def test_rows_of_a_block_hold_many_texts(spark, monkeypatch):
    rng = np.random.default_rng(6)
    kinds = [bytes(rng.integers(97, 123, 200).astype(np.uint8)).decode() for _ in range(400)]
    rows = [(k, kinds[k % 400] + kinds[7 * k % 400]) for k in range(1200)]
    monkeypatch.setattr(S, "PIECE_BYTES", 1 << 8)
    monkeypatch.setattr(S, "LEAST_SHARES", 2)
    monkeypatch.setattr(S, "_resolve", lambda length: lambda table: pa.table(
        {"block": table.column("block"), "spans": pa.array([x if x is None else str(len(x) // 8).encode() for x in
                                                            table.column("ids").to_pylist()], pa.binary())}))
    monkeypatch.setattr(S, "_finish", lambda keep: lambda left, right: pa.table(
        {"doc_id": [right.num_rows], "n_bytes": [sum(int(x or 0) for x in right.column("spans").to_pylist())],
         "n_removed": [0], "n_spans": [0], "kept_sha256": [""]}))
    df = spark.createDataFrame(rows, SCHEMA)
    got = S.remove_repeats(df.coalesce(1), keep_bytes=False).collect()
    assert sum(r.n_bytes for r in got) >= 8 * sum(r.doc_id for r in got) > 0    # texts, rows


def test_key_ranges_are_even():
    h = np.random.default_rng(8).integers(0, 1 << 64, 400_000, dtype=np.uint64)
    keys = np.unique(h[68:-68][S._largest_of(S._least_of(h, 69), 69) == h[68:-68]])
    for n in (1, 64, 700):
        bounds = S.key_bounds(n, 69)
        assert len(bounds) == n and bounds[0] == 0
        counts = np.diff(S.B.split_points(keys, bounds))
        assert counts.sum() == len(keys) and counts.max() <= 3 * len(keys) / n + 10


def test_pieces_of_a_share_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "PIECE_BYTES", 1 << 8)
    monkeypatch.setattr(S, "LEAST_SHARES", 3)
    rows = corpus(5)
    assert run(spark, rows) == brute(rows)


def test_ranges_within_a_block_go_through_any_share(spark):
    spans = S.B.squeeze(np.array([[5, 120]], np.int64).tobytes())
    none = pa.nulls(2, pa.binary())
    alone = pa.table({"share": [3, 3], "block": [8, 9], "ids": none, "starts": none, "lengths": none,
                      "pieces": none, "data": pa.array([spans, spans], pa.binary())})
    assert S._resolve(100)(alone).to_pydict() == {"block": [8, 9], "spans": [spans, spans]}
    text = np.random.default_rng(5).integers(97, 123, 130).astype(np.uint8).tobytes()
    sent = pa.table({"share": [3], "block": [8], "ids": [np.array([1, 2]).tobytes()],
                     "starts": [np.array([0, 400]).tobytes()], "lengths": [np.array([130, 130], np.int32).tobytes()],
                     "pieces": [bytes([7, 7])], "data": pa.array([S.B.squeeze(text * 2)], pa.binary())})
    got = S._resolve(100)(pa.concat_tables([alone, sent])).to_pydict()
    pairs = [np.frombuffer(S.B.expand(x), np.int64).tolist() for x in got["spans"]]
    assert sorted(zip(got["block"], pairs)) == [(8, [5, 120]), (8, [400, 530]), (9, [5, 120])]


def test_documents_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in S.remove_repeats(docs, keep_bytes=False).collect()), key=str)
    assert got == brute(rows)


def test_kept_bytes(spark):
    rows = corpus(9, 30)
    got = S.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed for r in got)

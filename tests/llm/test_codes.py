"""Operator 13: cover trees, exact assignment and whole results against plain numpy and SQL."""

import hashlib
import math
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rateweave.llm import cover_codes as V
from rateweave.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("n,width,k", [(1, 1, 1), (50, 2, 5), (2000, 4, 64), (3000, 1, 7)])
def test_trees_cover_and_whole_nodes_are_right(n, width, k):
    r = np.random.default_rng(n)
    rows = np.floor(r.normal(size=(n, 16 * width)) * 40).astype(np.int64)
    rows[n // 4: n // 2] = rows[0]                       # many equal rows
    points, sets = rows.reshape(n * 16, width), np.tile(np.arange(16), n)
    tree = V.Tree.unpack(V.build(points, sets).pack())
    assert sorted(tree.order.tolist()) == list(range(n * 16))
    for b, e, radius, c, m in zip(tree.begin, tree.end, tree.radius, tree.child, tree.children):
        own = tree.order[b:e]
        assert len(set(sets[own])) == 1
        assert abs(np.sqrt(V.squared(points[own], points[own[0]]).max()) - radius) < 1e-9
        if m:
            assert tree.begin[c] == b and tree.end[c + m - 1] == e and (tree.begin[c + 1:c + m] == tree.end[c:c + m - 1]).all()
            centres = points[tree.order[tree.begin[c:c + m]]]
            apart = V.squared(centres[:, None], centres[None])[~np.eye(m, dtype=bool)]
            assert m == 1 or (apart > radius ** 2 // 4).all()
            assert (tree.radius[c:c + m] <= radius / 2 + 1e-9).all()
    entries = points.reshape(n, 16, width).transpose(1, 0, 2)[:, :k].copy()
    whole, (places, best) = V.assign(tree, points, sets, entries)
    code = np.full(n * 16, -1)
    for b, e, x in whole:
        code[tree.order[V._ranges(b, e)]] = np.repeat(x, e - b)
    assert (code >= 0).any()
    assert (code[tree.order[places]] == -1).all()
    code[tree.order[places]] = best
    assert (code == V.squared(points[:, None], entries[sets]).argmin(axis=1)).all()


def brute(rows, parts=16, k=64, rounds=2):
    """The contract in plain Python."""
    kept = [(i, l, v) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(-(-max((len(v) for _, _, v in kept), default=0) // parts), 1)
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    own = [(i, l, [math.floor(256 * float(np.float32(x))) for x in v] + [0] * (parts * width - len(v))) for i, l, v in kept]
    x = np.array([v for _, _, v in own], np.int64).reshape(len(own), parts, width)
    books = x[:k].transpose(1, 0, 2).copy()
    near = lambda: ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)
    for _ in range(rounds):
        code = near().argmin(axis=2)
        for j in range(parts):
            for e in set(code[:, j]):
                books[j, e] = x[code[:, j] == e, j].sum(axis=0) // (code[:, j] == e).sum()
    code, error = near().argmin(axis=2), near().min(axis=2).sum(axis=1)
    by_label = defaultdict(int)
    for (_, l, _), e in zip(own, error):
        by_label[l] += int(e)
    said = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return sorted(((i, bytes(c.astype(np.uint8).tolist()).hex(), int(e), by_label[l], said)
                   for (i, l, _), c, e in zip(own, code, error)), key=str)


def result(df, **more):
    return sorted((tuple(r) for r in V.digest(df, **more).collect()), key=str)


def test_tables_against_brute_force_and_sql(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = result(df.repartition(5))
    assert got == brute([(r.vec_id, r.embedding, r.label) for r in df.collect()])
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.1/embeddings.parquet'")
    sql = con.execute(f"SELECT vec_id, code, error, label_error, codebooks_sha256 FROM ({queries.ORACLE_SQL['op13_cover_codes']})")
    assert got == sorted(sql.fetchall(), key=str)


@pytest.mark.parametrize("length", [16, 64, 50])
def test_odd_rows(spark, length):
    r = np.random.default_rng(length)
    vec = lambda: [float(np.float32(x)) for x in np.round(r.normal(size=length) * 0.1, 2)]
    hot = vec()
    rows = [(int(i), vec(), int(r.integers(3))) for i in r.integers(0, 90, 150)] + [(7, hot, None)] * 120
    rows += [(None, vec(), None), (None, vec(), 1), (1, None, 1), (2, [float("nan")] * length, 1), (3, [None] * length, 2),
             (4, [float("inf")] + [0.0] * (length - 1), 2), (-9, [-0.001] * length, 2), (5, [0.25] * 3, 0), (6, [], 0),
             (8, [60_000.0, -60_000.0] + [0.0] * (length - 2), 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("part", F.lit("clash")).withColumn("error", F.lit(1))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        assert result(df.repartition(3)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_and_unusable(spark):
    for rows in ([], [(1, None, 1), (2, [None], 2)]):
        assert V.digest(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_components_beyond_the_bounds_count_as_the_bounds(spark):
    rows = [(i, [float(s)] * 16, 0) for i, s in enumerate((3e38, -3e38, 70_000.0, 0.0))]
    got = {r.vec_id: r.code for r in V.digest(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[0] == got[2] != got[1] != got[3]

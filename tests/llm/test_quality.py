"""Operator 5: held-out accuracy, and documents that have odd shapes."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from rateweave.llm import quality as Q

SF = "/root/testdata/sf0.1"


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    good = y == 1
    return (rank[good].mean() - rank[~good].mean()) / len(s) + 0.5


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.scores(docs, Q.train(docs, labels))
    rows = got.join(labels, "doc_id").where("held_out").collect()
    y, s = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    assert len(rows) > 300 and auc(y, s) > 0.97
    assert (np.array([r.predicted for r in rows]) == (s >= 0.3)).all()
    assert ((s >= 0.3) == y).mean() > 0.95
    assert got.count() == docs.count()
    some = got.limit(50).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in some)


def test_odd_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "A" * 300_000), (4, "same text"), (5, "same text"), (None, "x\0y\n\n"),
                                  (4, "same text")], "doc_id long, text string").withColumn("label", F.lit("clash")) \
        .withColumn("x", F.lit(1)).withColumn("score", F.lit("old"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 1), (4, 1), (None, 1), (5, None), (99, 0)],
                                   "doc_id long, quality int")
    trees = Q.train(docs, labels)
    rows = Q.scores(docs, trees).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[1] == by[2] and by[4] == by[5] and [r.held_out for r in rows if r.doc_id is None] == [True]
    kept = Q.keep_good(docs, trees, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == 7


def test_no_labels_and_one_kind(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, "d")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in Q.scores(docs, Q.train(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in (1, 2, 3)], "doc_id long, quality int")
    (score,) = {r.score for r in Q.scores(docs, Q.train(docs, one)).collect()}
    assert 0.5 < score < 1
    assert Q.scores(docs.limit(0), Q.train(docs, one)).count() == 0


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, len(Q.FEATURES)))
    y = ((x[:, 3] > 0.2) ^ (x[:, 7] < -0.4)).astype(float)
    trees = Q.fit(x, y)
    s = trees.score(x)
    assert (((s > 0.5) == y).mean()) > 0.95
    for i in range(20):
        raw = trees.base
        for t in range(len(trees.feature)):
            node = 0
            while node < 2 ** Q.DEPTH - 1:
                node = 2 * node + (2 if x[i, trees.feature[t, node]] > trees.bound[t, node] else 1)
            raw += trees.value[t, node - (2 ** Q.DEPTH - 1)]
        assert abs(1 / (1 + np.exp(-raw)) - s[i]) < 1e-12


def test_statistics_by_hand():
    texts = ["Ab ab ab\nAb!", "", "7 |"]
    raw = "".join(texts).encode()
    starts = np.cumsum([0] + [len(t) for t in texts])
    x = dict(zip(Q.FEATURES, Q.statistics(np.frombuffer(raw, np.uint8), starts).T))
    assert x["upper"].tolist() == [2 / 12, 0, 0] and x["digit"][2] == 1 / 3 and x["bar"][2] == 1 / 3
    assert np.expm1(x["n_words"]).round().tolist() == [4, 0, 2] and x["distinct"][0] == 3 / 4 and x["top_word"][0] == 2 / 4
    assert x["distinct3"][0] == 1.0 and np.expm1(x["n_lines"]).round().tolist() == [2, 0, 1]


def test_rows_that_reach_the_driver_are_bounded(spark, monkeypatch):
    """One labelled id on very many documents, and one that is labelled very often."""
    seen = []
    monkeypatch.setattr(Q, "fit", lambda x, y: seen.append((x, y)) or Q.Trees(0.0, np.zeros((0, 7), int), np.zeros((0, 7)), np.zeros((0, 8))))
    docs = spark.range(3000).selectExpr("CASE WHEN id < 2900 THEN 1 ELSE id END AS doc_id", "concat('word ', id % 700) AS text")
    for labels in ([(1, 1)] + [(i, 0) for i in range(2900, 2950)], [(1, k % 2) for k in range(400)]):
        Q.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"), train_rows=500)
        x, y = seen[-1]
        assert len(x) == len(y) == 500
    few = spark.createDataFrame([(i, i % 2) for i in range(2900, 3000)], "doc_id long, quality int")
    kept = few.where(~Q.held_out(F.col("doc_id"))).count()
    for parts in (1, 5):
        Q.train(docs.repartition(parts), few, train_rows=500)
    (x, y), (x2, y2) = seen[-2:]
    assert len(y) == kept and np.array_equal(x, x2) and np.array_equal(y, y2)

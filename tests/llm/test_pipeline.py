"""The pipeline: each stage on its own input, against brute force."""

import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline as P  # noqa: E402
import test_decontaminate as D  # noqa: E402
import test_native as N  # noqa: E402
import test_ngram_join as J  # noqa: E402
import test_tokens as T  # noqa: E402

from rateweave.llm import quality  # noqa: E402
from rateweave.session import cut_lineage  # noqa: E402

SF = "/root/testdata/sf0.01"


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_on_the_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, now = docs.columns, docs
    seen = {}
    for name, stage in P.STAGES:
        out = cut_lineage(stage(spark, now, SF))
        seen[name] = (now, out)
        now = out
    for name, (_, out) in list(seen.items())[:-1]:
        assert out.columns == columns and out.dtypes == docs.dtypes

    before, after = map(rows, seen["quality"])
    trees = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in quality.scores(docs, trees).where("predicted = 1").collect()}
    assert set(after) == good and all(after[i] == before[i] for i in after)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sum(i in after for i, q in labels.items() if q) >= 0.97 * sum(labels.values())

    before, after = map(rows, seen["near_duplicates"])
    want = {c for _, _, c in J.brute([(i, r.text) for i, r in before.items()], P.WORDS, P.NUM, P.DEN)}
    assert set(after) == want and all(after[i] == before[i] for i in after) and len(after) < len(before)

    before, after = map(rows, seen["decontamination"])
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {r[0] for r in D.brute([(i, r.text) for i, r in before.items()], items) if r[5]}
    assert dirty and set(after) == set(before) - dirty and all(after[i] == before[i] for i in after)

    before, after = map(rows, seen["pii"])
    assert set(before) == set(after)
    touched = 0
    for i, r in after.items():
        counts, _, spans = N.brute_pii(before[i].text)
        if not spans:
            assert r == before[i]
        else:
            touched += 1
            assert N.brute_pii(r.text)[0] == (0, 0, 0, 0) and r.text != before[i].text
    assert touched

    before, out = seen["packing"]
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(T.PATH)
    pieces = out.collect()
    n = T.check_packing(pieces, [(r.doc_id, r.text) for r in before.collect()], t, 2048)
    assert n <= 1.01 * -(-sum(r.length for r in pieces) // 2048) + 1
    again = P.run(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in again) == Counter((r.doc_id, r.piece, r.ids_crc32) for r in pieces)


ODD = [(1, None, "a"), (2, "", None), (None, "no id at all", "b"), (3, "one two three four five six", "c"),
       (3, "one two three four five six", "c"), (4, "mail me a.b@c.de", "d"), (5, "x " * 50_000, "e")]


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_odd_rows_and_empty_tables(spark, name):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string") \
        .withColumn("block", F.lit(7)).withColumn("hits", F.lit(None).cast("binary")).select("block", "text", "lang", "doc_id", "hits")
    stage = dict(P.STAGES)[name]
    out = stage(spark, docs, SF)
    n = out.count()
    if name == "packing":
        assert n >= len(ODD)
    else:
        assert out.columns == docs.columns and n == {"near_duplicates": 6}.get(name, n) <= len(ODD)
        if name in ("decontamination", "pii"):
            assert n == len(ODD)
            assert {r.doc_id: r.text for r in out.collect()}[1] is None
    assert stage(spark, docs.limit(0), SF).count() == 0

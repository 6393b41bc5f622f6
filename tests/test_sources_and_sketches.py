"""Rejected records, the choice of multi-line reading, laid-out curves and mergeable profiles."""

import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rateweave.operators import select, sketches
from rateweave.plans import jobs
from rateweave.sources import io
from rateweave.sources.listings import load_listings


def write(path, text):
    path.write_text(text)
    return str(path)


def test_every_record_is_good_or_rejected(spark, tmp_path):
    p = write(tmp_path / "a.csv", 'id,NAME,price,minimum nights,instant_bookable\n1,"a ""b"", c",$5,2,true\n2,x,$6,two,true\n3,y\n'
              '4,"line\nbreak",$7, ,maybe\nx5,z,,3,\n6,,,NaN,false\n7,q,$8,1,true,more\n8,"",$1,1e3,FALSE\n')
    good, rejected = io.split_listings(spark, p)
    assert {r.listing_id: (r.name, r.price, r.minimum_nights, r.instant_bookable) for r in good.collect()} == {
        1: ('a "b", c', "$5", 2.0, True), 8: (None, "$1", 1000.0, False)}
    said = {(json.loads(r.record)["listing_id"] if r.record.startswith("{") else r.record): list(r.reasons) for r in rejected.collect()}
    assert said == {"2": ["minimum_nights: 'two' is no double"], "3,y": ["columns"], "4": ["instant_bookable: 'maybe' is no boolean"],
                    "x5": ["listing_id: 'x5' is no bigint"], "6": ["minimum_nights: 'NaN' is no double"], "7,q,$8,1,true,more": ["columns"]}
    assert all(r.file.endswith("a.csv") for r in rejected.collect())
    io.ingest_listings(spark, p, str(tmp_path / "good"), str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "good")).count() + spark.read.json(str(tmp_path / "bad")).count() == 8
    empty = write(tmp_path / "e.csv", "id,price\n")
    assert [x.count() for x in io.split_listings(spark, empty)] == [0, 0]


def test_one_file_is_split_unless_a_quote_stays_open(spark, tmp_path):
    plain = write(tmp_path / "p.csv", 'id,name\n' + "".join(f'{i},"n, ""{i}"""\n' for i in range(4000)))
    broken = write(tmp_path / "b.csv", 'id,name\n1,"a\nb"\n2,c\n')
    assert not io.open_quotes(spark, [plain]) and io.open_quotes(spark, [broken]) and io.open_quotes(spark, [plain, broken])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        whole = io.read_listings(spark, plain)
        assert whole.rdd.getNumPartitions() > 1 and whole.count() == 4000
        assert whole.where("name = concat('n, \"', listing_id, '\"')").count() == 4000
        assert io.read_listings(spark, plain, multi_line=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.name for r in io.read_listings(spark, broken).collect()} == {"a\nb", "c"}


def test_curves_laid_out_by_listing_need_no_shuffle(spark, tmp_path):
    curve = jobs.target_curve(load_listings(spark, SF_SMALL))
    laid = io.write_curve_by_listing(curve, "curve_by_listing_test", str(tmp_path / "c"), 4)
    try:
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        for of in (lambda c: select.optimize_curve(c, nearest="now"), lambda c: select.nearest_demand(c, "now"),
                   lambda c: jobs.recommendation_job(c, change_pct=20.0, true_before=True)):
            assert "Exchange" not in plan(of(laid)) and "Exchange" in plan(of(curve))
            assert sorted(map(str, of(laid).collect())) == sorted(map(str, of(curve).collect()))
        assert len(list((tmp_path / "c").glob("*.parquet"))) == 4
    finally:
        spark.sql("DROP TABLE curve_by_listing_test")


def frame(spark, seed, n):
    r = random.Random(seed)
    odd = [None, float("nan"), float("inf"), 0.0, -0.0, 1e-310, 1e308, -1e308, 5e-200]
    rows = [(r.choice(odd) if r.random() < .1 else r.lognormvariate(0, 3) * r.choice([1, 1, -1]), r.choice([None, "", f"t{r.randint(0, n)}"]))
            for _ in range(n)]
    return spark.createDataFrame(rows, "x double, t string")


def test_merged_states_are_the_state_of_one_pass(spark, tmp_path):
    parts = [frame(spark, k, 400) for k in range(4)] + [frame(spark, 9, 400).limit(0)]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    for p in parts:
        sketches.add_to_state(str(tmp_path / "s"), p, ["x"], ["t"])
    key = lambda df: sorted(tuple(r) for r in df.collect())
    merged = sketches.read_state(spark, str(tmp_path / "s"))
    assert key(merged) == key(sketches.merge_states(sketches.profile_state(whole, ["x"], ["t"])))
    assert key(sketches.merge_states(merged.unionByName(merged).where("kind = 'distinct'"))) == key(merged.where("kind = 'distinct'"))
    facts = {(r.column, r.kind): r.n for r in merged.where("kind in ('rows', 'missing')").collect()}
    sound = [v for (v,) in whole.select("x").collect() if v is not None and v == v and abs(v) != float("inf")]
    assert facts["x", "rows"] == facts["t", "rows"] == whole.count() and facts["x", "missing"] == whole.count() - len(sound)
    sound.sort()
    for r in sketches.quantile_estimates(merged, [0.0, 0.1, 0.5, 0.9, 1.0]).collect():
        want = sound[int(r.p * (len(sound) - 1))]
        assert abs(r.value - want) <= sketches.ALPHA * abs(want) * (1 + 1e-9) + sketches.LEAST
    (got,) = sketches.distinct_estimates(merged).collect()
    want = whole.select("t").where("t is not null").distinct().count()
    assert abs(got.n_distinct - want) <= 4 * 1.04 / 64 * want


@pytest.mark.parametrize("n", [1, 50, 3000, 60_000, 400_000])
def test_distinct_counts_at_all_sizes(spark, n):
    df = spark.range(n).selectExpr("id AS a", "CAST(id AS STRING) AS b", "concat('x', id) AS c").unionByName(
        spark.range(n // 2).selectExpr("id AS a", "CAST(id AS STRING) AS b", "concat('x', id) AS c"))
    for r in sketches.distinct_estimates(sketches.profile_state(df, texts=["a", "b", "c"])).collect():
        assert abs(r.n_distinct - n) <= max(4 * 1.04 / 64 * n, 0.5), r

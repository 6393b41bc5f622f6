"""F-10 against brute force over every option combination (<= 6 listings)."""

import itertools

import numpy as np
import pytest

from rateweave.operators import budget, select


def _curve(spark, seed, n_listings=5, n_opts=4):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n_listings):
        cur = float(rng.integers(20, 200))
        for j in range(n_opts):
            cand = round(cur * float(rng.uniform(0.7, 1.3)), 2)
            rev = float(rng.uniform(0, 100))
            rows.append((i, j, cur, cand, rev))
    return rows, spark.createDataFrame(
        rows, "listing_id long, option_id int, current_price double, candidate_price double, expected_revenue double")


def _brute(rows, cap):
    by = {}
    for i, j, cur, cand, rev in rows:
        by.setdefault(i, []).append((abs(cand - cur) / (cur or 1.0) * 100.0, rev))
    best = None
    for combo in itertools.product(*by.values()):
        cost = sum(c for c, _ in combo)
        val = sum(v for _, v in combo)
        if cost <= cap + 1e-9 and (best is None or val > best):
            best = val
    return best


@pytest.mark.parametrize("seed,avg_pct", [(1, 3.0), (2, 8.0), (3, 15.0), (4, 5.0), (5, 100.0)])
def test_budget_against_brute_force(spark, seed, avg_pct):
    rows, c = _curve(spark, seed)
    sel, s = budget.select_with_budget(c, max_avg_pct=avg_pct)
    opt = _brute(rows, 5 * avg_pct)
    if opt is None:
        assert s["status"] == "infeasible"
        return
    got = sel.collect()
    assert len(got) == 5
    used = sum(r["abs_price_change_pct"] for r in got)
    value = sum(r["expected_revenue"] for r in got)
    assert used <= s["budget"] + 1e-9
    assert value <= opt + 1e-9
    spread = max(max(r[4] for r in rows if r[0] == i) - min(r[4] for r in rows if r[0] == i) for i in range(5))
    assert value >= opt - spread             # less than one step is lost
    assert s["upper_bound"] >= opt - 1e-6
    assert s["gap"] == pytest.approx(s["upper_bound"] - value, abs=1e-6)


def test_non_binding_budget_equals_unconstrained(spark):
    rows, c = _curve(spark, 11)
    sel, s = budget.select_with_budget(c, max_avg_pct=1000.0)
    free = {r["listing_id"]: r["option_id"] for r in select.select_best_option(c).collect()}
    assert {r["listing_id"]: r["option_id"] for r in sel.collect()} == free
    assert s["multiplier"] == 0.0 and s["gap"] == 0.0


def test_equal_listings_use_the_budget_in_any_unit(spark):
    rows = [(i, j, 100.0, 100.0 + 5.0 * j, 100.0 + 9.0 * j - j * j) for i in range(1000) for j in range(4)]
    schema = "listing_id long, option_id int, current_price double, candidate_price double, expected_revenue double"
    c = spark.createDataFrame(rows, schema)
    sel, s = budget.select_with_budget(c, max_avg_pct=10.0)
    assert s["budget"] == 10_000.0 and s["budget"] - 5.0 < s["used_cost"] <= s["budget"]
    assert s["upper_bound"] - s["objective"] <= s["gap"] + 1e-9 < 10.0
    big = c.withColumn("expected_revenue", c["expected_revenue"] * 1e10)
    sel2, s2 = budget.select_with_budget(big, max_avg_pct=10.0)
    a, b = ({r["listing_id"]: r["option_id"] for r in x.collect()} for x in (sel, sel2))
    assert a == b and s2["used_cost"] == s["used_cost"]
    small, s3 = budget.select_with_budget(c, max_avg_pct=10.0, gather=7)      # the cut found range by range
    assert {r["listing_id"]: r["option_id"] for r in small.collect()} == a and s3["used_cost"] == s["used_cost"]


def test_infeasible_listings_are_counted(spark):
    rows, c = _curve(spark, 3)
    flagged = c.withColumn("feasible", c["listing_id"] != 2)
    sel, s = budget.select_with_budget(flagged, max_avg_pct=100.0, feasible="feasible")
    assert s["num_listings"] == 5 and s["num_infeasible"] == 1 and sorted(r["listing_id"] for r in sel.collect()) == [0, 1, 3, 4]


def test_all_steps_fit_and_only_ties_are_dear(spark):
    # without demand every option earns nothing, and the lowest option id is a change of 30 %
    rows = [(i, j, 100.0, 70.0 + 10.0 * j, 0.0) for i in range(40) for j in range(4)]
    rows += [(i, j, 100.0, 100.0 + j, 50.0 + j * (6.0 - j) + i / 100) for i in range(40, 80) for j in range(4)]
    c = spark.createDataFrame(
        rows, "listing_id long, option_id int, current_price double, candidate_price double, expected_revenue double")
    found = {}
    for gather in (5, 50, 100_000):
        sel, s = budget.select_with_budget(c, max_avg_pct=1.5, gather=gather)
        found[gather] = {r["listing_id"]: r["option_id"] for r in sel.collect()}, s
        assert (s["status"], s["multiplier"], s["used_cost"], s["gap"]) == ("optimal", 0.0, 120.0, 0.0)
    assert found[5] == found[50] == found[100_000]
    assert set(found[5][0].values()) == {3} and len(found[5][0]) == 80


def test_refined_budget_is_the_optimum_of_few_listings(spark):
    import itertools
    import random

    r = random.Random(11)
    better = 0
    for trial in range(8):
        n = r.randint(2, 8)
        rows = []
        for i in range(n):
            rows += [(i, k, 100.0, 100.0 + r.choice([-1, 1]) * r.randint(0, 3000) / 100, round(r.uniform(1, 100), 2)) for k in range(r.randint(2, 4))]
        curve = spark.createDataFrame(rows, "listing_id long, option_id int, current_price double, candidate_price double, expected_revenue double")
        mean = r.uniform(6, 14)
        sel, s = budget.select_with_budget(curve, mean, refine=True)
        _, plain = budget.select_with_budget(curve, mean)
        by = [[(round(abs(c - p) / p * 100, 6), v) for i, _, p, c, v in rows if i == k] for k in range(n)]
        fits = [sum(v for _, v in x) for x in itertools.product(*by) if sum(c for c, _ in x) <= n * mean + 1e-9]
        if not fits:
            assert s["status"] == plain["status"] == "infeasible"
            continue
        got = sel.collect()
        assert len(got) == n and abs(sum(x.expected_revenue for x in got) - max(fits)) < 1e-6
        assert s["used_cost"] <= s["budget"] + 1e-6 and s["gap"] <= plain["gap"] + 1e-9 and s["upper_bound"] >= max(fits) - 1e-6
        better += s["objective"] > plain["objective"] + 1e-9
    assert better

"""Operator 4 against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rateweave.llm import ngram_join as J
from rateweave.llm.components import components

SCHEMA = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(rows, n):
    out = []
    for _, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    return out


def brute(rows, n, num, den):
    sets = sets_of(rows, n)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = d if least[root(i)] is None else min(d, least[root(i)])
    return sorted(((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows, n, num, den, parts=4):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("block", F.lit("clash")).withColumn("group", F.lit(1))
    got = J.ngram_components(df.repartition(parts), words=n, num=num, den=den)
    return sorted((tuple(r) for r in got.collect()), key=str)


def corpus(seed, n=120):
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcé", k=r.randint(1, 4))) for _ in range(60)]
    rows = [(0, None), (1, ""), (2, "One two"), (3, "one  TWO"), (4, "x"), (5, "same " * 400), (6, "same " * 30),
            (None, "no id one two three four"), (7, "no id one two three four"), (8, "\x0b \x1c"), (8, "\x0b \x1c")]
    for i in range(10, n):
        if r.random() < 0.5 and i > 20:
            words = (r.choice(rows)[1] or "q").split(" ")
            for _ in range(r.randint(0, 4)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            words += [r.choice(vocabulary) for _ in range(r.choice([0, 0, 1, 3]))]
        else:
            words = [r.choice(vocabulary) for _ in range(r.randint(1, 150))]
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed,n,num,den", [(1, 3, 90, 100), (2, 5, 80, 100), (3, 1, 60, 100)])
def test_against_brute_force(spark, seed, n, num, den):
    rows = corpus(seed)
    assert run(spark, rows, n, num, den) == brute(rows, n, num, den)


def test_large_groups_are_cut(spark, monkeypatch):
    monkeypatch.setattr(J, "GROUP_SETS", 5)
    monkeypatch.setattr(J.linked_documents, "__defaults__", (5, 80, 100, 5))
    rows = corpus(5)
    assert run(spark, rows, 3, 90, 100) == brute(rows, 3, 90, 100)


def test_followers_link_beyond_their_leader_at_low_similarity():
    sets = [np.array(x, np.uint64) for x in ([1], [1, 10, 11], [2], [2, 10, 11])]
    assert J.SetGroup(sets, 1, 3).roots().tolist() == [0, 0, 0, 0]


def test_group_links_equal_brute_force():
    r = random.Random(7)
    for trial in range(30):
        base = [r.randrange(1 << 60) for _ in range(r.randint(2, 120))]
        sets = []
        for _ in range(r.randint(2, 60)):
            s = set(base if r.random() < 0.8 or not sets else r.choice(sets))
            for _ in range(r.randint(0, max(1, len(base) // 10))):
                s.discard(r.choice(base))
            s |= {r.randrange(1 << 60) for _ in range(r.randint(0, max(1, len(base) // 10)))}
            sets.append(s or {1})
        num, den = r.choice([(90, 100), (80, 100), (55, 100), (40, 100), (1, 3), (1, 5)])
        roots = J.SetGroup([np.array(sorted(s), np.uint64) for s in sets], num, den).roots()
        parent = list(range(len(sets)))

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i
        for i in range(len(sets)):
            for j in range(i):
                if den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                    a, b = root(i), root(j)
                    parent[max(a, b)] = min(a, b)
        assert roots.tolist() == [root(i) for i in range(len(sets))]


@pytest.mark.parametrize("counted", [0.0, 0.5, 100.0])
def test_any_share_of_counted_shingles_finds_all_links(spark, monkeypatch, counted):
    monkeypatch.setattr(J, "COUNTED", counted)
    rows = corpus(11)
    assert run(spark, rows, 3, 90, 100) == brute(rows, 3, 90, 100)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (50, 60), (60, 100), (7, 7), (200, 201), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 60: 50, 100: 50, 200: 200, 201: 200}


def test_empty_table(spark):
    assert J.ngram_components(spark.createDataFrame([], SCHEMA)).count() == 0
    assert run(spark, [(1, "a b c"), (2, None)], 3, 90, 100, parts=1) == [(1, 1, 1), (2, 0, 2)]
    few = [(1, "a b"), (2, "A  b"), (3, "c")]
    assert run(spark, few, 5, 80, 100, parts=3) == brute(few, 5, 80, 100) == [(1, 1, 1), (2, 1, 1), (3, 1, 3)]


def brute_links(rows, n, num, den):
    """n_links of each row, and each two different linked sets with common shingles and numbers of rows."""
    sets = [frozenset(s) for s in sets_of(rows, n)]
    linked = lambda a, b: bool(a and b) and den * len(a & b) >= num * len(a | b)
    counts = [sum(linked(a, b) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)]
    different = list(dict.fromkeys(sets))
    ids = {s: [d for (d, _), x in zip(rows, sets) if x == s] for s in different}
    about = lambda s: (min((d for d in ids[s] if d is not None), default=None), len(ids[s]))
    pairs = [(sorted([about(a), about(b)], key=str), len(a & b)) for i, a in enumerate(different)
             for b in different[:i] if linked(a, b)]
    return counts, sorted(pairs, key=str)


def dense(seed):
    """Groups of near copies, most linked with most others, and some exact copies."""
    r = random.Random(seed)
    rows = [(0, None), (None, "")]
    for g in range(3):
        base = [f"w{g}x{k}" for k in range(r.choice([60, 120]))]
        for _ in range(40):
            own = list(base)
            for _ in range(r.randint(0, 3)):
                own[r.randrange(len(own))] = f"n{r.randrange(5)}"
            rows.append((len(rows) if r.random() < 0.95 else None, " ".join(own)))
    return rows + [(len(rows) + k, r.choice(rows)[1]) for k in range(20)]


@pytest.mark.parametrize("make,n,num,den,group_sets", [
    (corpus, 3, 90, 100, 1000), (dense, 3, 90, 100, 1000), (dense, 3, 90, 100, 7), (dense, 5, 80, 100, 7), (corpus, 1, 40, 100, 9),
    (corpus, 1, 50, 100, 1000)])
def test_all_links_against_brute_force(spark, make, n, num, den, group_sets):
    rows = make(4)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("group", F.lit("clash")).repartition(4)
    counts, pairs = brute_links(rows, n, num, den)
    got = J.ngram_links(df, words=n, num=num, den=den, group_sets=group_sets).collect()
    want = sorted(((d, len(s), c) for (d, _), s, c in zip(rows, sets_of(rows, n), counts)), key=str)
    assert sorted(((r.doc_id, r.n_shingles, r.n_links) for r in got), key=str) == want
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, n, num, den)
    found = J.ngram_pairs(df, words=n, num=num, den=den, group_sets=group_sets).collect()
    assert sorted([(sorted([(r.doc_a, r.n_a), (r.doc_b, r.n_b)], key=str), r.common) for r in found], key=str) == pairs
    assert all(r.similarity * den >= num - 1e-9 for r in found) and pairs


def test_links_of_an_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert J.ngram_links(none).count() == 0 and J.ngram_pairs(none).count() == 0

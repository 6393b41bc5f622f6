"""Operator 12: damage, faults and cheapest repairs against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rateweave.llm import conversation_repair as R
from rateweave.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {0: "su", 1: "u", 2: "a", 3: "u"}
STATE = {"s": 1, "u": 2, "a": 3}


def brute_edits(rows):
    """Least (cost, edits) over all edits by (rows done, state); rows are (initial, must go, truncated)."""
    best = {(0, 0): (0, "")}
    for i in range(len(rows) + 1):
        for _ in range(4):                               # insertions, until nothing gets better
            for st in range(4):
                if (i, st) in best:
                    c, s = best[i, st]
                    to = (i, STATE[NEXT[st][-1]])
                    best[to] = min(best.get(to, (1 << 60, "")), (c + 2, s + "I"))
        if i == len(rows):
            break
        initial, gone, cut = rows[i]
        for st in range(4):
            if (i, st) not in best:
                continue
            c, s = best[i, st]
            ways = [("D", 3, st)]
            if not gone:
                ways += [("R", 2 + cut, STATE[NEXT[st][-1]])]
                if initial in NEXT[st] and initial:
                    ways += [("K", cut, STATE[initial])]
            for what, more, after in ways:
                best[i + 1, after] = min(best.get((i + 1, after), (1 << 60, "")), (c + more, s + what))
    return min(best[len(rows), st] for st in (0, 3) if (len(rows), st) in best)


def every_edit(initials, cut, most):
    """Least (cost, edits) by trying all edits of cost up to ``most``, without any table."""
    found = []

    def go(i, st, c, s):
        if c > most:
            return
        if i == len(initials) and st in (0, 3):
            found.append((c, s))
        role = NEXT[st][-1]
        go(i, STATE[role], c + 2, s + "I")
        if i < len(initials):
            go(i + 1, st, c + 3, s + "D")
            go(i + 1, STATE[role], c + 2 + cut[i], s + "R")
            if initials[i] in NEXT[st]:
                go(i + 1, STATE[initials[i]], c + cut[i], s + "K")
    go(0, 0, 0, "")
    return min(found)


def test_search_finds_the_cheapest_and_least_edits():
    r = random.Random(3)
    for _ in range(400):
        n = r.randint(0, 4)
        initials, cut = "".join(r.choice("sxuuaa") for _ in range(n)), [r.random() < .3 for _ in range(n)]
        got = R.cheapest(initials, cut)
        assert got == every_edit(initials, cut, got[0])
    for _ in range(2000):
        n = r.randint(0, 30)
        initials = "".join(r.choice(r.choice(["sxua", "ua", "u", "x", "uuua"])) for _ in range(n))
        cut = [r.random() < .3 for _ in range(n)]
        assert R.cheapest(initials, cut) == brute_edits([(i, False, c) for i, c in zip(initials, cut)])


def test_bounds_are_never_above_what_the_rest_costs():
    r = random.Random(4)
    for _ in range(200):
        n = r.randint(0, 8)
        initials, cut = "".join(r.choice("sxua") for _ in range(n)), [r.random() < .3 for _ in range(n)]
        for i, b in enumerate(R._bounds(initials, cut)):
            assert b[0] <= brute_edits([(x, False, c) for x, c in zip(initials[i:], cut[i:])])[0]


@pytest.mark.parametrize("letters", ["u", "x", "sua", "uuua"])
def test_thousands_of_rows(letters):
    r = random.Random(5)
    n = 5000
    cost, edits = R.cheapest("".join(r.choice(letters) for _ in range(n)), [r.random() < .3 for _ in range(n)])
    assert sum(c in "KRD" for c in edits) == n and cost < 3 * n


def brute(rows):
    """The contract in plain Python."""
    said = lambda x: " " if x is None else str(x)
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        own = convs[conv]
        k = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            own += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        seen, kinds = set(), []
        for _, role, text in own:
            solid = re.sub("[\x20\x09-\x0d]", "", text)
            kinds.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "o")
            seen.add((role, text))
        cost, audit = brute_edits([(x[1][:1], k in "bd", k == "t") for x, k in zip(own, kinds)])
        st, lines, i = 0, [], 0
        for what in audit:
            role = {"u": "user", "a": "assistant", "s": ""}[NEXT[st][-1]]
            if what == "I":
                lines.append(role + ":")
                st = STATE[role[0]]
            else:
                if what in "KR":
                    role = own[i][1] if what == "K" else role
                    lines.append(f"{role}:{own[i][2]}")
                    st = STATE[role[0]]
                i += 1
        known = [x[0] for x in own if x[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out.append((conv, gaps, *(kinds.count(k) for k in "bdt"), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in R.digest(df).collect()), key=str)


def test_tables(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/conversations.parquet")
    got = sorted((tuple(r) for r in queries.op12_conversation_repair(spark, "/root/testdata/sf0.1").collect()), key=str)
    assert got == brute([tuple(r) for r in rows.collect()])
    assert sum(r[6] for r in got) and {c for r in got for c in r[7]} == set("DIKR")


def test_odd_rows(spark):
    r = random.Random(6)
    roles = ["user", "assistant", "system", "usher", "tool", "", None, "assistant"]
    texts = ["Hi.", "no end", "", " \t\n", None, "é?!", "Hi.", "End. \r\n", "1.2", " ", "x" * 30_000 + "."]
    rows = [(r.choice([None, *range(40)]), r.choice([None, *range(-3, 9)]), r.choice(roles), r.choice(texts)) for _ in range(1500)]
    rows += rows[:200] + [(99, 5, "user", "Hi.")] * 300 + [(98, None, "user", "one.")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(7)).withColumn("copies", F.lit("clash"))
    assert result(df.repartition(6)) == brute(rows)
    assert R.digest(df.limit(0)).count() == 0


def test_a_long_conversation_spans_batches(spark):
    r = random.Random(7)
    rows = [(1, t, r.choice(["user", "assistant"]), f"Turn {t % 900}.") for t in range(4000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")

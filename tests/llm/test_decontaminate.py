"""Operator 7 against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from rateweave.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id string, text string"


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, size=13):
    windows = {}
    for name, t in items:
        w = words(t)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(name or "")
    out = []
    for doc, t in docs:
        w, hit, names = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i:i + n]))
                if found:
                    hit |= set(range(i, i + n))
                    names |= found
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def corpus(seed):
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abÉé1", k=r.randint(1, 3))) for _ in range(40)]
    prose = lambda k: r.choice([" ", ", ", "\n", " (" ]).join(r.choice(vocabulary) for _ in range(k))
    items = [(str(i), prose(r.randint(3, 40))) for i in range(20)]
    items += [("20", items[0][1]), ("21", None), ("22", "zz"), (None, "unique short item"), ("22", "zz yy"), ("3", "aa " * 20)]
    docs = [(0, None), (1, ""), (2, "..."), (3, "ZZ"), (4, "a unique, SHORT item!"), (5, "aa " * 500), (5, "aa " * 500), (None, items[1][1])]
    for i in range(6, 60):
        t = prose(r.randint(1, 200))
        if r.random() < 0.6:
            part = words(r.choice(items)[1])
            t += " " + " ".join(part[r.randint(0, 3):]) + " " + prose(r.randint(1, 300))
        docs.append((i, t))
    return docs, items


def run(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, DOCS).withColumn("hits", F.lit(b"clash")).withColumn("n_words", F.lit(0))
    got = D.contamination(d.repartition(3), spark.createDataFrame(items, ITEMS), with_matches=False, **kw)
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    docs, items = corpus(seed)
    assert run(spark, docs, items) == brute(docs, items)
    long = [x for x in items if len(words(x[1])) > 1 or not x[1]]
    assert run(spark, docs, long, window=4) == brute(docs, long, 4)


def test_chunks_of_the_benchmark(spark, monkeypatch):
    monkeypatch.setattr(D, "CHUNK_BYTES", 300)
    docs, items = corpus(3)
    assert run(spark, docs, items) == brute(docs, items)


def test_kept_documents_and_matches(spark):
    docs, items = corpus(4)
    frame = spark.createDataFrame(docs, DOCS).withColumn("hits", F.lit("clash")).select("hits", "text", "doc_id")
    bench = spark.createDataFrame(items, ITEMS)
    want = sorted(str(r[0]) for r in brute(docs, items) if not r[5])
    kept = D.decontaminate(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == want
    texts = dict(items)
    for r in D.contamination(frame, bench).where("n_hit > 0").collect():
        for m in r.matches:
            if m.item_id in texts and m.item_id not in ("22", "3"):
                own = next(t for i, t in docs if i == r.doc_id)
                a, b = words(texts[m.item_id]), words(own)
                assert a[m.item_word:m.item_word + m.n_words] == b[m.doc_word:m.doc_word + m.n_words]


def test_empty_tables(spark):
    none, docs = spark.createDataFrame([], ITEMS), [(1, "a b"), (2, None)]
    assert run(spark, docs, [("1", None)]) == brute(docs, [("1", None)])
    assert D.contamination(spark.createDataFrame(docs, DOCS), none).where("contaminated").count() == 0
    assert D.contamination(spark.createDataFrame([], DOCS), spark.createDataFrame([("1", "a b")], ITEMS)).count() == 0


def brute_matches(docs, items, size=13):
    """For each document the longest matches (item, first word there, first word here, words)."""
    out = []
    for doc, t in docs:
        w, on = words(t), {}
        for name, text in items:
            own = words(text)
            n = min(size, len(own))
            for p in range(max(1, len(own) - size + 1) if own else 0):
                for q in range(len(w) - n + 1):
                    if w[q:q + n] == own[p:p + n]:
                        on.setdefault((name or "", q - p), set()).update(range(q, q + n))
        found = []
        for (name, shift), places in on.items():
            for a in sorted(x for x in places if x - 1 not in places):
                z = a
                while z in places:
                    z += 1
                found.append((name, a - shift, a, z - a))
        out.append((doc, sorted(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [1, 300, 4 << 20])
def test_matches_of_all_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(D, "CHUNK_BYTES", chunk if chunk > 1 else 150)
    docs, items = corpus(6)
    # windows of one item that meet on a diagonal, with texts in several chunks
    items = [x for x in items if x[0] != "3"] + [("r", "q1 q2 q3 q4 q5 q6 q7"), ("r", "q1 q2 q3 q4 q5 q6 q7 q8 q9")]
    docs = [x for x in docs if x[0] != 5] + [(99, "a q1 q2 q3 q4 q5 q6 q7 q8 q9 b")]
    frame = spark.createDataFrame(docs, DOCS).withColumn("matches", F.lit("clash"))
    got = D.contamination(frame.repartition(3), spark.createDataFrame(items, ITEMS)).collect()
    want = brute_matches(docs, items)
    assert sorted([(r.doc_id, [tuple(m) for m in r.matches]) for r in got], key=str) == want
    assert sum(len(m) for _, m in want) > 20
    assert all((r.n_items > 0) == bool(r.matches) for r in got)


def test_a_query_returns_matches(spark):
    from rateweave.llm import queries

    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op7_decontaminate_matches"](spark, sf).collect()
    plain = queries.QUERIES["op7_decontaminate"](spark, sf)
    assert sorted((tuple(r[c] for c in plain.columns) for r in got), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert any(r.matches for r in got) and all(len({m.item_id for m in r.matches}) == r.n_items for r in got)


def test_chunks_are_bounded_and_texts_taken_once(spark, monkeypatch):
    monkeypatch.setattr(D, "CHUNK_BYTES", 2000)
    same, r = "one text that very many items have and that stands in a document", random.Random(7)
    items = [(f"i{k}", same) for k in range(300)] + [(f"j{k}", " ".join(r.choices("bcdefgh", k=r.randint(1, 60)))) for k in range(400)]
    items += [("long", "x y z " * 2000)]
    bench = spark.createDataFrame(items, ITEMS)
    texts = D._texts(bench, "item_id", "text")
    ranges = D._ranges(texts, 0, 1 << 48)
    sizes = [sum(len(t.encode()) + sum(map(len, names)) for names, t in D._chunk(texts, *ab)) for ab in ranges]
    chunks = [t for ab in ranges for _, t in D._chunk(texts, *ab)]
    assert sorted(chunks) == sorted({t for _, t in items})
    assert all(n <= 2000 or len(D._chunk(texts, *ab)) == 1 for n, ab in zip(sizes, ranges))
    assert len(ranges) <= 4 * sum(sizes) // 2000 + 4
    monkeypatch.setattr(D, "CHUNK_BYTES", 20_000)
    docs = [(1, "see " + same), (2, "nothing here"), (3, "y z x y z x y z x y z x y z x y")]
    assert run(spark, docs, items) == brute(docs, items)
    (one,) = [m for m in D.contamination(spark.createDataFrame(docs, DOCS), bench).where("doc_id = 1").collect()]
    assert len(one.matches) == one.n_items == 300

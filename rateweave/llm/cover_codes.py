"""Operator 13: product codes of vectors by Lloyd rounds over partition-local cover trees.

Components become the integers floor(256 x).  A vector is cut into equal parts, and each part
position has a codebook of its own, which begins with that part of the vectors of least id.  In
a round each part goes to the nearest entry (ties to the lower index) and each entry becomes the
floored mean of its parts; entries without parts stay.

Each batch of rows gets a cover tree for each part position, built once and written, before the
first round: a node at a level covers its parts within that level's radius, its children cover
them within half of it and stand further apart than that, and the first child has its parent's
place.  A node keeps the number and the sum of its parts (the tree lists parts in order, so a
node is a range and its sum the difference of two cumulative sums) and the largest distance
within it.  In a round a whole node goes to an entry if no other can be nearer to any part of it
by the triangle inequality; only ambiguous nodes descend, and what is left at the leaves is
compared exactly, in integers.  Sums by entry leave the tasks; nothing else does, and codebooks,
of bounded size, go to the tasks.

Rows without a vector, or with a null or non-finite component, are left out.  Vectors of unequal
lengths count as if zeros followed, up to the next multiple of the number of parts (at least
one); integers count within +-2**24.  Rows of one id, null ids last, begin by their vectors.
Repeated rows count each.  An empty table, or one without a usable vector, gives no rows.  Only
the three named columns are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.operators.joins import attach_stats
from rateweave.session import cut_lineage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Integers count within these bounds, so that squared distances stay exact.
MOST = 1 << 24
#: Nodes of so few parts are leaves.
LEAF = 8
#: Integers of one batch at most, so that a tree stays in memory.
BATCH_VALUES = 1 << 20

TREE_SCHEMA = "ids binary, no_id binary, labels binary, no_label binary, points binary, tree binary"


# ---- cover trees

class Tree:
    """Cover trees of many point sets at once: nodes by level, each a range of ``order``."""

    def __init__(self, order: np.ndarray, begin: np.ndarray, end: np.ndarray, radius: np.ndarray, child: np.ndarray,
                 children: np.ndarray):
        self.order, self.begin, self.end, self.radius = order, begin, end, radius
        self.child, self.children = child, children      # number of the first child and how many (0: a leaf)

    def pack(self) -> bytes:
        arrays = [self.order, self.begin, self.end, self.child, self.children, self.radius]
        sizes = np.array([len(a) for a in arrays], np.int64)
        return b"".join([sizes.tobytes(), *(a.astype(np.int64).tobytes() for a in arrays[:-1]),
                         self.radius.astype(np.float64).tobytes()])

    @classmethod
    def unpack(cls, raw: bytes) -> Tree:
        sizes, at, out = np.frombuffer(raw, np.int64, 6), 48, []
        for k, n in enumerate(sizes.tolist()):
            out.append(np.frombuffer(raw, np.float64 if k == 5 else np.int64, n, at))
            at += 8 * n
        order, begin, end, child, children, radius = out
        return cls(order, begin, end, radius, child, children)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows, as integers."""
    d = a - b
    return np.einsum("...i,...i->...", d, d)


def build(points: np.ndarray, sets: np.ndarray, leaf: int = LEAF) -> Tree:
    """Cover trees of the points (int64 rows) of each set; ``sets`` numbers them 0, 1, ... without
    gaps.  All sets and all nodes of a level are split together."""
    order = np.argsort(sets, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(sets[order]) > 0]))
    begin, end = first, np.append(first[1:], len(order))
    levels = []
    while len(begin):
        node = np.repeat(np.arange(len(begin)), end - begin)
        at = np.concatenate([np.arange(a, z) for a, z in zip(begin, end)]) if len(begin) < 64 else \
            np.arange(len(node)) + np.repeat(begin - np.concatenate([[0], np.cumsum(end - begin)[:-1]]), end - begin)
        far = squared(points[order[at]], points[order[begin[node]]])
        widest = np.maximum.reduceat(far, np.concatenate([[0], np.cumsum(end - begin)[:-1]]))
        split = (end - begin > leaf) & (widest > 0)
        levels.append([begin, end, np.sqrt(widest.astype(np.float64)), split])
        if not split.any():
            break
        # children cover within half of the node's radius and stand further apart than that
        near = widest // 4
        left = split[node]
        todo, own = at[left], node[left]
        parts, numbers, child_of = [], [], []
        made = 0
        while len(todo):
            lead = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            which = np.cumsum(np.concatenate([[False], own[1:] != own[:-1]]))
            inside = squared(points[order[todo]], points[order[todo[lead]][which]]) <= near[own]
            parts.append(todo[inside])
            numbers.append(made + which[inside])
            child_of.append(own[lead])
            made += len(lead)
            todo, own = todo[~inside], own[~inside]
        parent = np.concatenate(child_of)
        places, number = np.concatenate(parts), np.concatenate(numbers)
        rank = np.empty(made, np.int64)
        by_parent = np.argsort(parent, kind="stable")
        rank[by_parent] = np.arange(made)
        sort = np.argsort(rank[number], kind="stable")
        fresh = order.copy()
        fresh[np.sort(places)] = order[places[sort]]
        sizes = np.bincount(rank[number], minlength=made)
        spots = np.sort(places)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        order, begin = fresh, spots[starts]
        end = begin + sizes
        levels[-1].append(np.bincount(parent, minlength=len(split)))
    out_begin, out_end, radius, child, children = [], [], [], [], []
    base = 0
    for b, e, r, split, *more in levels:
        base += len(b)
        n = more[0] if more else np.zeros(len(b), np.int64)
        out_begin.append(b)
        out_end.append(e)
        radius.append(r)
        children.append(n)
        child.append(base + np.concatenate([[0], np.cumsum(n)[:-1]]))
    join = lambda xs: np.concatenate(xs).astype(np.int64) if xs else np.zeros(0, np.int64)
    return Tree(order, join(out_begin), join(out_end), np.concatenate(radius) if radius else np.zeros(0), join(child),
                join(children))


def nearest(points: np.ndarray, entries: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Index of the nearest entry of each point, the lowest of equals; entries[which[i]] are those of
    point i."""
    out = np.empty(len(points), np.int64)
    for a in range(0, len(points), 1 << 14):
        z = a + (1 << 14)
        out[a:z] = squared(points[a:z, None, :], entries[which[a:z]]).argmin(axis=1)
    return out


def assign(tree: Tree, points: np.ndarray, sets: np.ndarray, entries: np.ndarray
           ) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], tuple[np.ndarray, np.ndarray]]:
    """Nodes that go to an entry as a whole, as (begin, end, entry) in ``tree.order``, and places in it
    with their entries, for those compared one by one.  ``entries`` are by set."""
    whole = []
    singles = []
    now = np.flatnonzero(np.diff(np.concatenate([[-1], sets[tree.order[tree.begin]]])) > 0)[:len(entries)] \
        if len(tree.begin) else np.zeros(0, np.int64)
    while len(now):
        ambiguous = []
        for a in range(0, len(now), 1 << 14):
            some = now[a: a + (1 << 14)]
            at = tree.order[tree.begin[some]]
            far = np.sqrt(squared(points[at][:, None, :], entries[sets[at]]).astype(np.float64))
            best = far.argmin(axis=1)
            least = far[np.arange(len(some)), best]
            far[np.arange(len(some)), best] = np.inf
            clear = far.min(axis=1) - least > 2 * tree.radius[some] * (1 + 1e-9) + 1e-6
            whole.append((tree.begin[some[clear]], tree.end[some[clear]], best[clear]))
            ambiguous.append(some[~clear])
        some = np.concatenate(ambiguous)
        leaves = some[tree.children[some] == 0]
        singles.append(_ranges(tree.begin[leaves], tree.end[leaves]))
        inner = some[tree.children[some] > 0]
        now = _ranges(tree.child[inner], tree.child[inner] + tree.children[inner])
    places = np.concatenate(singles) if singles else np.zeros(0, np.int64)
    at = tree.order[places]
    return whole, (places, nearest(points[at], entries, sets[at]))


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of some ranges."""
    n = end - begin
    return np.arange(int(n.sum())) + np.repeat(begin - np.concatenate([[0], np.cumsum(n)[:-1]]), n) if len(n) else \
        np.zeros(0, np.int64)


# ---- as a job

def _trees(parts: int, width: int):
    """Rows (id, label, vector) to trees: each batch one row, or some if it is large."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(BATCH_VALUES // (parts * width), 1)
            for a in range(0, batch.num_rows, step):
                some = batch.slice(a, step)
                n = some.num_rows
                vectors = np.zeros((n, parts * width), np.int64)
                column = some.column(2)
                flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                sizes = np.diff(np.asarray(column.offsets))
                rows = np.repeat(np.arange(n), sizes)
                vectors[rows, _ranges(np.zeros(n, np.int64), sizes.astype(np.int64))] = \
                    np.clip(np.floor(flat * SCALE), -MOST, MOST).astype(np.int64)
                points = vectors.reshape(n * parts, width)
                tree = build(points, np.tile(np.arange(parts), n))
                keep = []
                for k in (0, 1):
                    gone = np.asarray(some.column(k).is_null())
                    keep += [some.column(k).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(), gone.tobytes()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], pa.binary()) for x in [*keep, points.astype(np.int32).tobytes(), tree.pack()]],
                    names=[c.split()[0] for c in TREE_SCHEMA.split(", ")])
    return fn


def _open(batch: pa.RecordBatch, i: int, parts: int, width: int) -> tuple[Tree, np.ndarray, np.ndarray]:
    points = np.frombuffer(batch.column("points")[i].as_py(), np.int32).astype(np.int64).reshape(-1, width)
    return Tree.unpack(batch.column("tree")[i].as_py()), points, np.tile(np.arange(parts), len(points) // parts)


def _sums(shared, parts: int, width: int):
    """Trees to the number and the sum of the parts of each (position, entry) of a whole partition."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = shared.value
        total = np.zeros((parts, entries.shape[1], width + 1), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                tree, points, sets = _open(batch, i, parts, width)
                whole, (places, best) = assign(tree, points, sets, entries)
                known = np.ones((len(points), width + 1), np.int64)
                known[:, 1:] = points[tree.order]
                cumulative = np.concatenate([np.zeros((1, width + 1), np.int64), np.cumsum(known, axis=0)])
                for begin, end, entry in whole:
                    np.add.at(total, (sets[tree.order[begin]], entry), cumulative[end] - cumulative[begin])
                np.add.at(total, (sets[tree.order[places]], best), known[places])
        part, entry = np.nonzero(total[:, :, 0])
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32())]
                + [pa.array(total[part, entry, k]) for k in range(width + 1)],
                names=["part", "entry", "n"] + [f"s{k}" for k in range(width)])
    return fn


def _codes(shared, parts: int, width: int):
    """Trees to one row for each vector: id, label, code and error."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                tree, points, sets = _open(batch, i, parts, width)
                code = np.empty(len(points), np.int64)
                whole, (places, best) = assign(tree, points, sets, entries)
                for begin, end, entry in whole:
                    code[tree.order[_ranges(begin, end)]] = np.repeat(entry, end - begin)
                code[tree.order[places]] = best
                error = squared(points, entries[sets, code]).reshape(-1, parts).sum(axis=1)
                digits = 2 if entries.shape[1] <= 256 else 4
                said = code.astype(">u1" if digits == 2 else ">u2").tobytes().hex()
                n, w = len(error), digits * parts
                columns = []
                for c in ("ids", "labels"):
                    gone = np.frombuffer(batch.column("no_id" if c == "ids" else "no_label")[i].as_py(), bool)
                    columns.append(pa.array(np.frombuffer(batch.column(c)[i].as_py(), np.int64), mask=np.array(gone)))
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([said[w * k: w * k + w] for k in range(n)], pa.string()), pa.array(error)],
                    names=["vec_id", "label", "code", "error"])
    return fn


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label and vector of the rows whose vector holds numbers only."""
    own = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                      F.col(vector_col).cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return own.where(F.col("vector").isNotNull() & ~odd)


def fit(trees: DataFrame, entries: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (position, entry, component) after some rounds."""
    sc = trees.sparkSession.sparkContext
    parts, _, width = entries.shape
    schema = "part int, entry int, n long, " + ", ".join(f"s{k} long" for k in range(width))
    names = ["n"] + [f"s{k}" for k in range(width)]
    for _ in range(rounds):
        sums = trees.mapInArrow(_sums(sc.broadcast(entries), parts, width), schema) \
            .groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in names]).collect()
        entries = entries.copy()
        for r in sums:                                   # at most one row for each entry
            entries[r["part"], r["entry"]] = [r[f"s{k}"] // r["n"] for k in range(width)]
    return entries


def codebooks_sha256(entries: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, entries.reshape(-1).tolist())).encode()).hexdigest()


def encode(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code and error of each usable row, and the codebooks."""
    own = usable(rows, id_col, vector_col, label_col)
    longest = own.agg(F.max(F.size("vector"))).first()[0]
    width = max(-(-int(longest or 0) // parts), 1)
    first = own.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    books = np.zeros((parts, max(len(first), 1), width), np.int64)
    for k, r in enumerate(first):
        v = np.zeros(parts * width, np.int64)
        v[: len(r.vector)] = np.clip(np.floor(np.array(r.vector, np.float64) * SCALE), -MOST, MOST)
        books[:, k] = v.reshape(parts, width)
    trees = cut_lineage(own.mapInArrow(_trees(parts, width), TREE_SCHEMA))
    if first:
        books = fit(trees, books, rounds)
    shared = rows.sparkSession.sparkContext.broadcast(books)
    return trees.mapInArrow(_codes(shared, parts, width), "vec_id long, label long, code string, error long"), books


def digest(rows: DataFrame, **names) -> DataFrame:
    """vec_id, code, error, the error of all rows of its label (null beyond a long) and the hash of the codebooks."""
    coded, books = encode(rows, **names)
    coded = cut_lineage(coded.withColumn("group", F.coalesce(F.col("label").cast("string"), F.lit(""))))
    by_label = coded.groupBy("group").agg(F.try_sum("error").alias("label_error"))
    return attach_stats(coded, by_label, ["group"]).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))

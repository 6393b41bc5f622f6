"""Operator 5: quality classifier, histogram gradient-boosted trees over document statistics.

Every whole text becomes ``FEATURES``: shares of kinds of characters, lengths and
variety of words, repeated n-grams and lines.  Trees grow on histograms of binned
statistics with the logistic loss.  The fitted trees are flat arrays (feature, bound,
children, value), and numpy walks all trees for all documents of a batch at once.

Training takes at most ``train_rows`` labelled rows, the smallest by a hash of the id:
a documented bound.  Only those documents are read for their statistics there, joined
by a broadcast of that many ids at most.  Scoring reads every text and shuffles nothing.

Null and empty texts have all statistics 0 and are scored like others.  Equal texts have
equal scores.  Rows with a null label or id don't teach.  Without labels every score is
0.5; with labels of one kind, trees stay empty and the score is the smoothed share.  A
repeated row is scored twice, and teaches once for each label row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateweave.llm import blocks as B

TRAIN_ROWS = 20_000
THRESHOLD = 0.3
BINS = 64
#: Text that is worked on at once.
PART_BYTES = 1 << 20
ROUNDS = 80
DEPTH = 4
RATE = 0.12
LEAST_HESSIAN = 2.0
RIDGE = 1.0

FEATURES = ["n_chars", "lower", "upper", "digit", "space", "newline", "stop", "comma", "bang", "bar", "symbol", "other",
            "high", "n_words", "word_mean", "word_long", "word_short", "word_marked", "distinct", "top_word",
            "distinct3", "distinct8", "n_lines", "line_mean", "distinct_lines", "capital_words", "words_a_stop"]

_KIND = np.full(256, 10, np.uint8)
for _k, _chars in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r\x0b\x0c",
                             b".?", b",;:'\"()-", b"!", b"|"]):
    _KIND[list(_chars)] = _k
_KIND[list(b"#$%&*@^~<>{}[]\\/_=+`")] = 9
_KIND[128:] = 11
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _distinct(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """How many distinct hashes each document has, and how often its commonest occurs."""
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, d[at], np.diff(np.append(at, len(h))))
    return np.bincount(d[at], minlength=n), top


def statistics(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The FEATURES of texts that begin at ``starts`` (and end at its last value)."""
    n = len(starts) - 1
    size = np.diff(starts)
    per = np.maximum(size, 1)
    out = np.zeros((n, len(FEATURES)))
    doc = np.repeat(np.arange(n), size)
    kinds = np.bincount(doc * 12 + _KIND[data], minlength=12 * n).reshape(n, 12)
    out[:, 0] = np.log1p(size)
    out[:, 1:13] = kinds / per[:, None]
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    begin = np.flatnonzero(word & (~np.concatenate([[False], word])[:-1] | edge[:-1]))
    end = np.flatnonzero(word & (~np.append(word[1:], False) | edge[1:])) + 1
    prefix = B.prefix_hash(data)
    owner = doc[begin]
    words = np.bincount(owner, minlength=n)
    many = np.maximum(words, 1)
    length = end - begin
    h = B.range_hash(prefix, begin, end)
    mean = lambda x: np.bincount(owner, weights=x, minlength=n) / many
    marked = np.concatenate([[0], np.cumsum((_KIND[data] >= 5) & (_KIND[data] <= 10))])
    capital = np.concatenate([[0], np.cumsum(_KIND[data] == 1)])
    out[:, 13] = np.log1p(words)
    out[:, 14], out[:, 15], out[:, 16] = mean(length), mean(length > 12), mean(length <= 2)
    out[:, 17] = mean((marked[end] - marked[begin]) > 0)
    distinct, top = _distinct(h, owner, n)
    out[:, 18], out[:, 19] = distinct / many, top / many
    for col, k in ((20, 3), (21, 8)):
        if len(h) >= k:
            g = h[: len(h) - k + 1].copy()
            for j in range(1, k):
                g = B.mix(g * np.uint64(0xD6E8FEB86659FD93) + h[j: len(h) - k + 1 + j])
            same = owner[: len(g)] == owner[k - 1:]
            found, _ = _distinct(g[same], owner[: len(g)][same], n)
            out[:, col] = found / np.maximum(words - k + 1, 1)
    line = data != 10
    lb = np.flatnonzero(line & (~np.concatenate([[False], line])[:-1] | edge[:-1]))
    le = np.flatnonzero(line & (~np.append(line[1:], False) | edge[1:])) + 1
    lines = np.bincount(doc[lb], minlength=n)
    out[:, 22] = np.log1p(lines)
    out[:, 23] = np.log1p(size / np.maximum(lines, 1))
    out[:, 24] = _distinct(B.range_hash(prefix, lb, le), doc[lb], n)[0] / np.maximum(lines, 1)
    out[:, 25] = mean((capital[end] - capital[begin]) * 2 > length)
    out[:, 26] = words / (1 + kinds[:, 5])
    return out


class Trees:
    """Boosted trees as flat arrays: a row for each tree, a column for each node."""

    def __init__(self, base: float, feature: np.ndarray, bound: np.ndarray, value: np.ndarray):
        self.base, self.feature, self.bound, self.value = base, feature, bound, value

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1; in a complete binary tree node i has children 2 i + 1 and 2 i + 2."""
        if not len(self.feature):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        tree = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        row = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.bound[tree, node])
        return 1 / (1 + np.exp(-(self.base + self.value[tree, node - (2 ** DEPTH - 1)].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Grow ROUNDS trees of depth DEPTH on histograms of BINS bins."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    inner, leaves, n_features = 2 ** DEPTH - 1, 2 ** DEPTH, x.shape[1]
    empty = np.zeros((0, inner))
    if len(np.unique(y)) < 2:
        return Trees(base, empty.astype(int), empty, np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(n_features)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    cell = binned + np.arange(n_features) * BINS
    raw = np.full(len(y), base)
    features, bounds, values = [], [], []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        feature, bound = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(DEPTH):
            first, width = 2 ** level - 1, 2 ** level
            at = ((node - first)[:, None] * (n_features * BINS) + cell).ravel()
            shape = (width, n_features, BINS)
            hg = np.bincount(at, np.repeat(g, n_features), width * n_features * BINS).reshape(shape).cumsum(axis=2)
            hh = np.bincount(at, np.repeat(h, n_features), width * n_features * BINS).reshape(shape).cumsum(axis=2)
            tg, th = hg[:, :1, -1:], hh[:, :1, -1:]
            gain = hg ** 2 / (hh + RIDGE) + (tg - hg) ** 2 / (th - hh + RIDGE) - tg ** 2 / (th + RIDGE)
            gain[(hh < LEAST_HESSIAN) | (th - hh < LEAST_HESSIAN)] = 0
            for k in range(width):
                f, b = divmod(int(gain[k].argmax()), BINS)
                if gain[k, f, b] > 1e-9 and b < len(edges[f]):
                    feature[first + k], bound[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > bound[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + RIDGE)
        raw += value[leaf]
        features.append(feature)
        bounds.append(bound)
        values.append(value)
    return Trees(base, np.array(features), np.array(bounds), np.array(values))


def held_out(id_col: Column) -> Column:
    """Rows kept from training: crc32 of the id as text divisible by 5; a null id is held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _statistics_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    B.make_room()
    for batch in batches:
        flat, offsets = B.string_parts(batch.column(1))
        for i, j in B.cuts(offsets, PART_BYTES):
            x = statistics(flat[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(list(x), pa.list_(pa.float64())),
                                              batch.column(2).slice(i, j - i)], names=["label", "x", "place"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", train_rows: int = TRAIN_ROWS) -> Trees:
    """Trees from the labelled documents that are not held out, at most ``train_rows`` rows of them (by
    a hash of id and text), however often an id repeats in either table."""
    own = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("label")) \
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id"))) \
        .orderBy(F.xxhash64("id"), "id", "label").limit(train_rows)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(own), "id").select("label", "text", F.xxhash64("id", "text", "label").alias("place")) \
        .mapInArrow(_statistics_rows, "label double, x array<double>, place long") \
        .orderBy("place", "x").limit(train_rows).select("label", "x").toArrow()
    x = np.array(rows.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    y = rows.column("label").to_numpy().astype(float)
    order = np.lexsort((*x.T, y))                        # the same trees however Spark dealt the rows
    return fit(x[order], y[order])


def _scorer(shared):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        B.make_room()
        for batch in batches:
            flat, offsets = B.string_parts(batch.column(batch.num_columns - 1))
            parts = [np.zeros(0)]
            for i, j in B.cuts(offsets, PART_BYTES):
                parts.append(shared.value.score(statistics(flat[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(parts))],
                                             names=[*batch.schema.names[:-1], "score"])
    return fn


def scores(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text",
           threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document: doc_id, held_out, score, predicted."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    return own.mapInArrow(_scorer(shared), "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, trees: Trees, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    at = docs.columns.index(text_col)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        B.make_room()
        for batch in batches:
            flat, offsets = B.string_parts(batch.column(at))
            for i, j in B.cuts(offsets, PART_BYTES):
                s = shared.value.score(statistics(flat[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]))
                yield batch.slice(i, j - i).filter(pa.array(s >= threshold))
    return docs.mapInArrow(fn, docs.schema)

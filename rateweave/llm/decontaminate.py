"""Operator 7: benchmark decontamination with suffix arrays of the training text.

A task sorts the word suffixes of its documents, some MB at a time (a shard), and
binary-searches every suffix of the benchmark's texts in each shard.  A benchmark window
is ``window`` consecutive words of an item, or the whole of an item that has fewer; the
range of suffixes that begin with it gives all its occurrences.  Windows that overlap on
one diagonal join into the longest verbatim match with its places.

Words are compared by 64-bit hashes.  Only suffixes that begin like some benchmark
suffix (with its first two words; one, if an item has a single word) go into the array:
no other can hold an occurrence.  Nothing is shuffled, so no key can be hot.  The
benchmark is the stated test set.  Items of one text are taken together, and texts in
chunks of at most ``CHUNK_BYTES`` of text and ids (a longer text alone), one broadcast after
the other; what a chunk has found (places hit, items, matches) stays with its document for
the next.  So each chunk after the first costs a pass that writes the documents anew.

Null and empty texts have no words and are clean.  Null item texts have no windows; null
item ids are written as an empty string.  Repeated items count as the one id they have.
Repeated documents are judged one by one.  An empty benchmark leaves all clean.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.llm import blocks as B
from rateweave.session import cut_lineage

WINDOW = 13
CHUNK_BYTES = 4 << 20
SHARD_BYTES = 2 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that begin at ``starts`` (and end at its last value), and their text."""
    data = _LOWER[data]
    word = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    before = np.concatenate([[False], word])[:-1]
    begin = np.flatnonzero(word & (~before | edge[:-1]))
    end = np.flatnonzero(word & (~np.append(word[1:], False) | edge[1:])) + 1
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return B.range_hash(B.prefix_hash(data), begin, end), np.searchsorted(starts, begin, side="right") - 1


class TestSet:
    """The benchmark's windows, ready for binary search."""

    def __init__(self, items: list[tuple[list[str], str]], window: int):
        """``items`` are texts, each with the ids that have it."""
        self.window = window
        self.names = [names for names, _ in items]
        flat, offsets = B.string_parts(pa.array([t for _, t in items], pa.string()))
        hashes, owner = word_hashes(flat, offsets)
        self.vocabulary = np.unique(hashes)
        self.bits = max(1, (len(self.vocabulary)).bit_length())
        self.per = 64 // self.bits
        self.columns = -(-window // self.per)
        codes = (np.searchsorted(self.vocabulary, hashes) + 1).astype(np.int64)
        at = np.searchsorted(owner, np.arange(len(items) + 1))
        found: dict[tuple, int] = {}
        self.texts: list[set[int]] = []
        self.places: list[list[tuple[int, int]]] = []
        single = False
        for i in range(len(items)):
            own = codes[at[i]: at[i + 1]].tolist()
            single |= len(own) == 1
            for p in range(max(1, len(own) - window + 1) if own else 0):
                k = found.setdefault(tuple(own[p: p + window]), len(found))
                if k == len(self.texts):
                    self.texts.append(set())
                    self.places.append([])
                self.texts[k].add(i)
                self.places[k].append((i, p))
        self.lengths = np.array([len(w) for w in found], np.int64)
        grid = np.zeros((len(found), window), np.int64)
        for k, w in enumerate(found):
            grid[k, : len(w)] = w
        self.low = self.keys(grid)
        top = (1 << self.bits) - 1
        self.high = self.keys(np.where(np.arange(window)[None, :] < self.lengths[:, None], grid, top), top)
        self.pairs = None if single or not len(found) else np.unique((grid[:, 0] << 32) | grid[:, 1])

    def keys(self, grid: np.ndarray, pad: int = 0) -> np.ndarray:
        """Rows of word codes as byte strings that sort like them."""
        out = np.zeros((len(grid), self.columns), ">u8")
        for c in range(self.columns):
            acc = np.zeros(len(grid), np.uint64)
            for j in range(self.per):
                k = c * self.per + j
                v = grid[:, k] if k < grid.shape[1] else np.full(len(grid), pad)
                acc = (acc << np.uint64(self.bits)) | v.astype(np.uint64)
            out[:, c] = acc
        return np.ascontiguousarray(out).view(f"S{8 * self.columns}").ravel()

    def suffix_array(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the suffixes of a shard in the order of their first ``window`` words, and their keys."""
        own = np.flatnonzero(codes[: len(codes) - self.window])
        if self.pairs is not None:
            pair = (codes[own] << 32) | codes[own + 1]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            own = own[self.pairs[at] == pair]
        columns = []
        for c in range(self.columns):
            acc = np.zeros(len(own), np.uint64)
            for j in range(self.per):
                k = c * self.per + j
                acc = (acc << np.uint64(self.bits)) | (codes[own + k].astype(np.uint64) if k < self.window else np.uint64(0))
            columns.append(acc)
        order = np.lexsort(columns[::-1])
        keys = np.stack([c[order] for c in columns], axis=1).astype(">u8")
        return own[order], np.ascontiguousarray(keys).view(f"S{8 * self.columns}").ravel()

    def search(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every occurrence of every window in a shard: its place and the window's number."""
        if not len(self.low):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        array, keys = self.suffix_array(codes)
        first = np.searchsorted(keys, self.low, side="left")
        many = np.searchsorted(keys, self.high, side="right") - first
        window = np.repeat(np.arange(len(many)), many)
        inside = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        return array[np.repeat(first, many) + inside], window


def _merged(pairs: np.ndarray) -> np.ndarray:
    """Sorted ranges without overlaps from ranges (start, end)."""
    if not len(pairs):
        return pairs.reshape(0, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.concatenate([[True], pairs[1:, 0] > reach[:-1]])
    return np.stack([pairs[new, 0], reach[np.append(new[1:], True)]], axis=1)


def _matches(test: TestSet, place: np.ndarray, window: np.ndarray) -> list[tuple[str, int, int, int]]:
    """Longest verbatim matches in one document: item, first word there, first word here, words."""
    on: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    for p, w in zip(place.tolist(), window.tolist()):
        for text, at in test.places[w]:
            on[text, p - at].append((p, p + int(test.lengths[w])))
    out = []
    for (text, shift), ranges in on.items():
        out += [(text, int(a - shift), int(a), int(z - a)) for a, z in _merged(np.array(sorted(set(ranges))))]
    return _joined([], [(name, *match) for text, *match in out for name in test.names[text]])


MATCH = ("item_id", "item_word", "doc_word", "n_words")
MATCHES = "array<struct<item_id: string, item_word: bigint, doc_word: bigint, n_words: bigint>>"


def _match_array(found: list[list[tuple]]) -> pa.Array:
    kind = pa.list_(pa.struct([("item_id", pa.string()), *[(c, pa.int64()) for c in MATCH[1:]]]))
    return pa.array([[dict(zip(MATCH, m)) for m in x] for x in found], kind)


def _joined(found: list[tuple], more: list[tuple]) -> list[tuple]:
    """Matches of two chunks: ranges of one item on one diagonal that overlap are one match (texts
    of a repeated item id may be in several chunks)."""
    if not more:
        return found
    on: dict[tuple[str, int], list[tuple[int, int]]] = defaultdict(list)
    for name, there, here, n in found + more:
        on[name, here - there].append((here, here + n))
    return sorted((name, int(a - shift), int(a), int(z - a)) for (name, shift), ranges in on.items()
                  for a, z in _merged(np.array(sorted(set(ranges)))))


def _examine(shared, text_at: int, state_at: int | None, last: bool, finish, with_matches: bool):
    """mapInArrow step for one chunk of the benchmark."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test: TestSet = shared.value
        B.make_room()
        for batch in batches:
            flat, offsets = B.string_parts(batch.column(text_at))
            for i, j in B.cuts(offsets, SHARD_BYTES):
                own = batch.slice(i, j - i)
                starts = offsets[i: j + 1] - offsets[i]
                hashes, doc = word_hashes(flat[offsets[i]: offsets[j]], starts)
                n_words = np.bincount(doc, minlength=j - i)
                first = np.concatenate([[0], np.cumsum(n_words)])[:-1]
                codes = np.zeros(len(hashes) + (j - i) + test.window + 1, np.int64)  # a zero ends each document
                if len(test.vocabulary):
                    at = np.minimum(np.searchsorted(test.vocabulary, hashes), len(test.vocabulary) - 1)
                    codes[np.arange(len(hashes)) + doc] = np.where(test.vocabulary[at] == hashes, at + 1, 0)
                place, window = test.search(codes)
                base = first + np.arange(j - i)
                owner = np.searchsorted(base, place, side="right") - 1
                order = np.argsort(owner, kind="stable")
                points = np.searchsorted(owner[order], np.arange(j - i + 1))
                results = []
                hits = own.column(state_at).to_pylist() if state_at is not None else [b""] * (j - i)
                names = own.column(state_at + 1).to_pylist() if state_at is not None else [[]] * (j - i)
                known = [[tuple(m.values()) for m in x] for x in own.column(state_at + 2).to_pylist()] \
                    if state_at is not None and with_matches else [[]] * (j - i)
                for d in range(j - i):
                    mine = order[points[d]: points[d + 1]]
                    ranges, items, matches = np.frombuffer(hits[d], np.int64).reshape(-1, 2), names[d], known[d]
                    if len(mine):
                        p, w = place[mine] - base[d], window[mine]
                        ranges = _merged(np.concatenate([ranges, np.stack([p, p + test.lengths[w]], axis=1)]))
                        texts = set().union(*(test.texts[k] for k in set(w.tolist())))
                        items = sorted(set(items).union(*(test.names[k] for k in texts)))
                        if with_matches:
                            matches = _joined(matches, _matches(test, p, w))
                    results.append((int(n_words[d]), ranges, items, matches))
                if last:
                    yield finish(own, results)
                else:
                    kept = own.columns if state_at is None else own.columns[:state_at]
                    found = [_match_array([r[3] for r in results])] if with_matches else []
                    yield pa.RecordBatch.from_arrays(
                        [*kept, pa.array([np.ascontiguousarray(r[1]).tobytes() for r in results], pa.binary()),
                         pa.array([r[2] for r in results], pa.list_(pa.string())), *found],
                        names=[*own.schema.names[: len(kept)], "hits", "items", *["matches"] * len(found)])
    return fn


def _judged(result) -> tuple[int, bool]:
    n_hit = int((result[1][:, 1] - result[1][:, 0]).sum())
    return n_hit, n_hit > 0 and 20 * n_hit >= result[0]


def _report(with_matches: bool):
    def finish(rows: pa.RecordBatch, results) -> pa.RecordBatch:
        judged = [_judged(r) for r in results]
        cols = [rows.column(0), pa.array([r[0] for r in results], pa.int64()),
                pa.array([h for h, _ in judged], pa.int64()), pa.array([len(r[2]) for r in results], pa.int64()),
                pa.array([hashlib.sha256(",".join(r[2]).encode()).hexdigest() for r in results]),
                pa.array([c for _, c in judged], pa.bool_())]
        names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
        if with_matches:
            cols.append(_match_array([r[3] for r in results]))
            names.append("matches")
        return pa.RecordBatch.from_arrays(cols, names=names)
    return finish


def _keep(rows: pa.RecordBatch, results) -> pa.RecordBatch:
    return rows.filter(pa.array([not _judged(r)[1] for r in results], pa.bool_()))


def _ranges(texts: DataFrame, lo: int, hi: int) -> list[tuple[int, int]]:
    """Ranges of ``place`` within [lo, hi) that hold at most CHUNK_BYTES each, or a single text."""
    own = texts.where(F.col("place").between(lo, hi - 1))
    total, n = own.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not n:
        return []
    if n == 1 or total <= CHUNK_BYTES or hi - lo < 2:
        return [(lo, hi)]
    step = max((hi - lo) // (8 * -(-int(total) // CHUNK_BYTES)), 1)
    sizes = own.groupBy(F.floor((F.col("place") - lo) / F.lit(step)).cast("long").alias("k")).agg(F.sum("size").alias("s")).collect()
    out: list[tuple[int, int]] = []
    held = 0
    for r in sorted(sizes, key=lambda r: r["k"]):
        a, z = lo + r["k"] * step, min(lo + (r["k"] + 1) * step, hi)
        if r["s"] > CHUNK_BYTES:
            out += _ranges(texts, a, z)
            held = CHUNK_BYTES
        elif out and held + r["s"] <= CHUNK_BYTES:
            out[-1], held = (out[-1][0], z), held + r["s"]
        else:
            out.append((a, z))
            held = r["s"]
    return out


def _texts(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts with the ids of their items, a place by hash and a size."""
    own = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                           F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return cut_lineage(own.groupBy("text").agg(F.sort_array(F.collect_set("item")).alias("items")).select(
        "items", "text", F.shiftrightunsigned(F.xxhash64("text"), 16).alias("place"),
        (F.octet_length("text") + F.octet_length(F.array_join("items", ""))).cast("long").alias("size")))


def _chunk(texts: DataFrame, lo: int, hi: int) -> list[tuple[list[str], str]]:
    return [(r.items, r.text) for r in texts.where(F.col("place").between(lo, hi - 1)).select("items", "text").collect()]


def _passes(docs: DataFrame, text_at: int, benchmark: DataFrame, item_col: str, item_text: str, window: int,
            finish, schema, with_matches: bool = False) -> DataFrame:
    spark, n_cols = docs.sparkSession, len(docs.columns)
    texts = _texts(benchmark, item_col, item_text)
    state, chunks = docs, _ranges(texts, 0, 1 << 48) or [(0, 0)]
    carried = ", ".join([f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields)])
    for k, (lo, hi) in enumerate(chunks):
        shared = spark.sparkContext.broadcast(TestSet(_chunk(texts, lo, hi), window))
        last = k == len(chunks) - 1
        step = _examine(shared, text_at, None if k == 0 else n_cols, last, finish, with_matches)
        if last:
            return state.mapInArrow(step, schema)
        plain = state.toDF(*[f"c{i}" for i in range(n_cols)]) if k == 0 else state
        state = cut_lineage(plain.mapInArrow(step, carried + ", hits binary, items array<string>" + (
            f", matches {MATCHES}" if with_matches else "")))
    raise AssertionError


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  with_matches: bool = True) -> DataFrame:
    """One row for each document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated and,
    with ``with_matches``, the longest verbatim matches with the items of the benchmark."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    if with_matches:
        schema += f", matches {MATCHES}"
    return _passes(own, 1, benchmark, item_col, item_text, window, _report(with_matches), schema, with_matches)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    text_at = docs.columns.index(text_col)

    def finish(rows: pa.RecordBatch, results) -> pa.RecordBatch:
        kept = _keep(rows, results)
        return pa.RecordBatch.from_arrays(kept.columns[: len(names)], names=names)

    names = list(docs.columns)
    return _passes(docs, text_at, benchmark, item_col, item_text, window, finish, docs.schema)

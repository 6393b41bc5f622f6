"""Operator 2: best-two-fit packing of documents into token sequences.

A bin is filled greedily, always with the longest piece that still fits.  Then its
smallest piece gives way to two unpacked pieces that together fit the widened gap more
tightly, as long as that fills the bin better.

Pieces of one length are alike, so bins are planned on the count of each length, of
which there are at most ``capacity`` at any size of input: a bin's pattern is used as
often as the counts allow, which uses up one of its lengths.  The plan goes to all
tasks (it has a few thousand rows, bounded by the capacity), and each piece finds its
place by its rank among the pieces of its length.  A rank is the pieces of that length
in earlier partitions plus those before it in its own, so a common length is no hot key.

Null and empty texts are documents of one id, the end mark.  Repeated rows are packed
separately; null ids are kept as they are.  Longer documents are cut into pieces of
``capacity`` ids, of which the first may be shorter.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateweave.llm import tokens as T
from rateweave.session import cut_lineage

CAPACITY = 2048
END_ID = 0

PIECE_SCHEMA = "doc_id long, piece int, start long, length int, ids_crc32 long"


def _pieces(path: str, capacity: int, with_ids: bool):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([END_ID], np.uint32).tobytes()
        enc = T.encoder(path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, z in T.groups(texts.to_pylist()):
                rows: list[tuple] = []
                for doc, raw in zip(ids[a:z].to_pylist(), enc.encode([t or "" for t in texts[a:z].to_pylist()])):
                    raw += end
                    n = len(raw) // 4
                    at, size = 0, n % capacity or capacity
                    if n <= capacity:
                        size = n
                    k = 0
                    while at < n:
                        part = raw[4 * at: 4 * (at + size)]
                        rows.append((doc, k, at, size, zlib.crc32(part), part if with_ids else None))
                        at, size, k = at + size, capacity, k + 1
                cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
                    (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([r[5] for r in rows], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return fn


def _best_pair(free: np.ndarray, room: int) -> tuple[int, int] | None:
    """Two available lengths with the largest sum up to ``room``; of equal sums the longest piece.
    free[x]: unpacked pieces of length x."""
    lengths = np.flatnonzero(free[:room])
    if not len(lengths):
        return None
    at = np.searchsorted(lengths, np.minimum(lengths, room - lengths), side="right") - 1
    at -= (at >= 0) & (lengths[at] == lengths) & (free[lengths] < 2)      # one piece can't be taken twice
    a, b = lengths[at >= 0], lengths[at[at >= 0]]
    if not len(a):
        return None
    best = np.lexsort((a, a + b))[-1]
    return int(a[best]), int(b[best])


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns (lengths in a bin) and how many bins follow each, for pieces counted by length.

    Where lengths are few, exchanging can use up the short pieces too early; the plan without
    exchanges is made as well, and is taken if it has fewer bins."""
    plans = [_plan(counts, capacity, exchange) for exchange in (True, False)]
    return min(plans, key=lambda p: sum(times for _, times in p))


def _plan(counts: dict[int, int], capacity: int, exchange: bool) -> list[tuple[list[int], int]]:
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[list[int], int]] = []
    while True:
        lengths = np.flatnonzero(left)
        if not len(lengths):
            return out
        need, free = Counter({int(lengths[-1]): 1}), left.copy()
        free[lengths[-1]] -= 1
        gap = capacity - int(lengths[-1])
        while len(fits := np.flatnonzero(free[: gap + 1])):
            need[int(fits[-1])] += 1
            free[fits[-1]] -= 1
            gap -= int(fits[-1])
        while gap and exchange:
            small = min(need)
            pair = _best_pair(free, gap + small)
            if pair is None or sum(pair) <= small:
                break
            need[small] -= 1
            free[small] += 1
            need += Counter()
            for x in pair:
                need[x] += 1
                free[x] -= 1
            gap += small - sum(pair)
        times = min(int(left[x]) // n for x, n in need.items())
        for x, n in need.items():
            left[x] -= times * n
        out.append((sorted(need.elements(), reverse=True), times))


def _places(patterns: list[tuple[list[int], int]], capacity: int):
    """Arrays that give a (length, rank) its sequence and offset."""
    by_length: dict[int, list[tuple]] = {}
    used = Counter()
    sequence = 0
    for lengths, times in patterns:
        offset, offsets = 0, {}
        for x in lengths:
            offsets.setdefault(x, []).append(offset)
            offset += x
        for x, own in offsets.items():
            by_length.setdefault(x, []).append((used[x], sequence, own))
            used[x] += times * len(own)
        sequence += times
    base = np.zeros(capacity + 2, np.int64)
    for x in range(1, capacity + 1):
        base[x + 1] = base[x] + used[x]
    rows = [(base[x] + a, first, own) for x in sorted(by_length) for a, first, own in by_length[x]]
    many = np.array([len(r[2]) for r in rows], np.int64)
    return (base, np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), many,
            np.concatenate([[0], np.cumsum(many)])[:-1].astype(np.int64),
            np.array([o for r in rows for o in r[2]], np.int64))


def _place(shared):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, begin, first, many, offset_at, offsets = shared.value
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            at = base[length] + rank
            row = np.searchsorted(begin, at, side="right") - 1
            own = at - begin[row]
            kept = [i for i, name in enumerate(batch.schema.names) if name != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in kept]
                + [pa.array(first[row] + own // many[row]), pa.array(offsets[offset_at[row] + own % many[row]])],
                names=[batch.schema.names[i] for i in kept] + ["sequence_id", "offset"])
    return fn


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset
    and, with ``with_ids``, the ids as little-endian unsigned 32-bit integers."""
    schema = PIECE_SCHEMA + (", ids binary" if with_ids else "")
    pieces = cut_lineage(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .mapInArrow(_pieces(tokenizer, capacity, with_ids), schema)
        .withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()))
    counts = cut_lineage(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = counts.select("part", "length", (F.sum("n").over(
        Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = pieces.withColumn("own", F.row_number().over(Window.partitionBy("part", "length").orderBy("row")) - 1) \
        .join(before, ["part", "length"]) \
        .select(*[c for c in pieces.columns if c not in ("part", "row")],
                (F.col("before") + F.col("own")).alias("rank"))
    shared = docs.sparkSession.sparkContext.broadcast(_places(plan_bins(total, capacity), capacity))
    return ranked.mapInArrow(_place(shared), schema + ", sequence_id long, offset long") \
        .withColumn("length", F.col("length").cast("long"))

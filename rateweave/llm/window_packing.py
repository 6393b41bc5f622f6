"""Operator 11: token windows by Karmarkar-Karp multiway differencing.

A partition's documents are taken in groups of about ``GROUP_WINDOWS`` windows.  A group is
divided by differencing: each document begins as a partial partition of its own, and the two
partial partitions with the largest imbalance are merged until one is left, the heavier
windows of one with the lighter windows of the other.  That gives near-equal windows.  Whenever
one of them exceeds the capacity, the window count rises and the group is divided anew.

The room that near-equal windows leave is filled to the last id: the group's last documents
(first those that were longer than a window and are cut anyway) are held back and cut to
measure.  What is then left of them goes to the next group, so only documents that are held
back or longer than a window are cut.  A partition leaves less than one window behind; these
rests of all partitions meet in groups of 512 partitions and are divided in the same way.  So
padding is at most one window for every 512 partitions.

Null and empty texts are documents of one id, the end mark.  A document longer than a window
gives whole windows first.  Repeated rows are packed separately; null ids are kept as they
are.  A very long text is one document in one task.  An empty table gives no rows.  Only the
id and text columns are read, so other columns can't clash.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.llm import tokens as T
from rateweave.llm import word_tokens as W
from rateweave.session import cut_lineage

CAPACITY = 4096
END_ID = 2
GROUP_WINDOWS = 256
#: Partitions whose rests meet in one group; a rest is less than one window.
REST_PARTITIONS = 512

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "cut boolean, part int, ids binary")
ARROW_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                          ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                          ("cut", pa.bool_()), ("part", pa.int32()), ("ids", pa.binary())])


def difference(lengths: Sequence[int], windows: int) -> list[list[int]]:
    """The numbers 0 to n - 1 dealt to ``windows`` lists with near-equal sums of lengths (lists
    that would be empty are left out).  A partial partition holds its non-empty windows, heaviest
    first: the sums less the lightest, the first and the last piece of each."""
    n = len(lengths)
    following = np.full(n, -1, np.int64)
    partial = {i: (np.array([x], np.int64), np.array([i]), np.array([i])) for i, x in enumerate(lengths)}
    heap = [(-int(x) if windows > 1 else 0, i) for i, x in enumerate(lengths)]
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        sums, first, last = partial.pop(heapq.heappop(heap)[1])
        sums2, first2, last2 = partial.pop(heapq.heappop(heap)[1])
        a, b = len(sums), len(sums2)
        shared = max(a + b - windows, 0)
        light, light2 = slice(a - shared, a), slice(b - shared, b)
        following[last[light]] = first2[light2][::-1]
        sums = np.concatenate([sums[: a - shared], sums[light] + sums2[light2][::-1], sums2[: b - shared]])
        first = np.concatenate([first, first2[: b - shared]])
        last = np.concatenate([last[: a - shared], last2[light2][::-1], last2[: b - shared]])
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        if len(sums) == windows:
            sums = sums - sums[-1]
        partial[made] = sums, first[order], last[order]
        heapq.heappush(heap, (-int(sums[0] - (sums[-1] if len(sums) == windows else 0)), made))
        made += 1
    out = []
    for i in (int(i) for _, first, _ in partial.values() for i in first):
        own = []
        while i >= 0:
            own.append(i)
            i = int(following[i])
        out.append(own)
    return out


def fill_windows(lengths: np.ndarray, cut_first: np.ndarray, capacity: int
                 ) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Full windows of parts (piece, begin, end), and the parts of less than one window that are
    left.  Pieces are cut only if held back: from the end, those of ``cut_first`` before others."""
    order = np.argsort(cut_first, kind="stable")
    ends = np.cumsum(lengths[order])
    count = int(ends[-1]) // capacity if len(ends) else 0
    windows: list[list[tuple[int, int, int]]] = []
    held = max(count * capacity // 64, 1)
    body = 0
    while count:
        body = int(np.searchsorted(ends, count * capacity - held, side="right"))
        whole = order[:body]
        n = max(-(-int(ends[body - 1]) // capacity), 1) if body else count
        dealt: list[list[int]] = []
        while body and n <= count:
            dealt = difference(lengths[whole], n)
            if max(int(lengths[whole[w]].sum()) for w in dealt) <= capacity:
                break
            n += 1                                       # capacity is exceeded: one window more
        if n <= count:
            windows = [[(int(whole[i]), 0, int(lengths[whole[i]])) for i in w] for w in dealt]
            windows += [[] for _ in range(count - len(windows))]
            break
        held *= 2
    rest = [(int(i), 0, int(lengths[i])) for i in order[body:]][::-1]
    for w in windows:
        room = capacity - sum(z - a for _, a, z in w)
        while room:
            i, a, z = rest.pop()
            if z - a > room:
                rest.append((i, a + room, z))
                z = a + room
            w.append((i, a, z))
            room -= z - a
    return windows, rest[::-1]


class _Pieces:
    """Pieces in hand: (doc, start, tokens of the document, ids, cut)."""

    def __init__(self, capacity: int, most_windows: int):
        self.capacity, self.most = capacity, most_windows
        self.pieces: list[tuple] = []
        self.total = 0

    def add(self, doc, start: int, doc_tokens: int, raw: bytes, cut: bool) -> None:
        self.pieces.append((doc, start, doc_tokens, raw, cut))
        self.total += len(raw) // 4

    def full(self) -> bool:
        return self.total >= self.most * self.capacity or len(self.pieces) >= 4 * self.capacity

    def windows(self) -> list[list[tuple]]:
        """Full windows of all pieces; the rest stays in hand."""
        own = self.pieces
        dealt, rest = fill_windows(np.array([len(p[3]) // 4 for p in own], np.int64), np.array([p[4] for p in own], bool),
                                   self.capacity)
        out = [[_part(own[i], a, z) for i, a, z in w] for w in dealt]
        self.pieces = [_part(own[i], a, z) for i, a, z in rest]
        self.total = sum(len(p[3]) for p in self.pieces) // 4
        return out


def _part(piece: tuple, a: int, z: int) -> tuple:
    doc, start, doc_tokens, raw, cut = piece
    return doc, start + a, doc_tokens, raw[4 * a: 4 * z], cut or 4 * (z - a) < len(raw)


def _rows(windows: list[list[tuple]], first: int, step: int, part: int, with_ids: bool) -> pa.RecordBatch:
    """Rows of whole windows, numbered first, first + step, ..."""
    out = []
    for k, w in enumerate(windows):
        offset = 0
        for doc, start, doc_tokens, raw, cut in w:
            out.append((doc, start, len(raw) // 4, zlib.crc32(raw), doc_tokens, first + k * step, offset, cut, part,
                        raw if with_ids else None))
            offset += len(raw) // 4
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), ARROW_SCHEMA)], schema=ARROW_SCHEMA)


def _rest_rows(pieces: list[tuple], part: int) -> pa.RecordBatch:
    out = [(doc, start, len(raw) // 4, None, doc_tokens, None, None, cut, part, raw)
           for doc, start, doc_tokens, raw, cut in pieces]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), ARROW_SCHEMA)], schema=ARROW_SCHEMA)


def _partition(path: str, capacity: int, group_windows: int, with_ids: bool):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        end = np.array([END_ID], "<u4").tobytes()
        enc = W.encoder(path)
        hand, number = _Pieces(capacity, group_windows), part << 32
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, z in T.groups(texts.to_pylist()):
                done: list[list[tuple]] = []
                for doc, raw in zip(ids[a:z].to_pylist(), enc.encode([t or "" for t in texts[a:z].to_pylist()])):
                    raw += end
                    n = len(raw) // 4
                    at = 0
                    while n - at >= capacity:
                        done.append([(doc, at, n, raw[4 * at: 4 * (at + capacity)], n > capacity)])
                        at += capacity
                    if at < n:
                        hand.add(doc, at, n, raw[4 * at:], at > 0)
                        if hand.full():
                            done += hand.windows()
                if done:
                    yield _rows(done, number, 1, part, with_ids)
                    number += len(done)
        done = hand.windows()
        if done:
            yield _rows(done, number, 1, part, with_ids)
        if hand.pieces:
            yield _rest_rows(hand.pieces, part)
    return fn


def _rests(capacity: int, with_ids: bool):
    """Rests of some partitions in windows of their own, numbered below zero."""
    def fn(key: tuple, table: pa.Table) -> pa.Table:
        number = -1 - (key[0].as_py() << 32)
        rows = table.sort_by([("part", "ascending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids", "ascending")])
        hand = _Pieces(capacity, 0)
        for r in rows.to_pylist():
            hand.add(r["doc_id"], r["start"], r["doc_tokens"], r["ids"], r["cut"])
        done = hand.windows()
        if hand.pieces:
            done.append(hand.pieces)
        return pa.Table.from_batches([_rows(done, number, -1, -1, with_ids)])
    return fn


def pack_windows(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, group_windows: int = GROUP_WINDOWS, with_ids: bool = True) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, with
    ``with_ids``, the ids as little-endian unsigned 32-bit integers."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    dealt = cut_lineage(own.mapInArrow(_partition(tokenizer, capacity, group_windows, with_ids), SCHEMA))
    rests = dealt.where("sequence_id is null").groupBy(F.floor(F.col("part") / REST_PARTITIONS).alias("group")) \
        .applyInArrow(_rests(capacity, with_ids), SCHEMA)
    columns = [c for c in dealt.columns if c not in ("cut", "part") and (with_ids or c != "ids")]
    return dealt.where("sequence_id is not null").unionByName(rests).select(*columns)

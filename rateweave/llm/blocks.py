"""Documents packed into blocks, and exchanges of packed keys between blocks.

A block is one row that holds some MB of neighbouring documents: their ids, their
lengths and their bytes, compressed.  Operators that need numpy over many documents
at once work on blocks, and a written table of blocks gives every document a stable
place (block, index) that does not depend on unique or non-null ids.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.session import cut_lineage

BLOCK_BYTES = 2 << 20
#: Documents in a block fit 16 bits, so that (block << 16) + index is a document's place.
BLOCK_DOCS = 1 << 16
NULL_ID = np.int64(np.iinfo(np.int64).max)

BLOCK_SCHEMA = "n_docs int, n_bytes long, ids binary, no_id binary, lengths binary, data binary"
OPEN_COLUMNS = ["block", "ids", "no_id", "lengths", "data"]


def make_room() -> None:
    """Drop the table of pieces that a tokenizing stage may have left in this Python worker."""
    tokens = sys.modules.get("rateweave.llm.tokens")
    if tokens is not None:
        tokens.forget()


def string_parts(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return flat[offsets[0]: offsets[-1]], offsets - offsets[0]


def cuts(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes and BLOCK_DOCS rows each; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), i + BLOCK_DOCS, n)
        yield i, j
        i = j


def _packer(block_bytes: int, rest: list[str] | None):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        for batch in batches:
            ids_col = batch.column(0)
            no_id = np.asarray(ids_col.is_null().to_numpy(zero_copy_only=False), dtype=bool)
            ids = ids_col.fill_null(int(NULL_ID)).to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(ids, kind="stable")
            flat, offsets = string_parts(batch.column(1).take(pa.array(order)))
            ids, no_id = ids[order], no_id[order]
            rows = []
            if rest is not None:
                other = pa.Table.from_batches([batch]).select(rest).append_column(
                    "no text", batch.column(1).is_null()).take(pa.array(order))
            for i, j in cuts(offsets, block_bytes):
                lengths = np.diff(offsets[i: j + 1]).astype(np.int32)
                data = flat[offsets[i]: offsets[j]].tobytes()
                rows.append((j - i, len(data), ids[i:j].tobytes(), no_id[i:j].tobytes(), lengths.tobytes(),
                             squeeze(data), _written(other.slice(i, j - i)) if rest is not None else None))
            if rows:
                n = 6 if rest is None else 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64())]
                    + [pa.array([r[k] for r in rows], pa.binary()) for k in range(2, n)],
                    names=["n_docs", "n_bytes", "ids", "no_id", "lengths", "data", "rest"][:n])
    return pack


def _written(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def write_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES, whole_rows: bool = False) -> DataFrame:
    """A written table of blocks (BLOCK_SCHEMA and a unique ``block``).  Within a block
    documents stand by id, null ids last.  Null texts count as empty.  With ``whole_rows``
    the other columns go along, for ``Block.rows``."""
    other = [c for c in docs.columns if c != text_col] if whole_rows else []
    names = [f"r{k}" for k in range(len(other))]
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                      *[F.col(c).alias(n) for c, n in zip(other, names)])
    packed = own.mapInArrow(_packer(block_bytes, names if whole_rows else None),
                            BLOCK_SCHEMA + (", rest binary" if whole_rows else ""))
    made = F.monotonically_increasing_id()               # partition << 33 + row of the partition
    return cut_lineage(packed.withColumn("block", F.shiftleft(F.shiftright(made, 33), 24) + made.bitwiseAND((1 << 33) - 1)))


def squeeze(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def expand(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw) if raw else b""


class Block:
    """One block opened in a task."""

    def __init__(self, ids: bytes, no_id: bytes, lengths: bytes, data: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.no_id = np.frombuffer(no_id, bool)
        self.lengths = np.frombuffer(lengths, np.int32).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.data = np.frombuffer(expand(data), np.uint8)

    @classmethod
    def of(cls, table: pa.Table, row: int = 0) -> Block:
        return cls(*(table.column(c)[row].as_py() for c in ("ids", "no_id", "lengths", "data")))

    def rows(self, rest: bytes, index: np.ndarray, columns: list[str], text_col: str) -> pa.Table:
        """Whole rows of the documents as they came, with their columns in the given order."""
        other = pa.ipc.open_stream(rest).read_all()
        offsets = pa.py_buffer(self.starts.astype(np.int64).tobytes())
        text = pa.LargeStringArray.from_buffers(len(self.ids), offsets, pa.py_buffer(self.data.tobytes()))
        text = pa.compute.if_else(other.column("no text").combine_chunks(), None, text).cast(pa.string())
        parts = iter(other.columns[:-1])
        return pa.table([text if c == text_col else next(parts) for c in columns], names=columns).take(pa.array(index))

    def id_array(self, rows: np.ndarray | None = None) -> pa.Array:
        ids, mask = (self.ids, self.no_id) if rows is None else (self.ids[rows], self.no_id[rows])
        return pa.array(ids, pa.int64(), mask=np.array(mask))


def each_block(fn, with_id: bool = True):
    """mapInArrow function from ``fn(block id, Block) -> RecordBatch | None``, one block at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for i in range(batch.num_rows):
                out = fn(table.column("block")[i].as_py() if with_id else None, Block.of(table, i))
                if out is not None and out.num_rows:
                    yield out
    return run


def n_shares(blocks: DataFrame, share_bytes: int, least: int = 64) -> int:
    """Shares that an exchange is dealt into: in proportion to the bytes of all blocks."""
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(least, -(-int(total) // share_bytes))


def share_bounds(n: int) -> np.ndarray:
    """Lower bounds of the hash ranges of n shares (the first is 0)."""
    return np.array([(k << 64) // n for k in range(n)], dtype=np.uint64)


def split_points(sorted_hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where each share begins in a sorted array of hashes, and its end."""
    return np.append(np.searchsorted(sorted_hashes, bounds, side="left"), len(sorted_hashes))


def sorted_unique(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and how often each occurs."""
    s = np.sort(values)
    if not len(s):
        return s, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s[first], np.diff(np.append(first, len(s)))


_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * _C1
    h ^= h >> np.uint64(27)
    h *= _C2
    h ^= h >> np.uint64(31)
    return h


_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse, n of each."""
    have = _POWERS.get(0)
    if have is None or len(have[0]) < n:
        size = n + (1 << 16)
        def run(base: int) -> np.ndarray:
            a = np.full(size, base, np.uint64)
            a[0] = 1
            return np.multiply.accumulate(a)
        have = _POWERS[0] = run(_BASE), run(pow(_BASE, -1, 1 << 64))
    return have[0][:n], have[1][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Polynomial hash of every prefix of ``data`` (n + 1 values)."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each range [start, end) of what ``prefix`` was made from."""
    _, down = powers(len(prefix))
    h = (prefix[ends] - prefix[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * _C2)

"""Operator 10: token ids in files, coded with static range asymmetric numerals.

Documents are sorted by doc_id over range partitions.  A task cuts its documents into
segments of at most ``SEGMENT_IDS`` ids (a longer document stands alone); a segment is one
row of the file, in Parquet as the outer shell.  It holds a frequency table of all its
ids, shared by its blocks, and blocks of ``BLOCK_IDS`` ids, each coded by ``LANES``
interleaved states, so that a block can be decoded by itself.

    segment = header | documents | table | checkpoints | words
      header       ids, documents, blocks, bits of the table's sum, bytes of each part
      documents    doc_id, null mark and number of ids of each document
      table        symbols and their frequencies, which sum to 2**bits
      checkpoints  for each block its first word, the crc32 of its ids and the final states
      words        32-bit words of all blocks

Null and empty texts are documents of one id, the end mark.  Null ids stand first, rows
with one doc_id stand together and are separate documents.  An empty table gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rateweave.llm import tokens as T

SEGMENT_IDS = 1 << 21
BLOCK_IDS = 1 << 13
LANES = 32
END_ID = 0
_LOW = np.uint64(1 << 31)
_HEADER = struct.Struct("<8sQIIIIIII")
_MAGIC = b"RANSEG01"


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbols, their frequencies (all at least 1) and the bits of the frequencies' sum."""
    counts = np.bincount(ids) if len(ids) and int(ids.max()) < 1 << 22 else None
    if counts is None:
        symbols, counts = np.unique(ids, return_counts=True)
    else:
        symbols = np.flatnonzero(counts)
        counts = counts[symbols]
    bits = min(24, max(14, int(len(symbols)).bit_length() + 3))
    free = (1 << bits) - len(symbols)
    freq = (counts * (free / max(1, counts.sum()))).astype(np.int64) + 1
    freq[np.argmax(counts)] += (1 << bits) - freq.sum()
    return symbols.astype(np.uint32), freq.astype(np.uint64), bits


def _crcs(ids: np.ndarray, n_blocks: int) -> np.ndarray:
    raw = ids.astype("<u4").tobytes()
    return np.array([zlib.crc32(raw[4 * k * BLOCK_IDS: 4 * (k + 1) * BLOCK_IDS]) for k in range(n_blocks)], np.uint32)


def encode_segment(ids: np.ndarray, docs: np.ndarray, no_id: np.ndarray, sizes: np.ndarray) -> bytes:
    n, steps = len(ids), BLOCK_IDS // LANES
    blocks = -(-n // BLOCK_IDS)
    symbols, freq, bits = frequencies(ids)
    place = np.searchsorted(symbols, ids).astype(np.int32) if len(symbols) < 2 or symbols[-1] >= 1 << 22 else None
    if place is None:
        where = np.zeros(int(symbols[-1]) + 1, np.int32)
        where[symbols] = np.arange(len(symbols), dtype=np.int32)
        place = where[ids]
    start = (np.cumsum(freq) - freq).astype(np.uint64)
    grid = np.zeros(blocks * BLOCK_IDS, np.int32)
    grid[:n] = place
    grid = grid.reshape(blocks, steps, LANES)
    length = np.clip(n - np.arange(blocks) * BLOCK_IDS, 0, BLOCK_IDS)
    lane = np.arange(LANES)
    state = np.full((blocks, LANES), _LOW, np.uint64)
    words = np.zeros((blocks, steps, LANES), np.uint32)
    wrote = np.zeros((blocks, steps, LANES), bool)
    shift, mask = np.uint64(bits), np.uint64(0xFFFFFFFF)
    limit = freq << np.uint64(31 - bits + 32)
    for s in range(steps - 1, -1, -1):
        symbol = grid[:, s, :]
        f = freq[symbol]
        live = (s * LANES + lane)[None, :] < length[-1] if blocks == 1 else None
        over = state >= limit[symbol]
        if length[-1] < BLOCK_IDS:
            live = np.ones((blocks, LANES), bool)
            live[-1] = s * LANES + lane < length[-1]
            over &= live
        words[:, s, :] = (state & mask).astype(np.uint32)
        wrote[:, s, :] = over
        reduced = np.where(over, state >> np.uint64(32), state)
        q = reduced // f
        moved = (q << shift) + (reduced - q * f) + start[symbol]
        state = moved if length[-1] == BLOCK_IDS else np.where(live, moved, state)
    out_words = words[wrote]
    first = np.concatenate([[0], np.cumsum(wrote.reshape(blocks, -1).sum(axis=1))])[:-1].astype("<u8")
    own_docs = zlib.compress(docs.astype("<i8").tobytes() + np.packbits(no_id).tobytes() + sizes.astype("<u4").tobytes(), 3)
    gaps = np.diff(symbols.astype(np.int64), prepend=0).astype("<u4")
    table = zlib.compress(gaps.tobytes() + freq.astype("<u4").tobytes(), 6)
    checks = first.tobytes() + _crcs(ids, blocks).astype("<u4").tobytes() + state.astype("<u8").tobytes()
    header = _HEADER.pack(_MAGIC, n, len(docs), blocks, bits, len(symbols), len(own_docs), len(table), len(checks))
    return header + own_docs + table + checks + out_words.astype("<u4").tobytes()


class Segment:
    """A segment opened for reading; ``decode`` takes any range of its blocks."""

    def __init__(self, raw: bytes):
        (magic, self.n, n_docs, self.blocks, self.bits, n_symbols, a, b, c) = _HEADER.unpack_from(raw)
        if magic != _MAGIC:
            raise ValueError("not a token segment")
        at = _HEADER.size
        docs = zlib.decompress(raw[at: at + a])
        self.docs = np.frombuffer(docs, "<i8", n_docs)
        marks = -(-n_docs // 8)
        self.no_id = np.unpackbits(np.frombuffer(docs, np.uint8, marks, 8 * n_docs), count=n_docs).astype(bool)
        self.sizes = np.frombuffer(docs, "<u4", n_docs, 8 * n_docs + marks)
        table = zlib.decompress(raw[at + a: at + a + b])
        self.symbols = np.cumsum(np.frombuffer(table, "<u4", n_symbols).astype(np.int64)).astype(np.uint32)
        self.freq = np.frombuffer(table, "<u4", n_symbols, 4 * n_symbols).astype(np.uint64)
        at += a + b
        self.first = np.frombuffer(raw, "<u8", self.blocks, at).astype(np.int64)
        self.crcs = np.frombuffer(raw, "<u4", self.blocks, at + 8 * self.blocks)
        self.states = np.frombuffer(raw, "<u8", self.blocks * LANES, at + 12 * self.blocks).reshape(-1, LANES)
        at += c
        self.words = np.frombuffer(raw, "<u4", (len(raw) - at) // 4, at)

    def decode(self, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Ids of blocks begin to end; raises if a block's checksum differs."""
        end = self.blocks if end is None else end
        steps, blocks = BLOCK_IDS // LANES, end - begin
        if blocks <= 0:
            return np.zeros(0, np.uint32)
        slots = np.repeat(np.arange(len(self.freq), dtype=np.int32), self.freq.astype(np.int64))
        start = np.cumsum(self.freq) - self.freq
        state = self.states[begin:end].astype(np.uint64)
        at = self.first[begin:end].copy()
        words = np.append(self.words, np.uint32(0)).astype(np.uint64)
        length = np.clip(self.n - (begin + np.arange(blocks)) * BLOCK_IDS, 0, BLOCK_IDS)
        lane, mask, shift = np.arange(LANES), np.uint64((1 << self.bits) - 1), np.uint64(self.bits)
        grid = np.zeros((blocks, steps, LANES), np.int32)
        for s in range(steps):
            low = state & mask
            symbol = slots[low]
            moved = self.freq[symbol] * (state >> shift) + low - start[symbol]
            short = moved < _LOW
            if length[-1] < BLOCK_IDS:
                live = np.ones((blocks, LANES), bool)
                live[-1] = s * LANES + lane < length[-1]
                short &= live
                moved = np.where(live, moved, state)
            taken = np.cumsum(short, axis=1)
            word = words[np.minimum(at[:, None] + taken - 1, len(words) - 1)]
            state = np.where(short, (moved << np.uint64(32)) | word, moved)
            at += taken[:, -1]
            grid[:, s, :] = symbol
        ids = self.symbols[grid.reshape(-1)[: int(length.sum())]]
        if not np.array_equal(_crcs(ids, blocks), self.crcs[begin:end]):
            raise ValueError("a block's checksum differs")
        return ids


def _segments(path: str, segment_ids: int):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = T.encoder(path), np.array([END_ID], np.uint32).tobytes()
        docs: list[int] = []
        none: list[bool] = []
        raws: list[bytes] = []
        held = k = 0

        def close() -> pa.RecordBatch:
            nonlocal held, k
            ids = np.frombuffer(b"".join(raws), "<u4")
            sizes = np.array([len(r) // 4 for r in raws], np.uint32)
            blob = encode_segment(ids, np.array(docs, np.int64), np.array(none, bool), sizes)
            out = pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([len(docs)], pa.int64()),
                                              pa.array([len(ids)], pa.int64()), pa.array([blob], pa.binary())],
                                             names=["segment", "n_docs", "n_ids", "data"])
            docs.clear(), none.clear(), raws.clear()
            held, k = 0, k + 1
            return out

        for batch in batches:
            texts = batch.column(1).to_pylist()
            null = np.asarray(pc.is_null(batch.column(0)).to_numpy(zero_copy_only=False), bool)
            ids = batch.column(0).fill_null(0).to_pylist()
            for a, z in T.groups(texts):
                for i, raw in zip(range(a, z), enc.encode([t or "" for t in texts[a:z]])):
                    raw += end
                    if held and held + len(raw) // 4 > segment_ids:
                        yield close()
                    docs.append(ids[i]), none.append(bool(null[i])), raws.append(raw)
                    held += len(raw) // 4
        if docs:
            yield close()
    return fn


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of all documents, in ascending order of the id, to ``path``."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    own.repartitionByRange(*order).sortWithinPartitions(*order) \
        .mapInArrow(_segments(tokenizer, segment_ids), "segment int, n_docs long, n_ids long, data binary") \
        .withColumn("part", F.spark_partition_id()).write.mode("errorifexists").parquet(path)


def _read(with_ids: bool):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, segment, data = (batch.column(i)[row].as_py() for i in range(3))
                s = Segment(data)
                raw = s.decode().astype("<u4").tobytes()
                ends = np.cumsum(s.sizes.astype(np.int64))
                starts = ends - s.sizes
                own = [raw[4 * a: 4 * z] for a, z in zip(starts.tolist(), ends.tolist())]
                n = len(s.docs)
                cols = [pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, segment, np.int32)),
                        pa.array(s.docs.astype(np.int64), mask=s.no_id), pa.array(starts, pa.int64()),
                        pa.array(s.sizes.astype(np.int64)), pa.array([zlib.crc32(x) for x in own], pa.int64())]
                names = ["part", "segment", "doc_id", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(own, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return fn


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row for each document of the files: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 and, with ``with_ids``, the ids as little-endian unsigned 32-bit integers."""
    files = spark.read.parquet(path)
    # Where partitions start (one row for each partition), then where the segments in them do.
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    own = Window.partitionBy("part").orderBy("segment")
    starts = files.select("part", "segment", (F.sum("n_ids").over(own) - F.col("n_ids")).alias("before")) \
        .join(parts, "part").select("part", "segment", (F.col("base") + F.col("before")).alias("base"))
    rows = files.select("part", "segment", "data").mapInArrow(
        _read(with_ids), "part int, segment int, doc_id long, at long, n_tokens long, ids_crc32 long"
        + (", ids binary" if with_ids else ""))
    return rows.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
        *(["ids"] if with_ids else []))

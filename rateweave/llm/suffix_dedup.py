"""Operator 1: remove repeated 100-byte passages with suffix arrays (two-stage sorting).

Every byte that a 100-byte string covers goes if that string also starts earlier
(smaller doc_id, or the same document and an earlier start).

1. Candidates, without loss.  Each 100-byte window is known by the smallest hash of
   the 32-byte strings in it.  Equal windows have equal smallest hashes at two places,
   so runs of windows whose hash is smallest at one place only hold no repeat.  Blocks send sorted distinct
   hashes to hash ranges and get back one bit for each.
2. Runs left over go, as text, to the share of their hash.  Equal texts meet first in
   their block and then in the share, where only the earliest stays; of the others all
   windows are repeats.  A string that very many different texts surround is ranked
   last as a window's smallest hash, so its runs spread over the hashes around it.
3. A share builds the suffix array of its distinct texts, piece by piece, in two stages:
   suffixes smaller than their successors are sorted directly, the rest are induced by
   scans over the buckets of first bytes.  Adjacent common prefixes of 100 bytes or more
   join windows into classes, and all but the earliest window of a class are repeats.
4. The repeated ranges return to their blocks, where the documents are put together.

Null texts count as empty; rows with the same doc_id are separate documents, in the
order of their blocks; null ids stand after all others.  A document stays in one task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.llm import blocks as B
from rateweave.session import cut_lineage

LENGTH = 100
GRAM = 32
#: A suffix array is built for the runs of about so many bytes of all texts, by hash.
PIECE_BYTES = 1 << 19
#: So many such pieces stand in a share at most, so that a block's row for a share holds many runs.
PIECES = 32
LEAST_SHARES = 64
#: At most so many hashes are ranked last: those with over 1/HOT_MOST of all windows' hashes.
HOT_MOST = 50_000
HOT_LEAST = 256


def _least_of(h: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """Smallest of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        h = pick(h[:-size], h[size:])
        size *= 2
    return pick(h[: len(h) - (width - size)], h[width - size:]) if size < width else h


def _largest_of(h: np.ndarray, width: int) -> np.ndarray:
    """Largest of every ``width`` neighbours."""
    return _least_of(h, width, np.maximum)


def window_runs(block: B.Block, length: int, gram: int, hot: np.ndarray | None = None):
    """Runs of neighbouring windows with one smallest hash: first starts, last starts, hashes,
    and whether a window of the run had a hot smallest hash before those were ranked last.
    Also the hashes of all places that are smallest in a window: one that stands at two places
    can belong to equal windows, be they of one run."""
    data, n = block.data, len(block.data)
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, np.uint64)
    prefix = B.prefix_hash(data)
    _, down = B.powers(n + 1)
    h = np.maximum(B.mix((prefix[gram:] - prefix[:-gram]) * down[: n - gram + 1]), np.uint64(1))
    del prefix
    m, was_hot = _least_of(h, length - gram + 1), None
    if hot is not None and len(hot):
        was_hot = hot[np.minimum(np.searchsorted(hot, m), len(hot) - 1)] == m
        rank_last = hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h
        h = np.maximum(h >> np.uint64(1), np.uint64(1)) | (rank_last.astype(np.uint64) << np.uint64(63))
        m = _least_of(h, length - gram + 1)
    left = np.repeat(block.starts[1:].astype(np.int32), block.lengths)[: len(m)]
    left -= np.arange(len(m), dtype=np.int32)
    ok = left >= length
    del left
    # A place is smallest in some window if the largest of its windows' smallest hashes is its own.
    width = length - gram + 1
    least = np.zeros(len(m) + 2 * (width - 1), np.uint64)
    np.copyto(least[width - 1: width - 1 + len(m)], m, where=ok)
    places = h[_largest_of(least, width) == h]
    del least, h
    new = np.ones(len(m), bool)
    new[1:] = (m[1:] != m[:-1]) | ~ok[:-1]
    inner = block.starts[:-1]
    new[inner[inner < len(m)]] = True
    first = np.flatnonzero(new & ok)
    stop = np.flatnonzero(ok & np.append(new[1:] | ~ok[1:], True))
    flags = np.zeros(len(first), bool)
    if was_hot is not None and len(first):
        seen = np.concatenate([[0], np.cumsum(was_hot)])
        flags = seen[stop + 1] > seen[first]
    return first, stop, m[first], flags, places


def key_bounds(n: int, width: int) -> np.ndarray:
    """Lower bounds of n ranges that hold about as many keys each.  A hash u (of 0 to 1) is smallest of
    some ``width`` neighbours with probability (1 - u)^k (1 + k u), k = width - 1: keys are small."""
    k = width - 1
    s = np.linspace(1, 0, 1 << 16) ** (1 / (k + 1))
    below = (1 - s ** (k + 1)) - k / (k + 2) * (1 - s ** (k + 2))
    at = np.interp(np.arange(n) / n, below / below[-1], 1 - s)
    return np.array([int(x * 2.0 ** 64) for x in at], np.uint64)


def _ask(length: int, gram: int, n: int):
    bounds = key_bounds(n, length - gram + 1)

    def fn(block_id: int, block: B.Block):
        keys, counts = B.sorted_unique(window_runs(block, length, gram)[4])
        at = B.split_points(keys, bounds)
        shares = np.flatnonzero(np.diff(at))
        counts = np.minimum(counts, 65535).astype(np.uint16)
        return pa.RecordBatch.from_arrays(
            [pa.array(shares, pa.int32()), pa.array(np.full(len(shares), block_id), pa.int64()),
             pa.array([keys[at[s]: at[s + 1]].tobytes() for s in shares], pa.binary()),
             pa.array([counts[at[s]: at[s + 1]].tobytes() for s in shares], pa.binary())],
            names=["share", "block", "keys", "counts"])
    return B.each_block(fn)


def _answer(table: pa.Table) -> pa.Table:
    """For each block of a share: a bit for each of its keys, and the keys with their sums where large."""
    sent = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("keys")]
    counts = np.concatenate([np.frombuffer(x.as_py(), np.uint16) for x in table.column("counts")]).astype(np.int64)
    keys = np.concatenate(sent)
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    totals = np.add.reduceat(counts[order], first)
    bits = np.zeros(len(keys), bool)
    bits[order] = np.repeat(totals > 1, np.diff(np.append(first, len(s))))
    ends = np.cumsum([len(x) for x in sent])
    packed = [np.packbits(bits[e - len(x): e]).tobytes() for e, x in zip(ends, sent)]
    often = totals >= HOT_LEAST
    k = len(sent) - 1
    return pa.table({
        "share": table.column("share"), "block": table.column("block"), "bits": pa.array(packed, pa.binary()),
        "total": pa.array([0] * k + [int(totals.sum())], pa.int64()),
        "often": pa.array([b""] * k + [s[first][often].tobytes()], pa.binary()),
        "sums": pa.array([b""] * k + [totals[often].tobytes()], pa.binary())})


ANSWER = "share int, block long, bits binary, total long, often binary, sums binary"


def _often(answers: DataFrame) -> np.ndarray:
    """Hashes of more than 1/HOT_MOST of all, sorted: at most HOT_MOST by that rule."""
    total = answers.agg(F.sum("total")).first()[0] or 0
    limit = max(HOT_LEAST, total // HOT_MOST + 1)

    def pick(batches):
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                keys = np.frombuffer(k, np.uint64)[np.frombuffer(c, np.int64) >= limit]
                if len(keys):
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])
    rows = answers.where(F.length("often") > 0).select("often", "sums").mapInArrow(pick, "key long").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


def _send(length: int, gram: int, n: int, pieces: int, hot: np.ndarray):
    """Texts of candidate runs by share, and the ranges that repeat within the block itself:
    those have null ids and go along to any share, which hands them on."""
    bounds, piece_bounds = key_bounds(n, length - gram + 1), B.share_bounds(n * pieces)

    def fn(key, left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        for r in range(left.num_rows):
            block, block_id = B.Block.of(left, r), key[0].as_py()
            keys, _ = B.sorted_unique(window_runs(block, length, gram)[4])
            at = B.split_points(keys, bounds)
            known = np.zeros(len(keys), bool)
            for i in range(right.num_rows):
                s = right.column("share")[i].as_py()
                m = at[s + 1] - at[s]
                known[at[s]: at[s + 1]] = np.unpackbits(np.frombuffer(right.column("bits")[i].as_py(), np.uint8), count=m)
            first, last, hashes, was_hot, _ = window_runs(block, length, gram, hot)
            if len(hot):
                # A run that left a hot hash was not asked for by its new one: it stays a candidate.
                once = np.maximum(keys[~known] >> np.uint64(1), np.uint64(1))
                place = np.minimum(np.searchsorted(once, hashes), max(len(once) - 1, 0))
                repeated = was_hot | (once[place] != hashes) if len(once) else np.ones(len(hashes), bool)
            else:
                repeated = known[np.searchsorted(keys, hashes)] if len(keys) else np.zeros(0, bool)
            take = np.flatnonzero(repeated)
            docs = np.searchsorted(block.starts, first[take], side="right") - 1
            raw, seen, kept, spans = block.data.tobytes(), {}, [], []
            for k, (a, z) in enumerate(zip(first[take].tolist(), last[take].tolist())):
                text = raw[a: z + length]
                if text in seen:
                    spans.append((a, z + length))
                else:
                    seen[text] = k
                    kept.append(k)
            texts = list(seen)
            piece = np.searchsorted(piece_bounds, B.mix(hashes[take][kept]), side="right") - 1
            order, shares = np.argsort(piece, kind="stable"), piece // pieces
            points = np.flatnonzero(np.concatenate([[True], np.diff(shares[order]) != 0])) if len(order) else []
            kept = np.array(kept, np.int64)
            for a, z in zip(points, np.append(points[1:], len(order)) if len(order) else []):
                own = order[a:z]
                mine = kept[own]
                rows.append((int(shares[own[0]]), block_id, block.ids[docs[mine]].tobytes(),
                             first[take][mine].astype(np.int64).tobytes(),
                             np.array([len(texts[i]) for i in own], np.int32).tobytes(),
                             (piece[own] % pieces).astype(np.uint8).tobytes(),
                             B.squeeze(b"".join(texts[i] for i in own))))
            if spans:
                share = int(B.mix(np.array([block_id], np.int64).view(np.uint64))[0]) % n
                rows.append((share, block_id, None, None, None, None, B.squeeze(np.array(spans, np.int64).tobytes())))
        return pa.table([pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.int64())]
                        + [pa.array([x[k] for x in rows], pa.binary()) for k in range(2, 7)],
                        names=["share", "block", "ids", "starts", "lengths", "pieces", "data"])
    return fn


SENT = "share int, block long, ids binary, starts binary, lengths binary, pieces binary, data binary"


def two_stage_suffix_array(flat: np.ndarray, bounds: np.ndarray, need: np.ndarray, depth: int) -> np.ndarray:
    """Positions of the first ``need[t]`` suffixes of every text t (text t is
    flat[bounds[t]:bounds[t + 1]]) in the order of their first ``depth`` bytes."""
    n, lengths = len(flat), np.diff(bounds)
    if not n:
        return np.zeros(0, np.int64)
    own_end = np.repeat(bounds[1:], lengths)
    code = np.append(flat.astype(np.int16) + 1, 0)
    nxt = np.where(np.arange(n) + 1 < own_end, code[1:], 0)
    step = np.sign(nxt - code[:n]).astype(np.int8)        # > 0: smaller than its successor at once
    where = np.where(step != 0, np.arange(n), n)
    where = np.minimum.accumulate(where[::-1])[::-1]      # the last byte of a text always differs from its end
    direct = step[where] > 0
    # From the last suffix wanted on to the next direct one (or the text's end), all are induced from it.
    seed = np.where(direct, np.arange(n), n)
    seed = np.append(np.minimum.accumulate(seed[::-1])[::-1], n)
    upto = np.minimum(seed[bounds[:-1] + need], bounds[1:])
    lo = np.repeat(bounds[:-1], lengths)
    wanted = np.arange(n) <= np.repeat(upto, lengths)
    # Stage one: sort the direct suffixes.
    first = np.flatnonzero(direct & wanted)
    text = flat.tobytes().decode("latin-1")
    ends = np.minimum(first + depth, own_end[first])
    strings = [text[a:z] for a, z in zip(first.tolist(), ends.tolist())]
    first = first[np.array(sorted(range(len(strings)), key=strings.__getitem__), np.int64)] if len(first) else first
    del strings
    # Stage two: scan the buckets; a suffix puts its predecessor, if that is larger, at the front of its bucket.
    induced = ~direct & wanted
    n_direct = np.bincount(code[first], minlength=258)
    n_induced = np.bincount(code[:n][induced], minlength=258)
    begin = np.concatenate([[0], np.cumsum(n_direct + n_induced)])
    array = np.empty(int(begin[-1]), np.int64)
    front = begin[:-1].copy()
    d_at = np.concatenate([[0], np.cumsum(n_direct)])
    ends_of = bounds[1:][upto == bounds[1:]]              # empty suffixes, in any order

    def induce(found: np.ndarray) -> None:
        put(found[found > lo[found]] - 1)

    def put(before: np.ndarray) -> None:
        before = before[induced[before]]
        if not len(before):
            return
        before = before[np.argsort(code[before], kind="stable")]
        c = code[before]
        runs = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        sizes = np.diff(np.append(runs, len(c)))
        array[np.repeat(front[c[runs]] - runs, sizes) + np.arange(len(c))] = before
        front[c[runs]] += sizes

    put(ends_of - 1)                                      # the empty suffixes come before all buckets
    for c in np.flatnonzero(n_direct + n_induced):
        at = begin[c]
        while at < front[c]:
            stop = front[c]
            induce(array[at:stop])
            at = stop
        own = first[d_at[c]: d_at[c + 1]]
        array[begin[c + 1] - len(own): begin[c + 1]] = own
        induce(own)
    return array[array < np.repeat(bounds[:-1] + need, lengths)[array]]


def common_prefixes(flat: np.ndarray, suffixes: np.ndarray, depth: int, chunk: int = 1 << 14) -> np.ndarray:
    """Common prefix of each suffix with the one before it, up to ``depth`` bytes, which all have."""
    out = np.zeros(len(suffixes), np.int16)
    if not len(suffixes):
        return out
    windows = np.lib.stride_tricks.sliding_window_view(flat, depth)
    for i in range(1, len(suffixes), chunk):
        j = min(i + chunk, len(suffixes))
        w = windows[suffixes[i - 1: j]]
        differ = w[1:] != w[:-1]
        at = differ.argmax(axis=1)
        out[i:j] = np.where(differ[np.arange(j - i), at], at, depth)
    return out


def _later(least: dict[bytes, tuple[int, int, int]], length: int) -> np.ndarray:
    """Ranges (block, start, end) of all windows that have an earlier equal one, by a suffix array of the
    texts, each of which stands at its place (id, block, start)."""
    texts = list(least)
    flat = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    ids, block, starts = (np.array([v[k] for v in least.values()], np.int64) for k in range(3))
    array = two_stage_suffix_array(flat, bounds, sizes - length + 1, length)
    same = common_prefixes(flat, array, length) >= length
    group = np.cumsum(~same)
    in_group = same | np.append(same[1:], False)
    array, group = array[in_group], group[in_group]
    text = np.searchsorted(bounds, array, side="right") - 1
    at = starts[text] + array - bounds[text]
    order = np.lexsort((at, block[text], ids[text], group))
    later = order[np.concatenate([[False], group[order][1:] == group[order][:-1]])] if len(order) else order
    b, a = block[text[later]], at[later]
    order = np.lexsort((a, b))
    b, a = b[order], a[order]
    if not len(b):
        return np.zeros((0, 3), np.int64)
    new = np.concatenate([[True], (b[1:] != b[:-1]) | (a[1:] > a[:-1] + length)])
    last = np.append(new[1:], True)
    return np.stack([b[new], a[new], a[last] + length], axis=1)


def _resolve(length: int):
    """Suffix arrays of the texts of one share; the ranges that repeat, by block."""
    def fn(table: pa.Table) -> pa.Table:
        ready = table.filter(table.column("ids").is_null())
        table = table.filter(table.column("ids").is_valid())
        ids, starts, lengths, of = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in
            (("ids", np.int64), ("starts", np.int64), ("lengths", np.int32), ("pieces", np.uint8)))
        blocks = np.repeat(table.column("block").to_numpy(), [len(x.as_py()) for x in table.column("pieces")])
        data = b"".join(B.expand(x.as_py()) for x in table.column("data"))
        at = np.cumsum(lengths, dtype=np.int64) - lengths
        found = [np.zeros((0, 3), np.int64)]
        for p in np.flatnonzero(np.bincount(of)):
            own = np.flatnonzero(of == p)
            least: dict[bytes, tuple[int, int, int]] = {}
            out: list[tuple[int, int, int]] = []
            for i, block, s, a, m in zip(*(x[own].tolist() for x in (ids, blocks, starts, at, lengths))):
                text, mine = data[a: a + m], (i, block, s)
                have = least.get(text)
                if have is None:
                    least[text] = mine
                else:
                    early, late = (have, mine) if have < mine else (mine, have)
                    least[text] = early
                    out.append((late[1], late[2], late[2] + m))
            found += [np.array(out, np.int64).reshape(-1, 3), _later(least, length)]
        spans = np.concatenate(found)
        spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
        points = np.flatnonzero(np.concatenate([[True], np.diff(spans[:, 0]) != 0])) if len(spans) else []
        ends = np.append(points[1:], len(spans)) if len(spans) else []
        return pa.table([pa.array([int(spans[p, 0]) for p in points] + ready.column("block").to_pylist(), pa.int64()),
                         pa.array([B.squeeze(np.ascontiguousarray(spans[p:e, 1:]).tobytes()) for p, e in zip(points, ends)]
                                  + ready.column("data").to_pylist(), pa.binary())], names=["block", "spans"])
    return fn


def _finish(keep_bytes: bool):
    def fn(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for r in range(left.num_rows):
            block = B.Block.of(left, r)
            edge = np.zeros(len(block.data) + 1, np.int64)
            for spans in right.column("spans").to_pylist():
                pairs = np.frombuffer(B.expand(spans), np.int64).reshape(-1, 2)
                np.add.at(edge, pairs[:, 0], 1)
                np.add.at(edge, pairs[:, 1], -1)
            gone = np.cumsum(edge[:-1]) > 0
            n = len(block.ids)
            removed = np.concatenate([[0], np.cumsum(gone)])[block.starts]
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            inner = block.starts[:-1][block.lengths > 0]
            opens[inner] = gone[inner]
            runs = np.concatenate([[0], np.cumsum(opens)])[block.starts]
            kept = block.data[~gone].tobytes()
            at = block.starts - removed
            pieces = [kept[at[i]: at[i + 1]] for i in range(n)]
            cols = [block.id_array(), pa.array(block.lengths, pa.int64()), pa.array(np.diff(removed), pa.int64()),
                    pa.array(np.diff(runs), pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in pieces], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_bytes:
                cols.append(pa.array(pieces, pa.binary()))
                names.append("kept")
            parts.append(pa.table(cols, names=names))
        return pa.concat_tables(parts)
    return fn


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, keep_bytes: bool = True) -> DataFrame:
    """One row for each document: doc_id, n_bytes, n_removed, n_spans (maximal removed
    runs), kept_sha256 and, with ``keep_bytes``, the bytes kept (a cut can fall inside a
    character, so they are binary).

    From the answers on it is one plan, so the candidate texts stand on disk once, as a
    shuffle, and both cogroups read one exchange of the blocks.  Each action on the result
    runs that plan: write it before using it twice."""
    table = B.write_blocks(docs, id_col, text_col)
    total = B.n_shares(table, PIECE_BYTES, LEAST_SHARES)
    n = max(LEAST_SHARES, -(-total // PIECES))
    pieces = -(-total // n)
    asked = table.select(*B.OPEN_COLUMNS).mapInArrow(
        _ask(length, gram, n), "share int, block long, keys binary, counts binary")
    answers = cut_lineage(asked.groupBy("share").applyInArrow(_answer, ANSWER))
    hot = _often(answers)
    opened = table.select(*B.OPEN_COLUMNS).groupBy("block")
    sent = opened.cogroup(answers.select("block", "share", "bits").groupBy("block")).applyInArrow(
        _send(length, gram, n, pieces, hot), SENT)
    spans = sent.groupBy("share").applyInArrow(_resolve(length), "block long, spans binary")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return opened.cogroup(spans.groupBy("block")).applyInArrow(
        _finish(keep_bytes), schema + (", kept binary" if keep_bytes else ""))

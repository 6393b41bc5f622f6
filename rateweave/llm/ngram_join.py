"""Operator 4: similarity join of word n-gram sets that skips by set relations.

A document's set holds the hashes of its distinct n-word shingles; documents link when
their sets' Jaccard similarity reaches t = ``num / den``.  The join runs in groups that
hold both sides of every link, and in a group by index blocks and by answers derived from
similar sets.

Dealing out, without loss.  Shingles are ranked rare first: by how many sets have them,
counted for a fixed share of all hashes (the others rank last), then by hash.  Linked sets
have a shingle in common among the first a - ceil(t a) + 1 of each, the prefix.  Prefix
shingles that other sets have as well meet in hash ranges, and the sets of one shingle's
list go to the group of the list's first set.  Of equal sets only the first goes on, so
that copies never fill a group, and a block sends a set once however many copies it holds.

In a group.  Shingles are ranked by how rare they are there, and an index lists the sets
by the shingles of their prefixes, in blocks of one size and one position.  A block whose
size or position rules out enough common shingles is skipped as a whole.  A set that was
answered so, a leader, knows its overlap with all sets at similarity 2t - 1 or more.
That covers whatever a set linked with it can be linked with, so the answers of such a
set follow from the leader's by the lists of the shingles in which the two differ; and
nothing is to be done if all of them are connected already.

A group of over ``GROUP_SETS`` sets is cut into parts, and every two parts are joined by
a task of their own, so that no task holds an unbounded group.

Components need not every link, counts and pairs do.  For these all answers are derived, and
a pair counts in one place: in the smallest group that both sets are in, and there in the
task of their two parts.  So tasks give each set's links as one number, weighted by the
documents with equal sets, and pairs are only sent if they are asked for.

Empty and null texts have an empty set, linked with nothing.  Null ids are documents like
others; a component's id is its smallest doc_id that is not null.  Repeated rows are
documents of their own with equal sets.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.llm import blocks as B
from rateweave.llm.components import components
from rateweave.operators.joins import measured_bytes
from rateweave.session import cut_lineage

SHARE_BYTES = 16 << 20
TASK_BYTES = 2 << 20
GROUP_SETS = 1000
#: The places of sets are broadcast up to so many bytes; beyond, sets and places are shuffled.
BROADCAST_BYTES = 16 << 20
#: Shingles are counted whose hashes are in the first part of all: so many times a prefix's share.
COUNTED = 2.5
UNCOUNTED = 15

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_K = np.uint64(0xD6E8FEB86659FD93)


def _seed(n: int) -> np.uint64:
    return np.uint64(n * int(_K) % (1 << 64))


def shingle_sets(block: B.Block, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, joined, and where each document's begin."""
    n = len(block.ids)
    data = _LOWER[block.data]
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[block.starts] = True
    before = np.concatenate([[False], word])
    start = np.flatnonzero(word & (~before[:-1] | edge[:-1]))
    after = np.append(word[1:], False)
    end = np.flatnonzero(word & (~after | edge[1:])) + 1
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    h = B.range_hash(B.prefix_hash(data), start, end)
    doc = np.searchsorted(block.starts, start, side="right") - 1
    n_words = np.bincount(doc, minlength=n)
    first_word = np.concatenate([[0], np.cumsum(n_words)])
    found = np.full(len(h), _seed(words), np.uint64)
    for j in range(words):
        own = slice(0, max(len(h) - j, 0))
        found[own] = B.mix(found[own] * _K + h[j:])
    whole = np.arange(len(h)) + words <= first_word[doc + 1]
    short = np.flatnonzero((n_words > 0) & (n_words < words))
    for j in range(1, words):                 # the whole sequence of a short document is its one shingle
        own = first_word[short[n_words[short] == j]]
        acc = np.full(len(own), _seed(words + j), np.uint64)
        for k in range(j):
            acc = B.mix(acc * _K + h[own + k])
        found[own] = acc
        whole[own] = True
    found, doc = found[whole], doc[whole]
    at = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))])
    for a, z in zip(at[:-1].tolist(), at[1:].tolist()):
        found[a:z].sort()
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
    return found[new], np.concatenate([[0], np.cumsum(np.bincount(doc[new], minlength=n))])


def signatures(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Two 64-bit sums that stand for a whole set (n x 2)."""
    out = np.zeros((len(at) - 1, 2), np.uint64)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        out[full, 0] = np.add.reduceat(B.mix(sets ^ _K), at[full])
        out[full, 1] = np.add.reduceat(B.mix(sets * _K + np.uint64(1)), at[full])
    return out


def _first_copies(sizes: np.ndarray, sig: np.ndarray) -> np.ndarray:
    """For each document of a block the first one with an equal set (itself if the set is empty)."""
    order = np.lexsort((np.arange(len(sig)), sig[:, 1], sig[:, 0], sizes))
    if not len(order):
        return order
    s, k = sig[order], sizes[order]
    new = np.ones(len(order), bool)
    new[1:] = (s[1:] != s[:-1]).any(axis=1) | (k[1:] != k[:-1]) | (k[1:] == 0)
    out = np.empty(len(order), np.int64)
    out[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    return out


class Counting:
    """Which shingles are counted, and how their hashes are cut short and dealt out."""

    def __init__(self, n_shares: int, total_bytes: int, num: int, den: int):
        self.n, self.num, self.den = n_shares, num, den
        # so many bits that two shingles of the corpus seldom share a key; if they do, both only rank later
        self.shift = 64 - min(62, max(32, int(total_bytes).bit_length() + 4))
        share = min(1.0, COUNTED * (den - num) / den)
        self.end = int(share * (1 << (64 - self.shift)))
        self.bounds = np.array([k * self.end // n_shares for k in range(n_shares)], np.uint64)

    def keys(self, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of shingles, and which of them are counted."""
        keys = sets >> np.uint64(self.shift)
        return keys, keys < np.uint64(self.end) if self.end < 1 << 64 else np.ones(len(keys), bool)

    def prefix(self, sizes: np.ndarray) -> np.ndarray:
        return np.where(sizes > 0, sizes + 1 - -(-sizes * self.num // self.den), 0)


def _own_sets(block: B.Block, words: int):
    """Sets of a block, where they begin, signatures, and the rows of shingles of sets that aren't copies."""
    sets, at = shingle_sets(block, words)
    sizes = np.diff(at)
    sig = signatures(sets, at)
    first = _first_copies(sizes, sig)
    return sets, at, sig, first, np.repeat(first == np.arange(len(sizes)), sizes)


def _packed(values: np.ndarray) -> bytes:
    return B.squeeze(np.diff(values, prepend=values[:1]).tobytes())


def _unpacked(first: int, raw: bytes) -> np.ndarray:
    return np.uint64(first) + np.cumsum(np.frombuffer(B.expand(raw), np.uint64), dtype=np.uint64)


def _send_counts(words: int, count: Counting):
    def fn(block_id: int, block: B.Block):
        sets, _, _, _, own = _own_sets(block, words)
        keys, counted = count.keys(sets[own])
        keys, times = B.sorted_unique(keys[counted])
        points = B.split_points(keys, count.bounds)
        shares = np.flatnonzero(np.diff(points))
        pick = [(points[s], points[s + 1]) for s in shares]
        times = np.minimum(times, 65535).astype(np.uint16)
        return pa.RecordBatch.from_arrays(
            [pa.array(shares, pa.int32()), pa.array(np.full(len(shares), block_id), pa.int64()),
             pa.array([int(keys[a]) for a, _ in pick], pa.int64()),
             pa.array([_packed(keys[a:z]) for a, z in pick], pa.binary()),
             pa.array([B.squeeze(times[a:z].tobytes()) for a, z in pick], pa.binary())],
            names=["share", "block", "first", "keys", "times"])
    return B.each_block(fn)


def _count(table: pa.Table) -> pa.Table:
    """For each block of a share the ranks of its keys: 0 where one set has it, then by powers of two."""
    cols = {c: table.column(c).to_pylist() for c in ("first", "keys", "times")}
    sent = [_unpacked(f, k) for f, k in zip(cols["first"], cols["keys"])]
    times = np.concatenate([np.frombuffer(B.expand(t), np.uint16) for t in cols["times"]]).astype(np.int64)
    keys = np.concatenate(sent)
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    total = np.add.reduceat(times[order], first)
    rank = np.where(total > 1, np.minimum(np.log2(total).astype(np.int64), UNCOUNTED - 1), 0).astype(np.uint8)
    ranks = np.empty(len(keys), np.uint8)
    ranks[order] = np.repeat(rank, np.diff(np.append(first, len(s))))
    ends = np.cumsum([len(x) for x in sent])
    return pa.table({"block": table.column("block"), "share": table.column("share"), "ranks": pa.array(
        [B.squeeze(ranks[e - len(x): e].tobytes()) for e, x in zip(ends, sent)], pa.binary())})


def _open(words: int, count: Counting):
    """Rows of documents, the sets that share a prefix shingle, and their prefixes by hash range."""
    kinds = {"node": pa.int64(), "doc_id": pa.int64(), "n_shingles": pa.int64(), "first": pa.int64(),
             "shingles": pa.binary(), "share": pa.int32(), "keys": pa.binary(), "owners": pa.binary(), "equal": pa.binary()}
    bounds = B.share_bounds(count.n)

    def rows(n: int, **given) -> pa.Table:
        return pa.table({c: given.get(c, pa.nulls(n, k)) for c, k in kinds.items()})

    def fn(key, left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [rows(0)]
        for r in range(left.num_rows):
            block, block_id = B.Block.of(left, r), key[0].as_py()
            sets, at, sig, first, own = _own_sets(block, words)
            sizes = np.diff(at)
            node = (block_id << 16) + np.arange(len(sizes))
            parts.append(rows(len(node), node=pa.array(node), doc_id=block.id_array(), n_shingles=pa.array(sizes),
                              first=pa.array(node[first])))
            doc, sets = np.repeat(np.arange(len(sizes)), sizes)[own], sets[own]
            short, counted = count.keys(sets)
            known, _ = B.sorted_unique(short[counted])
            ranks, points = np.zeros(len(known), np.uint8), B.split_points(known, count.bounds)
            for share, raw in zip(right.column("share").to_pylist(), right.column("ranks").to_pylist()):
                ranks[points[share]: points[share + 1]] = np.frombuffer(B.expand(raw), np.uint8)
            rank = np.full(len(sets), UNCOUNTED, np.int64)
            rank[counted] = ranks[np.searchsorted(known, short[counted])]
            order = np.argsort(doc * 16 + rank, kind="stable")         # shingles stand by hash already
            place = np.arange(len(sets)) - np.repeat(np.cumsum(np.bincount(doc, minlength=len(sizes)))
                                                     - np.bincount(doc, minlength=len(sizes)),
                                                     np.bincount(doc, minlength=len(sizes)))
            take = order[(place < count.prefix(sizes)[doc]) & (rank[order] > 0)]
            full = np.flatnonzero((first == np.arange(len(sizes))) & (sizes > 0))
            keys = np.concatenate([sets[take], B.mix(sig[full, 0] + B.mix(sig[full, 1]) + sizes[full].astype(np.uint64))])
            owners = np.concatenate([doc[take], full])
            equal = np.concatenate([np.zeros(len(take), bool), np.ones(len(full), bool)])
            order = np.argsort(keys, kind="stable")
            keys, owners, equal = keys[order], owners[order].astype(np.uint16), equal[order]
            points = B.split_points(keys, bounds)
            shares = np.flatnonzero(np.diff(points))
            pick = [(points[s], points[s + 1]) for s in shares]
            parts.append(rows(len(shares), node=pa.array(np.full(len(shares), block_id << 16)), share=pa.array(shares, pa.int32()),
                              **{c: pa.array([x[a:z].tobytes() for a, z in pick], pa.binary())
                                 for c, x in (("keys", keys), ("owners", owners), ("equal", equal))}))
            some = np.unique(doc[take])
            begin = np.searchsorted(doc, np.arange(len(sizes) + 1))
            parts.append(rows(len(some), node=pa.array(node[some]), shingles=pa.array(
                [sets[begin[i]: begin[i + 1]].tobytes() for i in some], pa.binary())))
        return pa.concat_tables(parts)
    return fn


OPENED = ("node long, doc_id long, n_shingles long, first long, shingles binary, share int, keys binary, owners binary, "
          "equal binary")


def _meet(table: pa.Table) -> pa.Table:
    """Sets of one key, each with the first of them; ``equal`` where the whole sets are equal."""
    cols = {c: table.column(c).to_pylist() for c in ("node", "keys", "owners", "equal")}
    keys = np.concatenate([np.frombuffer(x, np.uint64) for x in cols["keys"]])
    node = np.concatenate([np.frombuffer(o, np.uint16).astype(np.int64) + b for o, b in zip(cols["owners"], cols["node"])])
    equal = np.concatenate([np.frombuffer(x, bool) for x in cols["equal"]])
    order = np.lexsort((node, keys))
    k, v, e = keys[order], node[order], equal[order]
    start = np.concatenate([[True], k[1:] != k[:-1]])
    several = ~start | np.append(~start[1:], False)
    first = v[np.maximum.accumulate(np.where(start, np.arange(len(k)), 0))]
    edge = np.unique(np.stack([v, first, e.astype(np.int64)], axis=1)[several], axis=0)
    return pa.table({"a": pa.array(edge[:, 0]), "b": pa.array(edge[:, 1]), "equal": pa.array(edge[:, 2] > 0)})


class SetGroup:
    """The sets of a group, their block index and their full lists."""

    def __init__(self, sets: list[np.ndarray], num: int, den: int):
        self.num, self.den = num, den
        self.near = max(2 * num - den, 0)                 # a set linked with a linked set is this similar at least
        self.sizes = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        joined = np.concatenate(sets)
        order = np.argsort(joined, kind="stable")
        s = joined[order]
        first = np.concatenate([[True], s[1:] != s[:-1]])
        token = np.empty(len(s), np.int64)
        token[order] = np.cumsum(first) - 1
        count = np.bincount(token)
        rank = np.empty(len(count), np.int64)
        rank[np.lexsort((np.arange(len(count)), count))] = np.arange(len(count))   # rare shingles first
        token = rank[token]
        at = np.concatenate([[0], np.cumsum(self.sizes)])
        self.sets = [np.sort(token[a:z]) for a, z in zip(at[:-1], at[1:])]
        token = np.concatenate(self.sets)
        by = np.argsort(token, kind="stable")
        self.lists, self.list_at = owner[by], np.concatenate([[0], np.cumsum(np.bincount(token, minlength=len(count)))])
        # The index: prefixes only, in blocks of one shingle, size and position.
        place = np.arange(len(token)) - np.repeat(at[:-1], self.sizes)
        keep = place < np.repeat(self.prefix(self.sizes), self.sizes)
        token, place, owner = token[keep], place[keep], owner[keep]
        by = np.lexsort((owner, place, self.sizes[owner], token))
        token, place, self.members = token[by], place[by], owner[by]
        size = self.sizes[self.members]
        new = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (size[1:] != size[:-1])
                                             | (place[1:] != place[:-1])]))
        self.block_at = np.append(new, len(token))
        self.block_size, self.block_place = size[new], place[new]
        self.token_at = np.searchsorted(token[new], np.arange(len(count) + 1))

    def prefix(self, sizes):
        return sizes + 1 - np.maximum(1, -(-sizes * self.near // self.den))

    def reaches(self, overlap, a, b, num: int):
        return self.den * overlap >= num * (a + b - overlap)

    def overlaps(self, tokens: np.ndarray) -> np.ndarray:
        """How many of ``tokens`` each set has, by the full lists."""
        spans = [self.lists[self.list_at[t]: self.list_at[t + 1]] for t in tokens.tolist()]
        return np.bincount(np.concatenate(spans), minlength=len(self.sets)) if spans else np.zeros(len(self.sets), np.int64)

    def answers(self, x: int) -> tuple[np.ndarray, np.ndarray]:
        """Sets of similarity 2t - 1 or more with x and their overlaps, blocks skipped by size and position."""
        n, found = int(self.sizes[x]), np.zeros(len(self.sets), bool)
        for i, t in enumerate(self.sets[x][: int(self.prefix(self.sizes[x]))].tolist()):
            a, z = self.token_at[t], self.token_at[t + 1]
            if z - a == 1 and self.block_at[a + 1] - self.block_at[a] == 1:
                continue                                   # no other set has this shingle in its prefix
            size, place = self.block_size[a:z], self.block_place[a:z]
            most = np.minimum(i, place) + 1 + np.minimum(n - i - 1, size - place - 1)
            for b in np.flatnonzero(self.reaches(np.minimum(most, np.minimum(n, size)), n, size, self.near)) + a:
                found[self.members[self.block_at[b]: self.block_at[b + 1]]] = True
        found[x] = True
        y = np.flatnonzero(found)
        overlap = self.overlaps(self.sets[x])[y] if len(y) > 1 else np.array([n])
        near = self.reaches(overlap, n, self.sizes[y], self.near)
        return y[near], overlap[near]

    def links(self, wanted):
        """For each set x with others in the mask ``wanted(x)``: x, those of them it links with, and the overlaps.
        No answer is left out because its sets are connected already."""
        done = np.zeros(len(self.sets), bool)
        for x in np.argsort(self.sizes, kind="stable").tolist():
            if done[x]:
                continue
            done[x] = True
            mask = wanted(x)
            if not mask.any():
                continue
            y, overlap = self.answers(x)
            linked = self.reaches(overlap, self.sizes[x], self.sizes[y], self.num)
            yield x, y[linked & mask[y]], overlap[linked & mask[y]]
            if not self.near:
                continue                                   # a follower may link with sets that have nothing of x
            for own in y[linked & ~done[y]].tolist():
                done[own] = True
                mask = wanted(own)[y]
                if not mask.any():
                    continue
                less = np.setdiff1d(self.sets[x], self.sets[own], assume_unique=True)
                more = np.setdiff1d(self.sets[own], self.sets[x], assume_unique=True)
                derived = overlap - self.overlaps(less)[y] + self.overlaps(more)[y]
                mask &= self.reaches(derived, self.sizes[own], self.sizes[y], self.num)
                yield own, y[mask], derived[mask]

    def roots(self) -> np.ndarray:
        """For each set the first one that links lead to."""
        parent = np.arange(len(self.sets))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return int(i)

        def join(i: int, others: np.ndarray) -> None:
            for j in others.tolist():
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)

        done = np.zeros(len(self.sets), bool)
        for x in np.argsort(self.sizes, kind="stable").tolist():
            if done[x]:
                continue
            y, overlap = self.answers(x)
            done[x] = True
            linked = self.reaches(overlap, self.sizes[x], self.sizes[y], self.num)
            join(x, y[linked])
            if not self.near:
                continue                                   # a follower may link with sets that have nothing of x
            for k in np.flatnonzero(linked & ~done[y]).tolist():
                own = int(y[k])
                done[own] = True
                if len({root(i) for i in y.tolist()}) == 1:
                    continue                               # whatever it links with is connected already
                less = np.setdiff1d(self.sets[x], self.sets[own], assume_unique=True)
                more = np.setdiff1d(self.sets[own], self.sets[x], assume_unique=True)
                derived = overlap - self.overlaps(less)[y] + self.overlaps(more)[y]
                join(own, y[self.reaches(derived, self.sizes[own], self.sizes[y], self.num)])
        return np.array([root(i) for i in range(len(self.sets))])


def _join_groups(num: int, den: int):
    def fn(table: pa.Table) -> pa.Table:
        group, node = table.column("group").to_numpy(), table.column("node").to_numpy()
        raw = table.column("shingles").to_pylist()
        order = np.lexsort((node, group))
        points = np.flatnonzero(np.concatenate([[True], group[order][1:] != group[order][:-1]]))
        a, b = [], []
        for p, e in zip(points, np.append(points[1:], len(order))):
            own = order[p:e]
            if len(own) > 1:
                roots = SetGroup([np.frombuffer(raw[i], np.uint64) for i in own], num, den).roots()
                moved = np.flatnonzero(roots != np.arange(len(own)))
                a.append(node[own[moved]])
                b.append(node[own[roots[moved]]])
        cat = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64))
        return pa.table({"a": cat(a), "b": cat(b)})
    return fn


def _wanted(n: int, group: int, groups: list[np.ndarray], part: np.ndarray, across: bool):
    """For set x of a group which others are to be looked at here: those that share no smaller
    group with x and, in a task of two parts, are in the other one."""
    own = [g[g < group] for g in groups]
    owner = np.repeat(np.arange(n), [len(g) for g in own])
    names, token = np.unique(np.concatenate(own), return_inverse=True)
    by = np.argsort(token, kind="stable")
    lists = np.split(owner[by], np.cumsum(np.bincount(token, minlength=len(names)))[:-1]) if len(names) else []
    tokens = np.split(token, np.cumsum([len(g) for g in own])[:-1])

    def wanted(x: int) -> np.ndarray:
        mask = part != part[x] if across else np.ones(n, bool)
        mask[x] = False
        for t in tokens[x].tolist():
            mask[lists[t]] = False
        return mask
    return wanted


def _link_groups(num: int, den: int, pairs: bool):
    """Rows a, b, n: with ``pairs`` each link once with its overlap; else links that connect all that
    is linked (n is null) and for each set a the documents that it links with here (b is null)."""
    def fn(table: pa.Table) -> pa.Table:
        group, node, part, i, j, weight = (table.column(c).to_numpy() for c in ("group", "node", "p", "i", "j", "weight"))
        raw = table.column("shingles").to_pylist()
        groups = [np.array(g, np.int64) for g in table.column("groups").to_pylist()]
        order = np.lexsort((node, group))
        points = np.flatnonzero(np.concatenate([[True], group[order][1:] != group[order][:-1]]))
        out = [np.zeros((0, 3), np.int64)], [np.zeros((0, 2), np.int64)], [np.zeros((0, 2), np.int64)]
        for p, e in zip(points, np.append(points[1:], len(order))):
            own = order[p:e]
            if len(own) < 2:
                continue
            nodes, w, label = node[own], weight[own], np.arange(len(own))
            found = SetGroup([np.frombuffer(raw[k], np.uint64) for k in own], num, den)
            wanted = _wanted(len(own), int(group[own[0]]), [groups[k] for k in own], part[own], bool((i != j)[own[0]]))
            n_links = np.zeros(len(own), np.int64)
            for x, y, overlap in found.links(wanted):
                if pairs:
                    up = y > x
                    out[0].append(np.stack([np.full(int(up.sum()), nodes[x]), nodes[y[up]], overlap[up]], axis=1))
                elif len(y):
                    n_links[x] = w[y].sum()
                    near = np.append(label[y], label[x])
                    if (near != near[0]).any():
                        label[np.isin(label, near)] = near.min()
            moved, some = np.flatnonzero(label != np.arange(len(own))), np.flatnonzero(n_links)
            out[1].append(np.stack([nodes[moved], nodes[label[moved]]], axis=1))
            out[2].append(np.stack([nodes[some], n_links[some]], axis=1))
        pair, edge, count = (np.concatenate(x) for x in out)
        none = lambda n: pa.nulls(n, pa.int64())
        kinds = [(pair[:, 0], pair[:, 1], pair[:, 2]), (edge[:, 0], edge[:, 1], none(len(edge))), (count[:, 0], none(len(count)), count[:, 1])]
        return pa.concat_tables([pa.table({"a": pa.array(a), "b": pa.array(b), "n": pa.array(n)}) for a, b, n in kinds])
    return fn


def _tasks(asked: DataFrame, n_shares: int, group_sets: int) -> DataFrame:
    """Where the set of each (node, group) goes: small groups by share; larger ones cut into parts,
    with a task for every two parts.  Groups of one set have nothing to join."""
    sizes = asked.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parted = asked.join(sizes, "group").withColumn("parts", F.ceil(F.col("n") / group_sets).cast("int")) \
        .withColumn("p", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    return parted.withColumn("q", other).select(
        F.when(F.col("parts") == 1, F.pmod(F.xxhash64("group"), F.lit(n_shares))).otherwise(-1 - F.col("group")).alias("task"),
        F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"), "group", "node", "p")


def _opened(table: DataFrame, words: int, num: int, den: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of documents and of sets; of each copy the first equal set; the groups of each set."""
    n = B.n_shares(table, SHARE_BYTES)
    count = Counting(n, table.agg(F.sum("n_bytes")).first()[0] or 0, num, den)
    cols = table.select(*B.OPEN_COLUMNS)
    sent = cols.mapInArrow(_send_counts(words, count), "share int, block long, first long, keys binary, times binary")
    ranks = sent.groupBy("share").applyInArrow(_count, "block long, share int, ranks binary")
    opened = cut_lineage(cols.groupBy("block").cogroup(ranks.groupBy("block")).applyInArrow(_open(words, count), OPENED))
    met = cut_lineage(opened.where("share is not null").select("share", "node", "keys", "owners", "equal").groupBy("share")
                      .applyInArrow(_meet, "a long, b long, equal boolean")
                      .groupBy("a", "b").agg(F.max("equal").alias("equal")))
    copies = met.where("equal and a != b").groupBy("a").agg(F.min("b").alias("b"))  # of a copy: the first equal set
    own = met.join(copies.select("a"), "a", "left_anti").select(F.col("a").alias("node"), F.col("b").alias("group"))
    return opened, copies, own


def linked_documents(table: DataFrame, words: int = 5, num: int = 80, den: int = 100,
                     group_sets: int = GROUP_SETS) -> DataFrame:
    """For a table of blocks, a row for each document: node (its place: block and index), doc_id,
    n_shingles and ``component``, the first node of its component."""
    opened, copies, own = _opened(table, words, num, den)
    n_tasks = B.n_shares(table, TASK_BYTES)
    places = cut_lineage(_tasks(own, n_tasks, group_sets).drop("p"))
    small = F.broadcast(places) if measured_bytes(places) <= BROADCAST_BYTES else places
    # Joins are long for the few bytes that they read, so their tasks are dealt out by number.
    tasks = opened.where("shingles is not null").select("node", "shingles").join(small, "node") \
        .repartition(n_tasks, "task", "i", "j")
    links = tasks.groupBy("task", "i", "j").applyInArrow(_join_groups(num, den), "a long, b long")
    joined = components(links.unionByName(copies))
    docs = opened.where("n_shingles is not null").select("node", "doc_id", "n_shingles", "first")
    return docs.join(joined.withColumnRenamed("node", "first"), "first", "left").select(
        "node", "doc_id", "n_shingles", F.coalesce("root", "first").alias("component"))


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                     num: int = 80, den: int = 100) -> DataFrame:
    """One row for each document: doc_id, n_shingles and component_id, the smallest doc_id reachable."""
    rows = cut_lineage(linked_documents(B.write_blocks(docs, id_col, text_col), words, num, den))
    least = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "component").select("doc_id", "n_shingles", "component_id")


def _all_links(table: DataFrame, words: int, num: int, den: int, group_sets: int, pairs: bool):
    """Rows of documents, the set of each first copy, the documents of each set, the copies, and what
    ``_link_groups`` gives."""
    opened, copies, own = _opened(table, words, num, den)
    docs = opened.where("n_shingles is not null").select("node", "doc_id", "n_shingles", "first")
    firsts = docs.where("n_shingles > 0").groupBy("first").agg(F.count(F.lit(1)).alias("m"), F.min("doc_id").alias("least")) \
        .join(copies.select(F.col("a").alias("first"), "b"), "first", "left") \
        .select("first", "m", "least", F.coalesce("b", "first").alias("set"))
    weights = cut_lineage(firsts.groupBy("set").agg(F.sum("m").alias("weight"), F.min("least").alias("least")))
    sets = cut_lineage(firsts.select("first", "set").join(weights.select("set", "weight"), "set"))
    n_tasks = B.n_shares(table, TASK_BYTES)
    own = cut_lineage(own)
    places = cut_lineage(_tasks(own, n_tasks, group_sets))
    about = own.groupBy("node").agg(F.collect_set("group").alias("groups")) \
        .join(weights.select(F.col("set").alias("node"), "weight"), "node")
    tasks = opened.where("shingles is not null").select("node", "shingles").join(about, "node").join(places, "node") \
        .repartition(n_tasks, "task", "i", "j")
    found = cut_lineage(tasks.groupBy("task", "i", "j").applyInArrow(_link_groups(num, den, pairs), "a long, b long, n long"))
    return docs, sets, weights, copies, found


def ngram_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80,
                den: int = 100, group_sets: int = GROUP_SETS) -> DataFrame:
    """The rows of ``ngram_components`` and n_links, the other documents (each copy is one) whose
    similarity with this one reaches the threshold."""
    rows, sets, _, copies, found = _all_links(B.write_blocks(docs, id_col, text_col), words, num, den, group_sets, False)
    joined = components(found.where("b is not null").select("a", "b").unionByName(copies))
    counts = found.where("b is null").groupBy(F.col("a").alias("set")).agg(F.sum("n").alias("n"))
    firsts = sets.join(counts, "set", "left").join(joined.withColumnRenamed("node", "first"), "first", "left").select(
        "first", F.coalesce("root", "first").alias("root"), (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    rows = cut_lineage(rows.join(firsts, "first", "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "first", "node").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    least = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "component").select("doc_id", "n_shingles", "component_id", "n_links")


def ngram_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80,
                den: int = 100, group_sets: int = GROUP_SETS) -> DataFrame:
    """One row for each two different sets that are linked: the smallest doc_id of each (null if it
    has none), how many documents have it, the shingles in common and the similarity."""
    rows, _, weights, _, found = _all_links(B.write_blocks(docs, id_col, text_col), words, num, den, group_sets, True)
    sizes = rows.select(F.col("node").alias("set"), "n_shingles")
    own = cut_lineage(weights.join(sizes, "set"))
    side = lambda s: own.select(F.col("set").alias(s), F.col("least").alias(f"doc_{s}"), F.col("weight").alias(f"n_{s}"),
                                F.col("n_shingles").alias(f"size_{s}"))
    return found.withColumnRenamed("n", "common").join(side("a"), "a").join(side("b"), "b").select(
        "doc_a", "doc_b", "n_a", "n_b", "common",
        (F.col("common") / (F.col("size_a") + F.col("size_b") - F.col("common"))).alias("similarity"))


def _kept(columns: list[str], text_col: str):
    def fn(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for r in range(batch.num_rows):
                own = np.sort(np.array(table.column("kept")[r].as_py(), np.int64))
                yield from B.Block.of(table, r).rows(table.column("rest")[r].as_py(), own, columns, text_col).to_batches()
    return fn


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                         num: int = 80, den: int = 100) -> DataFrame:
    """The documents of which one of each component stays, with all their columns: the one with
    the smallest doc_id, null ids last, and of one id the first in place."""
    table = B.write_blocks(docs, id_col, text_col, whole_rows=True)
    rows = linked_documents(table, words, num, den)
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    # a block's documents that stay are one row, which the optimizer can send to the blocks or shuffle both
    kept = rows.groupBy("component").agg(F.min(first)["node"].alias("node")) \
        .groupBy(F.shiftright("node", 16).alias("block")).agg(
            F.collect_list(F.col("node").bitwiseAND(0xFFFF).cast("int")).alias("kept"))
    return table.select(*B.OPEN_COLUMNS, "rest").join(cut_lineage(kept), "block") \
        .mapInArrow(_kept(docs.columns, text_col), docs.schema)

"""Operator 12: cheapest repair of conversations by depth-first branch-and-bound.

A conversation's rows go from the first to the last; each is kept (cost 0), given the role user
or assistant (2) or deleted (3), and turns of empty text can be inserted anywhere (2), so that
the initials of the roles become ``(s?(ua)+)?``.  Blank rows and repeats must be deleted; a
truncated row that stays adds 1.  The cheapest edits are wanted, of equal costs the least string
of edits (D, I, K, R).

Rows that must go are runs of D in the string and no choice, and an insertion never stands before
such a run, so the search is over the other rows only.  A node is (rows decided, role that ended
the prefix).  The search goes depth-first with a stack of its own:

* suffix lower bound: what the rows still to come cost at least, counted once from the end (looser
  bounds took time that grew fast on thousands of rows of one role);
* incumbent: the cheapest whole repair so far as (cost, edits); a prefix that can't beat it goes;
* dominance: each node remembers its best prefix; one that costs more, or as much with greater
  edits, goes.  Prefixes of equal cost at a node are never prefixes of one another, as insertions
  cost, so the comparison holds for whatever follows.

When the stack is empty, the incumbent is proved best.  Edits are chains that share their
beginnings, compared from where they part.

Spark sorts a conversation's rows and streams them through one task, which holds a row's role and
kind only; texts are hashed in a second stream.  Equal rows are counted before they travel and
stay one row.  A conversation's edits are one value of the result and must fit into a row.

Null conversation ids are one conversation; null turns come first; nulls in roles and texts are
one space.  Rows of one turn stand by role and text, copies together.  An empty table gives no
rows.  Only the four named columns are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rateweave.session import cut_lineage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: the role that ended the prefix.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {START: "su", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
STATE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLE = {"u": "user", "a": "assistant"}


class _Edit:
    """The last edit of a prefix, and the one before it."""

    __slots__ = ("what", "before", "count")

    def __init__(self, what: str, before: _Edit | None):
        self.what, self.before = what, before
        self.count = before.count + 1 if before else 1


def _compare(a: _Edit | None, b: _Edit | None) -> int:
    """-1, 0 or 1 as the edits of a come before, with or after those of b, as far as both go."""
    m, n = a.count if a else 0, b.count if b else 0
    while m > n:
        a, m = a.before, m - 1
    while n > m:
        b, n = b.before, n - 1
    x = y = ""
    while a is not b:                                    # the last pair seen is where they part
        x, y, a, b = a.what, b.what, a.before, b.before
    return (x > y) - (x < y)


def _bounds(initials: str, truncated: list[bool]) -> list[tuple[int, int, int, int]]:
    """For each row on (and the end), by state, the least that the rest costs, whatever its edits are."""
    n = len(initials)
    start, system, user, assistant = 0, 2 * INSERT, INSERT, 0    # by the role before the rest
    out = [(start, system, user, assistant)]
    for i in range(n - 1, -1, -1):
        here, stays = initials[i], TRUNCATED * truncated[i]
        as_user, as_assistant = stays + REROLE * (here != "u") + user, stays + REROLE * (here != "a") + assistant
        opened = min(DELETE + start, as_user, stays + system if here == "s" else DELETE + start)
        system, user, assistant = min(DELETE + system, as_user), min(DELETE + user, as_assistant), min(DELETE + assistant, as_user)
        start, system, user, assistant = (min(opened, INSERT + user), min(system, INSERT + user), min(user, INSERT + assistant),
                                          min(assistant, INSERT + user))
        out.append((start, system, user, assistant))
    return out[::-1]


def cheapest(initials: str, truncated: list[bool]) -> tuple[int, str]:
    """Cost and edits (K, R, D, I) of the cheapest repair of rows with these initials of roles (of
    roles that are none of s, u and a, any other letter)."""
    n = len(initials)
    bounds = _bounds(initials, truncated)

    best_cost, best = DELETE * n, None
    for _ in range(n):
        best = _Edit("D", best)
    line = _line(best)
    known: dict[tuple[int, int], tuple[int, _Edit | None]] = {(0, START): (0, None)}
    stack: list[tuple[int, int, int, _Edit | None]] = [(0, START, 0, None)]
    while stack:
        i, state, cost, edits = stack.pop()
        have = known[i, state]
        if have[0] != cost or have[1] is not edits:
            continue                                     # a better prefix has come since
        least = cost + bounds[i][state]
        if least > best_cost or least == best_cost and _behind(edits, line):
            continue
        if i == n and state in (START, ASSISTANT):
            if cost < best_cost or _compare(edits, best) < 0:
                best_cost, best, line = cost, edits, _line(edits)
            continue
        nexts = []
        if i < n:
            nexts.append(("D", i + 1, state, cost + DELETE))
            here, stays = initials[i], cost + TRUNCATED * truncated[i]
            if here in FOLLOWS[state]:
                nexts.append(("K", i + 1, STATE[here], stays + KEEP))
            nexts.append(("R", i + 1, STATE[FOLLOWS[state][-1]], stays + REROLE))
        nexts.append(("I", i, STATE[FOLLOWS[state][-1]], cost + INSERT))
        ranked = []
        for what, j, after, total in nexts:
            least = total + bounds[j][after]
            old = known.get((j, after))
            if least > best_cost or old is not None and old[0] < total:
                continue
            chain = _Edit(what, edits)
            if old is not None and old[0] == total and _compare(old[1], chain) <= 0:
                continue
            known[j, after] = total, chain
            ranked.append((least, what, j, after, total, chain))
        ranked.sort(key=lambda x: x[:2], reverse=True)
        stack.extend((j, after, total, chain) for _, _, j, after, total, chain in ranked)
    return best_cost, "".join(e.what for e in line)


def _line(edits: _Edit | None) -> list[_Edit]:
    """All edits of a chain, the first one first."""
    out = []
    while edits is not None:
        out.append(edits)
        edits = edits.before
    return out[::-1]


def _behind(edits: _Edit | None, line: list[_Edit]) -> bool:
    """Whether a prefix is greater than the edits of the incumbent as far as it goes."""
    x = y = ""
    while edits is not None and (edits.count > len(line) or line[edits.count - 1] is not edits):
        x, y = edits.what, line[edits.count - 1].what if edits.count <= len(line) else ""
        edits = edits.before
    return x > y != ""


def repair(rows: list[tuple[str, bool, bool, int]]) -> tuple[int, str, list[tuple[int, str, str]]]:
    """Cost, edits and what becomes of the rows (initial, must go, truncated, copies; all copies but
    the first must go too).  The last has, for each row (and the end) with anything to say, its number,
    the initials of the roles inserted before it, and that of the role it stays with (empty: none)."""
    free = [k for k, (_, gone, _, _) in enumerate(rows) if not gone]
    cost, edits = cheapest("".join(rows[k][0] for k in free), [rows[k][2] for k in free])
    out, said, state = [], [], START
    marks = iter(edits + "$")
    mark = next(marks)
    for k, (initial, gone, _, copies) in enumerate([*rows, ("", False, False, 1)]):
        if gone:
            said.append("D" * copies)
            cost += DELETE * copies
            continue
        before, stays = "", ""
        while mark == "I":
            before += (role := FOLLOWS[state][-1])
            state = STATE[role]
            said.append("I")
            mark = next(marks)
        if k < len(rows):
            stays = {"K": initial, "R": FOLLOWS[state][-1], "D": ""}[mark]
            state = STATE.get(stays, state)
            said.append(mark + "D" * (copies - 1))
            cost += DELETE * (copies - 1)
            kept, mark = mark, next(marks)
            if before or stays:
                out.append((k, before, "=" if kept == "K" else stays))
        elif before:
            out.append((k, before, ""))
    return cost, "".join(said), out


# ---- damage, as a test of the repair

def _said(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Rows damaged by crc32 of ``conversation:turn`` modulo 20: 0 drops a row, 1 empties its text, 2
    takes its sentence ends, 3 repeats it (``copies`` 2), 4 makes it the user's."""
    kind = F.crc32(F.concat(_said(F.col(conv_col)), F.lit(":"), _said(F.col(turn_col)))) % 20
    text, role = _said(F.col(text_col)), _said(F.col(role_col))
    own = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
                       kind.alias("kind")).where("kind != 0")
    return own.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


# ---- the repair as a job

def _key(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


FACTS = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
PLAN_SCHEMA = f"key string, at long, before string, role string, {FACTS}"
PLAN_ARROW = pa.schema([("key", pa.string()), ("at", pa.int64()), ("before", pa.string()), ("role", pa.string())]
                       + [(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in FACTS.split(", ")])


def _facts(key: str, ats: list[int], turns: list, initials: list[str], kinds: list[str], copies: list[int]) -> list[tuple]:
    """Rows of the plan of one conversation."""
    count = {k: sum(n for x, n in zip(kinds, copies) if x == k) for k in "bdt"}
    again = sum(n - 1 for x, n in zip(kinds, copies) if x in "ot")
    cut = sum(x == "t" for x in kinds)
    known = [t for t in turns if t is not None]
    gaps = known[-1] - known[0] + 1 - len(set(known)) if known else 0
    illegal = sum(n - 1 for n in copies) + sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, done = repair([(i, k in "bd", k == "t", n) for i, k, n in zip(initials, kinds, copies)])
    rows = [(key, ats[k] if k < len(ats) else ats[-1] + 1, before, "" if role == "=" else role and ROLE[role]) + (None,) * 7
            if role else (key, ats[k] if k < len(ats) else ats[-1] + 1, before, None) + (None,) * 7 for k, before, role in done]
    return rows + [(key, None, None, None, gaps, count["b"], count["d"] + again, cut, illegal, cost, audit)]


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (key, at) to plans; a conversation may span batches."""
    key, held = None, ([], [], [], [], [])
    out: list[tuple] = []
    for batch in batches:
        for k, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key:
                if held[0]:
                    out += _facts(key, *held)
                key, held = k, ([], [], [], [], [])
                if len(out) > 10_000:
                    yield _batch(out, PLAN_ARROW)
                    out = []
            for column, value in zip(held, row):
                column.append(value)
    if held[0]:
        out += _facts(key, *held)
    if out:
        yield _batch(out, PLAN_ARROW)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


HASH_ARROW = pa.schema([("key", pa.string()), ("repaired_sha256", pa.string())])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in order of (key, at) to one hash for each key, line by line."""
    key, state = None, None
    for batch in batches:
        out = []
        for k, lines in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                if state is not None:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(lines.encode())
            else:
                state.update(b"\n")
                state.update(lines.encode())
        if out:
            yield _batch(out, HASH_ARROW)
    if state is not None:
        yield _batch([(key, state.hexdigest())], HASH_ARROW)


def _in_order(rows: DataFrame) -> DataFrame:
    """Each conversation in one partition, its rows in order."""
    return rows.repartition("key").sortWithinPartitions("key", "at")


def plans(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered rows (key, at, turn, role, text) of conversations, and the plan: for each conversation
    one row of facts (``at`` null), for each row that stays or has turns inserted before it one row
    with the inserted initials and its role (empty: its own; null: it goes)."""
    own = turns.withColumn("key", _key(F.col("conv_id"))) \
        .groupBy("key", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    order = Window.partitionBy("key").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = cut_lineage(own.withColumn("at", F.row_number().over(order).cast("long") - 1)
                       .withColumn("digest", F.sha2("text", 256)))
    first = rows.groupBy("key", "role", "digest").agg(F.min("at").alias("first"))
    mark = "[^\\x20\\x09-\\x0D]"
    initial = F.substring("role", 1, 1)
    kinds = rows.join(first, ["key", "role", "digest"]).select(
        "key", "at", "turn", F.when(initial.isin(*STATE), initial).otherwise("x").alias("initial"),
        F.when(~F.col("text").rlike(mark), "b").when(F.col("at") > F.col("first"), "d")
        .when(~F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z"), "t").otherwise("o").alias("kind"), "copies")
    return rows, cut_lineage(_in_order(kinds).mapInArrow(_plans, PLAN_SCHEMA))


def repaired(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The repaired conversations: key, at, inserted (roles of empty turns before it), role (null: only
    the inserted turns) and text."""
    edits = plan.where("at is not null").select("key", "at", "before", F.col("role").alias("new"))
    inserted = F.transform(F.filter(F.split("before", ""), lambda c: c != ""),
                           lambda c: F.when(c == "u", F.lit(ROLE["u"])).otherwise(F.lit(ROLE["a"])))
    return edits.join(rows.select("key", "at", "role", "text"), ["key", "at"], "left").select(
        "key", "at", inserted.alias("inserted"),
        F.when(F.col("new") == "", F.col("role")).otherwise(F.col("new")).alias("role"),
        F.when(F.col("new").isNotNull(), F.col("text")).alias("text"))


def digest(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Each conversation damaged, repaired and described: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit and the hash of its repaired ``role:text`` lines."""
    rows, plan = plans(damage(conversations, conv_col, turn_col, role_col, text_col))
    lines = repaired(rows, plan).select("key", "at", F.array_join(F.concat(
        F.transform("inserted", lambda r: F.concat(r, F.lit(":"))),
        F.when(F.col("role").isNull(), F.array().cast("array<string>"))
        .otherwise(F.array(F.concat("role", F.lit(":"), "text")))), "\n").alias("lines"))
    hashes = _in_order(lines).select("key", "lines").mapInArrow(_hashes, "key string, repaired_sha256 string")
    names = [c.split()[0] for c in FACTS.split(", ")]
    every = conversations.select(F.col(conv_col).alias("conv_id")).distinct().withColumn("key", _key(F.col("conv_id")))
    zero = [F.coalesce(c, F.lit("" if c == "audit" else 0)).alias(c) for c in names]
    return every.join(plan.where("at is null").select("key", *names), "key", "left").join(hashes, "key", "left").select(
        "conv_id", *zero, F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))

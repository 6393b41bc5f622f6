"""Operator 6 [native]: sharding by a hierarchical weighted hash tree (law ``key``).

Shards are leaves of a tree of regions and racks; a subtree weighs the sum of its shards.
A row descends from the root: at each level every child draws an exponential from the
hash of (id, child), divided by the child's weight, and the smallest wins.  A draw depends
on that child alone, so a weight that grows only draws rows into its own subtree, and one
that shrinks only sends rows out of it.  A shard that is added stands as a region of its
own: no other weight changes, and all rows that move move into it.

A slot is the row's rank in its shard.  Ranks are taken in buckets of a shard, which tasks
share out, and added to the rows of the buckets before; so no shard is sorted as a whole.
The draws are written before they are counted, so both readings see the same rows.

A null id is one id like any other; rows with one id go to one shard and get a slot each
(a hot id is dealt over buckets by its text).  Null texts have no bytes.  An empty table
gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rateweave.session import cut_lineage

SHARDS = 24
RACKS_IN_REGION = 3
SHARDS_IN_RACK = 4
ROW_BYTES = 8


class Leaf(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def layout(shards: int = SHARDS, added: int = 0, weights: dict[int, float] | None = None) -> list[Leaf]:
    """``shards`` leaves in racks and regions, and ``added`` ones that are a region each."""
    w = weights or {}
    region = RACKS_IN_REGION * SHARDS_IN_RACK
    out = [Leaf(s // region, s // SHARDS_IN_RACK % RACKS_IN_REGION, s, w.get(s, 1.0)) for s in range(shards)]
    first = -(-shards // region)
    return out + [Leaf(first + k, 0, shards + k, w.get(shards + k, 1.0)) for k in range(added)]


def _draw(key: Column, children: list[tuple[str, float]]) -> Column:
    """The number of the child with the smallest weighted exponential draw; ties to the first."""
    if len(children) == 1:
        return F.lit(0)
    scores = []
    for i, (name, weight) in enumerate(children):
        uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11).cast("double") + 0.5) / float(1 << 53)
        scores.append(F.struct((-F.log(uniform) / F.lit(weight)).alias("e"), F.lit(i).alias("i")))
    return F.least(*scores)["i"]


def _choose(number: Column, options: list[Column]) -> Column:
    out = options[-1]
    for i in range(len(options) - 2, -1, -1):
        out = F.when(number == i, options[i]).otherwise(out)
    return out


def descend(df: DataFrame, key: str, leaves: list[Leaf], out: str) -> DataFrame:
    """``df`` with the shard of every row: one draw among regions, one among racks, one among shards."""
    tree: dict[int, dict[int, list[Leaf]]] = {}
    for leaf in leaves:
        tree.setdefault(leaf.region, {}).setdefault(leaf.rack, []).append(leaf)
    weight = lambda xs: sum(x.weight for x in xs)
    k = F.col(key)
    regions = list(tree)
    df = df.withColumn("_region", _draw(k, [(f"region {r}", sum(map(weight, tree[r].values()))) for r in regions]))
    df = df.withColumn("_rack", _choose(F.col("_region"), [_draw(k, [(f"rack {r}.{q}", weight(tree[r][q])) for q in tree[r]])
                                                          for r in regions]))
    shards = []
    for r in regions:
        racks = [_choose(_draw(k, [(f"shard {x.shard}", x.weight) for x in xs]), [F.lit(x.shard) for x in xs])
                 for xs in tree[r].values()]
        shards.append(_choose(F.col("_rack"), racks))
    return df.withColumn(out, _choose(F.col("_region"), shards)).drop("_region", "_rack")


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row for each document: doc_id, size, text_crc32, law, shard, slot and grown_shard, its
    shard when one more is added."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
                      F.crc32(text.cast("binary")).alias("text_crc32"),
                      F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("_key"))
    own = descend(descend(own, "_key", layout(shards), "shard"), "_key", layout(shards, 1), "grown_shard")
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    drawn = cut_lineage(own.withColumn("bucket", F.pmod(F.xxhash64("_key", "text_crc32", "size"), F.lit(buckets)).cast("int")))
    counts = drawn.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "bucket", (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket"))
                                               - F.col("n")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("_key", "text_crc32", "size")) - 1
    return drawn.withColumn("own", rank).join(before, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("before") + F.col("own")).cast("long").alias("slot"), "grown_shard")

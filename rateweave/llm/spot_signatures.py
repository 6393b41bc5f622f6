"""Operator 9 [native]: SpotSigs document fingerprints.

Common words are anchors.  A signature is an anchor with the chain of the next content
words (up to ``CHAIN``; anchors between them are passed over, at most ``SKIP`` at a time).
A fingerprint is the sorted set of a text's signatures, as 32-bit hashes in one string.
A text without a signature has one, of its whole letters and digits, so that equal texts
have equal fingerprints and others don't meet.

Likeness is the Jaccard similarity of two fingerprints, not computed where their lengths
alone rule it out.  Equal fingerprints are a class.  ``similar_sets`` partitions the classes by
their length such that similar ones are in one partition or in neighbouring ones, joins them
there by the rarest of their signatures, and prunes by length and place before it compares.
``similar_counts`` gives each set's number of similar ones and makes no pairs for most of them:
sets of a group are compared with the group's common signatures, and their differences decide.

Null texts count as empty.  Rows with one doc_id are separate documents, in the order of
their texts' hashes; null ids stand last, and a class of null ids alone has a null class_id.
Columns of other names are not read, so they can't clash.  A text of any length is one row.
An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rateweave.operators.joins import attach_stats
from rateweave.session import cut_lineage

#: Fixed word list: common words of four languages.
ANCHORS = """a an the of and to in is was are be been on at by for with from this that it as or not
der die das und ist ein eine von zu mit den im auf sich des dem nicht
le la les de des du un une et est dans que pour sur en au par
el los las una y es en del que por con para se no al""".split()
CHAIN = 3
SKIP = 8
#: One of so many signatures is counted; the others stand behind the counted ones.
COUNTED = 3
#: Lists of more sets are cut.
LIST_SETS = 1000

_MARK = "\u0001"
_NEXT = "\u0002"


def _words(text: Column) -> Column:
    """Lower-case words with one space before each and one at the end, anchors marked."""
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", " ")), F.lit(" "))
    anchors = "|".join(sorted(set(ANCHORS)))
    return F.regexp_replace(plain, f" (?=(?:{anchors}) )", f" {_MARK}")


def signatures(marked: Column) -> Column:
    """Anchors with their chains, from marked words."""
    chain = f"(?=({_MARK}[^ ]++(?:(?: {_MARK}[^ ]++){{0,{SKIP}}}+ [^{_MARK} ][^ ]*+){{1,{CHAIN}}})){_MARK}"
    found = F.regexp_extract_all(marked, F.lit(chain), F.lit(1))
    joined = F.regexp_replace(F.array_join(found, _NEXT), f" {_MARK}[^ {_NEXT}]+", "")
    return F.when(F.size(found) > 0, F.split(joined, _NEXT))


def _hash(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(F.pmod(F.xxhash64(value), F.lit(1 << 32)))), 8, "0")


def with_fingerprint(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with the fingerprint of a text column."""
    marked = df.withColumn("_marked", _words(F.coalesce(F.col(text_col), F.lit(""))))
    found = marked.withColumn("_signatures", signatures(F.col("_marked")))
    own = F.when(F.col("_signatures").isNull(), _hash(F.concat(F.lit("whole"), F.col("_marked")))).otherwise(
        F.array_join(F.array_sort(F.array_distinct(F.transform("_signatures", _hash))), " "))
    return found.withColumn(out, own).drop("_marked", "_signatures")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two fingerprints; 0 without a comparison where lengths rule out ``least``."""
    x, y = F.split(a, " "), F.split(b, " ")
    common = F.size(F.array_intersect(x, y))
    full = common / (F.size(x) + F.size(y) - common)
    small = F.least(F.length(a), F.length(b)) + 1
    return F.when(a == b, F.lit(1.0)).when(
        small / (F.greatest(F.length(a), F.length(b)) + 1) < least, F.lit(0.0)).otherwise(full)


def _shares(spark: SparkSession) -> int:
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _part_of(bounds: list[int], value: Column) -> Column:
    """How many of the sorted bounds are below a value, by a coarse and a fine look."""
    step = max(1, math.isqrt(len(bounds)))
    fine = [bounds[i: i + step] for i in range(0, len(bounds), step)] or [[]]
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs]).cast("array<bigint>")
    coarse = F.greatest(F.size(F.filter(longs([f[0] for f in fine if f]), lambda b: b < value)) - 1, F.lit(0))
    own = F.element_at(F.array(*[longs(f) for f in fine]), coarse + 1)
    return (coarse * step + F.size(F.filter(own, lambda b: b < value))).cast("int")


def with_next(docs: DataFrame, columns: list[str], id_col: str = "doc_id", tie: str = "_tie",
              arrived: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``docs`` with ``next_<column>`` of the next row in descending order of the id; the first
    row's after the last.  ``arrived`` may add columns after the rows have moved.

    Ranges of the id, cut at its quantiles, are ordered one by one.  The first row of each
    range is also sent, by its id, to the end of the range before it, so nothing is sorted
    as a whole and no text is joined."""
    spark = docs.sparkSession
    n = _shares(spark)
    asked = [k / n for k in range(1, n)]
    found = docs.select(F.percentile_approx(id_col, asked, 10_000).alias("b")).first()["b"] or []
    # Null ids come last in descending order: they are below all others.
    low = F.lit(-(1 << 63)).cast("long")
    key = F.coalesce(F.col(id_col).cast("long"), low)
    part = _part_of(sorted(set(found)), key)
    tops = {r["part"]: r["top"] for r in docs.select(part.alias("part"), key.alias("key"))
            .groupBy("part").agg(F.max("key").alias("top")).collect()}     # a row for each range
    order = sorted(tops, reverse=True)
    before = {p: order[i - 1] for i, p in enumerate(order)}               # the first range follows the last
    at = lambda d, kind: F.element_at(F.array(*[F.lit(d.get(p)).cast(kind) for p in range(max(order, default=0) + 1)]),
                                      F.col("_part") + 1)
    own = docs.withColumn("_part", part).withColumn("_key", key)
    own = own.withColumn("_to", F.when(F.col("_key") == at(tops, "long"), F.array(
        F.struct(F.col("_part").alias("p"), F.lit(0).alias("ghost")),
        F.struct(at(before, "int").alias("p"), F.lit(1).alias("ghost"))))
        .otherwise(F.array(F.struct(F.col("_part").alias("p"), F.lit(0).alias("ghost")))))
    sent = own.withColumn("_at", F.explode("_to")).withColumn("_p", F.col("_at.p")).withColumn("_ghost", F.col("_at.ghost"))
    window = Window.partitionBy("_p").orderBy("_ghost", F.col("_key").desc(), tie)
    sent = arrived(sent.repartition("_p"))
    return sent.withColumns({f"next_{c}": F.lead(c).over(window) for c in columns}) \
        .where("_ghost = 0").drop("_part", "_key", "_to", "_at", "_p", "_ghost")


def _print(fingerprint: Column) -> Column:
    """128 bits that stand for a fingerprint in joins."""
    return F.unhex(F.md5(fingerprint))


def _signs(fingerprint: Column) -> Column:
    """The signatures of a fingerprint as sorted integers."""
    return F.transform(F.split(fingerprint, " "),
                       lambda x: (F.conv(x, 16, 10).cast("long") - F.lit(1 << 31)).cast("int"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next.  The edited text ends, for the last half of its code points, with
    as many from the start of the next document (or all it has)."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # Texts move alone: fingerprints are made where they arrive.
    moved = with_next(own.withColumn("_tie", F.xxhash64("text")), ["text", "fingerprint"],
                      arrived=lambda df: with_fingerprint(df, "text", "fingerprint"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    moved = moved.select("doc_id", n.cast("long").alias("n_chars"), "fingerprint", "next_fingerprint",
                         F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                                  F.substring(F.col("next_text"), F.lit(1), half)).alias("edited"))
    out = with_fingerprint(moved, "edited", "edited_fingerprint")
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), "fingerprint",
                      "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                      likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def document_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row for each document: doc_id, fingerprint, class_id (the smallest doc_id of equal fingerprints)
    and n_similar (other classes of likeness ``threshold`` or more)."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    prints = cut_lineage(with_fingerprint(own, "text", "fingerprint").select("doc_id", "fingerprint"))
    links = class_links(prints, threshold)
    # Four bytes for a signature travel, and by a merge at every size.
    moved = prints.select("doc_id", _print(F.col("fingerprint")).alias("print"),
                          F.unhex(F.replace(F.col("fingerprint"), F.lit(" "), F.lit(""))).alias("packed"))
    return moved.join(links.hint("merge"), "print", "left").select(
        "doc_id", F.regexp_replace(F.lower(F.hex("packed")), "(.{8})(?=.)", "$1 ").alias("fingerprint"),
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_similar", F.lit(0).cast("long")).alias("n_similar"))


def class_links(prints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(print, class_id, n, n_similar) of the classes of several documents and of those that other
    classes are similar to; all others have one document and no similar class."""
    own = prints.select("doc_id", _print(F.col("fingerprint")).alias("print"), _signs(F.col("fingerprint")).alias("signs"))
    # A class that holds null ids alone has no smallest id, so classes are joined by numbers.
    named = cut_lineage(own.groupBy("print", "signs").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n"))
                        .withColumn("node", F.monotonically_increasing_id()))
    counts = similar_counts(named.select("node", "signs"), threshold)
    return cut_lineage(named.drop("signs").join(counts, "node", "left").where("n > 1 or n_similar is not null")
                       .select("print", "class_id", "n", "n_similar"))


def classes(fingerprints: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(fingerprint, class_id) of equal fingerprints; class_id is the smallest doc_id."""
    return fingerprints.groupBy("fingerprint").agg(F.min(id_col).alias("class_id"))


def similar_classes(named: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(a, b, likeness) for every two classes of likeness ``threshold`` or more, a < b, without null ids."""
    return similar_sets(cut_lineage(named.where("class_id is not null").select(
        F.col("class_id").alias("node"), _signs(F.col("fingerprint")).alias("signs"))), threshold)


def _counted(sign: Column) -> Column:
    return F.pmod(sign, F.lit(COUNTED)) == 0


def _listed(sets: DataFrame, threshold: float) -> DataFrame:
    """(node, signs, size, alone, prefix, c) of the sets of a written table that may be similar to others:
    the signatures of the first places that other sets may have, after ``alone`` ones that none has, and
    the length partition."""
    size = F.size("signs")
    first = (size - F.ceil(size * F.lit(threshold) - 1e-9) + 1).cast("int")
    sized = sets.withColumns({"size": size, "first": first,
                              "n_counted": F.size(F.filter("signs", _counted))})
    counted = sized.select("node", "first", "n_counted", F.explode(F.filter("signs", _counted)).alias("sign"))
    often = sets.select(F.explode(F.filter("signs", _counted)).alias("sign")).groupBy("sign") \
        .agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = cut_lineage(counted.join(often, "sign").groupBy("node", "first", "n_counted")
                         .agg(F.sort_array(F.collect_list(F.struct("n", "sign"))).alias("shared"))
                         .where("n_counted - size(shared) < first")
                         .select("node", F.transform("shared", lambda x: x["sign"]).alias("shared")))
    left = sized.join(shared, "node", "left").where("shared is not null or n_counted < first") \
        .withColumn("shared", F.coalesce("shared", F.array().cast("array<int>"))) \
        .withColumn("alone", F.col("n_counted") - F.size("shared"))
    order = F.concat("shared", F.filter("signs", lambda s: ~_counted(s)))
    return cut_lineage(left.select("node", "signs", "size", "alone", F.slice(order, 1, F.col("first") - F.col("alone"))
                                   .alias("prefix"),
                                   F.floor(F.log(size.cast("double")) / F.lit(-math.log(threshold)) + 1e-9).cast("int").alias("c")))


def similar_sets(sets: DataFrame, threshold: float = 0.8, list_sets: int = LIST_SETS) -> DataFrame:
    """(a, b, likeness) for every two sets of a written table (node, signs) of likeness ``threshold`` or
    more, a < b.

    Signatures stand in one order for all sets: counted ones from rare to frequent, then the others.
    Similar sets share one of their first, as many as they can't all differ in; signatures of a single
    set join nothing there, and a set that fills its first places with them goes no further.  The rest
    are listed by signature and length partition, such that similar lengths share a partition.  In a
    list, lengths and places prune two sets before they are compared; they are taken at the first
    signature that both lists know and in the partition of the longer.  A list of over ``list_sets``
    sets is cut into slices, each joined with the list by a group of its own."""
    left = _listed(sets, threshold)
    places = left.select("node", "size", "alone", "prefix", "c", F.posexplode("prefix").alias("at", "sign")) \
        .withColumn("part", F.explode(F.array(F.col("c"), F.col("c") + 1)))
    entries = places.select("sign", "part", "node", "size", "c", (F.col("alone") + F.col("at")).alias("place"), "prefix")
    lists = entries.groupBy("sign", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1") \
        .select("sign", "part", F.ceil(F.col("n") / list_sets).cast("int").alias("slices"))
    entries = cut_lineage(entries.join(lists, ["sign", "part"]))
    side = lambda s, of: of.select("sign", "part", "slice", *[F.col(c).alias(f"{c}_{s}")
                                                             for c in ("node", "size", "c", "place", "prefix")])
    a = side("a", entries.withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")))
    b = side("b", entries.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))))
    least = F.ceil((F.col("size_a") + F.col("size_b")) * F.lit(threshold / (1 + threshold)) - 1e-9)
    pairs = a.join(b, ["sign", "part", "slice"]).where("node_a < node_b").where(
        F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * threshold - 1e-9).where(
        F.col("part") == F.greatest("c_a", "c_b")).where(
        F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b")) >= least).where(
        F.element_at(F.array_intersect("prefix_a", "prefix_b"), 1) == F.col("sign")).select(
        F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    common = F.size(F.array_intersect("sa", "sb"))
    near = common / (F.size("sa") + F.size("sb") - common)
    return pairs.join(left.select(F.col("node").alias("a"), F.col("signs").alias("sa")), "a") \
        .join(left.select(F.col("node").alias("b"), F.col("signs").alias("sb")), "b") \
        .select("a", "b", near.alias("likeness")).where(F.col("likeness") >= threshold)


#: Shares of likeness in whole numbers, so that sums decide exactly.
MILLION = 10 ** 6


def similar_counts(sets: DataFrame, threshold: float = 0.8, list_sets: int = LIST_SETS) -> DataFrame:
    """(node, n_similar) of the sets of a written table (node, signs) that others are similar to.

    Lists of signatures are made as in ``similar_sets``.  Each set joins the group of the first set of
    most of its lists.  The signatures that over half of a group has are what the group has in common; a
    set of too little likeness with them stays alone.  Two sets of a group share what is common but for
    what either lacks, and more only if their differences meet.  So ``_inside`` counts most links from a
    histogram, and joins only those two that need a common difference.  ``_across`` joins the lists for
    sets of two groups: the sets outside a list's largest group with the whole list."""
    t = round(threshold * MILLION)
    left = _listed(sets, threshold)
    places = left.select("node", "size", "alone", "c", F.posexplode("prefix").alias("at", "sign")) \
        .withColumn("part", F.explode(F.array(F.col("c"), F.col("c") + 1)))
    entries = places.select("sign", "part", "node", "size", "c", (F.col("alone") + F.col("at")).alias("place"))
    lists = entries.groupBy("sign", "part").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("lead")).where("n > 1")
    entries = cut_lineage(entries.join(lists, ["sign", "part"]))
    votes = entries.groupBy("node", "lead").agg(F.count(F.lit(1)).alias("n")).groupBy("node") \
        .agg(F.max_by("lead", F.struct("n", -F.col("lead"))).alias("g"))
    voted = cut_lineage(left.select("node", "signs", "size").join(votes, "node"))
    groups = voted.groupBy("g").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    common = attach_stats(voted.select("g", F.explode("signs").alias("sign")).groupBy("g", "sign")
                          .agg(F.count(F.lit(1)).alias("n")), groups, "g", how="inner") \
        .where("2 * n > members").groupBy("g").agg(F.collect_list("sign").alias("common"))
    lacks = F.array_except("common", "signs")
    more = F.array_except("signs", "common")
    shared = F.col("size") - F.size(more)
    held = attach_stats(voted, common, "g").withColumns({
        "near": shared / (F.size("common") + F.size(more)), "differ": F.array_sort(F.concat(lacks, more)),
        "score": ((F.size("common") - 2 * F.size(lacks)).cast("long") * (MILLION + t) - F.col("size").cast("long") * (2 * t))})
    close = F.coalesce(F.col("near") >= max(0.0, 2 * threshold - 1), F.lit(False))
    held = cut_lineage(held.select("node", F.when(close, F.col("g")).otherwise(-1 - F.col("node")).alias("g"),
                                   F.when(close, F.col("differ")).alias("differ"),
                                   F.when(close, F.col("score")).alias("score")))
    both = F.explode(F.array("a", "b")).alias("node")
    sure, more_links = _inside(held.where("score is not null"), t, list_sets)
    across = _across(left, entries.drop("lead").join(held.select("node", "g"), "node"), threshold, list_sets)
    one = F.lit(1).cast("long").alias("n")
    return sure.unionByName(more_links.select(both, one)).unionByName(across.select(both, one)) \
        .groupBy("node").agg(F.sum("n").alias("n_similar")).where("n_similar > 0")


def _inside(held: DataFrame, t: int, list_sets: int) -> tuple[DataFrame, DataFrame]:
    """Links within groups: (node, n) of those that scores alone prove, and pairs (a, b) of the others.

    The scores of two sets add up to 0 or more if they are similar even when their differences don't
    meet; each common difference adds twice a million and ``t``.  Counts come from a histogram of scores,
    of one row for each score of a group.  The others meet at their first common difference."""
    unit = F.lit(2 * (MILLION + t)).cast("long")
    bars = cut_lineage(held.groupBy("g", "score").agg(F.count(F.lit(1)).alias("n")))
    asked = bars.select("g", F.col("score").alias("key"), "n", F.lit(None).cast("long").alias("score")).unionByName(
        bars.select("g", (-F.col("score")).alias("key"), F.lit(0).cast("long").alias("n"), "score"))
    above = asked.withColumn("upto", F.sum("n").over(Window.partitionBy("g").orderBy(F.col("key").desc()))) \
        .where("score is not null").select("g", "score", (F.col("upto") - F.when(F.col("score") >= 0, 1).otherwise(0)).alias("n"))
    sure = attach_stats(held.select("node", "g", "score"), above, ["g", "score"], how="inner").select("node", "n")
    ends = bars.groupBy("g").agg(F.min("score").alias("low"), F.max("score").alias("high"))
    open_ = attach_stats(held, ends, "g", how="inner").where("score + low < 0") \
        .withColumn("n", F.size("differ")) \
        .withColumn("least", F.greatest(F.lit(1), F.ceil(-(F.col("score") + F.col("high")) / unit)))
    spots = open_.select("g", "node", "score", "n", "least", "differ", F.posexplode("differ").alias("at", "d")) \
        .where("at <= n - least")
    often = spots.groupBy("g", "d").agg(F.count(F.lit(1)).alias("times")).where("times > 1") \
        .select("g", "d", F.ceil(F.col("times") / list_sets).cast("int").alias("slices"))
    spots = cut_lineage(spots.drop("least").join(often, ["g", "d"]))
    side = lambda s, of: of.select("g", "d", "slice", *[F.col(c).alias(f"{c}_{s}")
                                                        for c in ("node", "score", "n", "at", "differ")])
    a = side("a", spots.withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")))
    b = side("b", spots.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))))
    score = F.col("score_a") + F.col("score_b")
    meet = F.array_intersect("differ_a", "differ_b")
    pairs = a.join(b, ["g", "d", "slice"]).where("node_a < node_b").where(score < 0).where(
        score + F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) * unit >= 0).where(
        (F.element_at(meet, 1) == F.col("d")) & (score + F.size(meet) * unit >= 0))
    return sure, pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def _across(left: DataFrame, entries: DataFrame, threshold: float, list_sets: int) -> DataFrame:
    """Pairs (a, b) of similar sets of two groups.  In a list, one of them is outside the largest group,
    so a list of one group makes no pair, and one with few others makes few."""
    entries = cut_lineage(entries)
    sizes = entries.groupBy("sign", "part", "g").agg(F.count(F.lit(1)).alias("k"))
    tops = sizes.groupBy("sign", "part").agg(F.max_by("g", F.struct("k", "g")).alias("top"), F.count(F.lit(1)).alias("groups")) \
        .where("groups > 1").drop("groups")
    mixed = cut_lineage(entries.join(tops, ["sign", "part"])
                        .withColumn("slices", F.ceil(F.col("n") / list_sets).cast("int")))
    side = lambda s, of: of.select("sign", "part", "slice", *[F.col(c).alias(f"{c}_{s}")
                                                             for c in ("node", "size", "c", "place", "g")],
                                   *([F.col("top")] if s == "a" else []))
    a = side("a", mixed.withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")))
    b = side("b", mixed.where("g != top").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))))
    least = F.ceil((F.col("size_a") + F.col("size_b")) * F.lit(threshold / (1 + threshold)) - 1e-9)
    pairs = a.join(b, ["sign", "part", "slice"]).where("g_a != g_b and (g_a = top or node_a < node_b)").where(
        F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * threshold - 1e-9).where(
        F.col("part") == F.greatest("c_a", "c_b")).where(
        F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b")) >= least).select(
        F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()
    both = F.size(F.array_intersect("sa", "sb"))
    t = round(threshold * MILLION)
    return pairs.join(left.select(F.col("node").alias("a"), F.col("signs").alias("sa")), "a") \
        .join(left.select(F.col("node").alias("b"), F.col("signs").alias("sb")), "b") \
        .where(both.cast("long") * (MILLION + t) >= (F.size("sa") + F.size("sb")).cast("long") * t).select("a", "b")

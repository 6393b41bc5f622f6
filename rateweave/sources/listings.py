"""Listing table derived from the driver's TPC-H-style tables (test adapter).

One listing per ``part``; review/availability signals come from that part's
``lineitem`` rows.  The lineitem side is reduced with a partial (map-side)
aggregation before any shuffle, so a part holding a third of all lines costs
one row per map task, not a third of the data in one reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateweave.session import cut_lineage
from rateweave.sources.io import read_table

# Fixed mapping of part type to room type (the adapter's definition).
ROOM_TYPE_BY_PART_TYPE = {
    "LARGE": "Entire home/apt",
    "MEDIUM": "Private room",
    "STANDARD": "Private room",
    "ECONOMY": "Shared room",
    "SMALL": "Shared room",
    "PROMO": "Hotel room",
}

# Fixed text values for the cancellation policy, by p_partkey % 4 (3 -> NULL).
CANCELLATION_BY_MOD4 = [" Strict ", "moderate", "Flexible"]

# Months spanned by the ship dates; converts a line count into a monthly rate.
MONTHS_OF_HISTORY = 82


def _null_when(key, modulus: int, value):
    return F.when(key % modulus == 0, F.lit(None)).otherwise(value)


def listings_from_parts(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    lines = (
        lineitem.groupBy("l_partkey")
        .agg(
            F.min("l_suppkey").alias("host_id"),
            F.count("l_orderkey").alias("n_lines"),
            F.sum("l_quantity").alias("qty"),
        )
    )
    key = F.col("p_partkey")
    price = F.col("p_retailprice") * F.col("p_size") / F.lit(100.0)
    room = F.lit(None).cast("string")
    for ptype, rtype in ROOM_TYPE_BY_PART_TYPE.items():
        room = F.when(F.col("p_type") == ptype, rtype).otherwise(room)
    policy = F.lit(None).cast("string")
    for i, txt in enumerate(CANCELLATION_BY_MOD4):
        policy = F.when(key % 4 == i, txt).otherwise(policy)
    n_lines = F.coalesce(F.col("n_lines"), F.lit(0))

    base = part.join(lines, part.p_partkey == lines.l_partkey, "left").select(
        key.alias("listing_id"),
        F.col("host_id"),
        price.alias("price"),
        _null_when(key, 11, price * F.lit(0.2)).alias("service_fee"),
        room.alias("room_type"),
        _null_when(key, 19, F.col("p_brand")).alias("neighbourhood_group"),
        (key % 30).cast("double").alias("minimum_nights"),
        n_lines.cast("double").alias("number_of_reviews"),
        _null_when(key, 7, n_lines.cast("double") / F.lit(float(MONTHS_OF_HISTORY))).alias("reviews_per_month"),
        _null_when(key, 23, (F.col("qty").cast("bigint") % 367).cast("double")).alias("availability_365"),
        _null_when(key, 17, (F.lit(1) + key % 5).cast("double")).alias("review_rate_number"),
        _null_when(key, 13, key % 2 == 0).alias("instant_bookable"),
        policy.alias("cancellation_policy"),
        F.concat(F.lit("$"), F.floor("p_retailprice").cast("bigint").cast("string")).alias("raw_price"),
        F.col("p_brand").alias("_brand"),
        F.col("p_type").alias("_ptype"),
    )
    # Competitor reference: mean price of parts sharing brand and type.  It needs
    # only ``part``; the grouped aggregate (one row per brand × type) is counted
    # and broadcast when small, so the listing side is not shuffled for it.
    # The join is left to the optimizer (equi-join on the key, skew split at run time), so that it
    # and the aggregate vanish from plans that don't read the column.
    comp = (part.groupBy(F.col("p_brand").alias("_brand"), F.col("p_type").alias("_ptype"))
                .agg(F.avg(price).alias("competitor_avg_price")))
    return base.join(comp, ["_brand", "_ptype"], "left").drop("_brand", "_ptype")


def load_listings(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    """The listing table.  A job that reads it several times (fitted statistics, group bands,
    the main pass) takes it written once to the shared checkpoint directory; with
    ``materialize=False`` it is lazy, and only the columns that are asked for are read."""
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_orderkey", "l_quantity")
    out = listings_from_parts(part, lineitem)
    return cut_lineage(out) if materialize else out


# The same listing derivation in ANSI SQL (DuckDB dialect), used as the head
# CTE of every oracle query.
LISTINGS_SQL = """
li AS (
  SELECT l_partkey, min(l_suppkey) AS host_id, count(l_orderkey) AS n_lines,
         sum(l_quantity) AS qty
  FROM lineitem GROUP BY l_partkey
),
lb AS (
  SELECT p.p_partkey AS listing_id,
         li.host_id AS host_id,
         p.p_retailprice * p.p_size / CAST(100 AS DOUBLE) AS price,
         CASE WHEN p.p_partkey % 11 = 0 THEN NULL
              ELSE p.p_retailprice * p.p_size / CAST(100 AS DOUBLE) * CAST(0.2 AS DOUBLE) END AS service_fee,
         CASE p.p_type WHEN 'LARGE' THEN 'Entire home/apt'
                       WHEN 'MEDIUM' THEN 'Private room' WHEN 'STANDARD' THEN 'Private room'
                       WHEN 'ECONOMY' THEN 'Shared room' WHEN 'SMALL' THEN 'Shared room'
                       WHEN 'PROMO' THEN 'Hotel room' END AS room_type,
         CASE WHEN p.p_partkey % 19 = 0 THEN NULL ELSE p.p_brand END AS neighbourhood_group,
         CAST(p.p_partkey % 30 AS DOUBLE) AS minimum_nights,
         CAST(coalesce(li.n_lines, 0) AS DOUBLE) AS number_of_reviews,
         CASE WHEN p.p_partkey % 7 = 0 THEN NULL
              ELSE CAST(coalesce(li.n_lines, 0) AS DOUBLE) / CAST(82 AS DOUBLE) END AS reviews_per_month,
         CASE WHEN p.p_partkey % 23 = 0 THEN NULL
              ELSE CAST(CAST(li.qty AS BIGINT) % 367 AS DOUBLE) END AS availability_365,
         CASE WHEN p.p_partkey % 17 = 0 THEN NULL ELSE CAST(1 + p.p_partkey % 5 AS DOUBLE) END AS review_rate_number,
         CASE WHEN p.p_partkey % 13 = 0 THEN NULL ELSE p.p_partkey % 2 = 0 END AS instant_bookable,
         CASE p.p_partkey % 4 WHEN 0 THEN ' Strict ' WHEN 1 THEN 'moderate' WHEN 2 THEN 'Flexible' END AS cancellation_policy,
         '$' || CAST(CAST(floor(p.p_retailprice) AS BIGINT) AS VARCHAR) AS raw_price,
         p.p_brand AS _brand, p.p_type AS _ptype
  FROM part p LEFT JOIN li ON li.l_partkey = p.p_partkey
),
comp AS (SELECT _brand, _ptype, avg(price) AS competitor_avg_price FROM lb GROUP BY _brand, _ptype),
listings AS (
  SELECT lb.listing_id, lb.host_id, lb.price, lb.service_fee, lb.room_type, lb.neighbourhood_group,
         lb.minimum_nights, lb.number_of_reviews, lb.reviews_per_month, lb.availability_365,
         lb.review_rate_number, lb.instant_bookable, lb.cancellation_policy, lb.raw_price,
         comp.competitor_avg_price
  FROM lb LEFT JOIN comp ON comp._brand = lb._brand AND comp._ptype = lb._ptype
)
"""

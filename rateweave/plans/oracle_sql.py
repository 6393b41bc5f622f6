"""DuckDB oracle queries for the registered Spark queries.

Every query starts from the same listing derivation (``LISTINGS_SQL``) as the
Spark adapter.  Floating outputs are rounded on both sides with
``round_even(x * 1e6, 0) / 1e6 + 0`` (Spark: ``rint(x * 1e6) / 1e6 + 0``; the
``+ 0`` turns -0.0 into 0.0) so that
last-bit differences between the JVM's and C's ``pow``/``log`` do not decide the
comparison.  Doubles are always written as CAST(.. AS DOUBLE): a bare 0.5 is a
DECIMAL in both engines.
"""

from __future__ import annotations

from rateweave.sources.listings import LISTINGS_SQL


def D(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def R(expr: str, digits: int = 6) -> str:
    s = f"1e{digits}"
    return f"(round_even(({expr}) * {s}, 0) / {s} + CAST(0 AS DOUBLE))"


def with_listings(body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {LISTINGS_SQL.strip()}{extra}\n{body}"


# ------------------------------------------------------------------ shared CTEs

INFERENCE_INPUT = """inp AS (
  SELECT CAST(listing_id AS VARCHAR) AS listing_id,
         coalesce(price, CAST(0 AS DOUBLE)) AS price,
         coalesce(service_fee, CAST(0 AS DOUBLE)) AS service_fee,
         coalesce(room_type, 'Unknown') AS room_type,
         coalesce(neighbourhood_group, 'Unknown') AS neighbourhood_group,
         coalesce(availability_365, CAST(0 AS DOUBLE)) AS availability_365,
         coalesce(number_of_reviews, CAST(0 AS DOUBLE)) AS number_of_reviews,
         coalesce(reviews_per_month, CAST(0 AS DOUBLE)) AS reviews_per_month
  FROM listings)"""


def demand_cte(src: str, name: str = "scored") -> str:
    return f"""{name}_st AS (
  SELECT min(coalesce(reviews_per_month, {D(0)})) AS rpm_lo, max(coalesce(reviews_per_month, {D(0)})) AS rpm_hi,
         min(coalesce(number_of_reviews, {D(0)})) AS rev_lo, max(coalesce(number_of_reviews, {D(0)})) AS rev_hi
  FROM {src}),
{name} AS (
  SELECT s.*,
    {D(0.5)} * ((coalesce(s.reviews_per_month, {D(0)}) - st.rpm_lo) / (st.rpm_hi - st.rpm_lo + 1e-8))
    + {D(0.3)} * ((coalesce(s.number_of_reviews, {D(0)}) - st.rev_lo) / (st.rev_hi - st.rev_lo + 1e-8))
    + {D(0.2)} * ({D(1)} - coalesce(s.availability_365, {D(365)}) / {D(365)}) AS demand_score
  FROM {src} s, {name}_st st)"""


PRED = """pred AS (
  SELECT listing_id, price AS current_price, demand_score AS predicted_demand_before,
         price * demand_score AS predicted_revenue_before
  FROM scored)"""


def closed_form_ctes(src: str = "pred", n: int = 10, lo_f: float = 0.7, hi_f: float = 1.3,
                     e: float = -1.2) -> list[str]:
    return [
        f"""cand AS (
  SELECT p.listing_id, t.i AS i,
         CASE WHEN t.i = {n - 1} THEN p.current_price * {D(hi_f)}
              ELSE p.current_price * {D(lo_f)} + CAST(t.i AS DOUBLE)
                   * ((p.current_price * {D(hi_f)} - p.current_price * {D(lo_f)}) / {D(n - 1)}) END AS cp,
         p.current_price, p.predicted_demand_before AS base
  FROM {src} p CROSS JOIN range(0, {n}) t(i))""",
        f"""cand2 AS (
  SELECT listing_id, i, cp,
         CASE WHEN current_price = 0 THEN NULL
              WHEN base * pow(cp / current_price, {D(e)}) < 0 THEN {D(0)}
              ELSE base * pow(cp / current_price, {D(e)}) END AS dem
  FROM cand)""",
        """cand3 AS (
  SELECT listing_id, i, cp, dem, cp * dem AS rev,
         row_number() OVER (PARTITION BY listing_id ORDER BY cp * dem DESC NULLS LAST, i ASC) AS rk
  FROM cand2)""",
        f"""best AS (
  SELECT p.*,
         CASE WHEN c.rev IS NOT NULL AND p.predicted_revenue_before IS NOT NULL
                   AND c.rev > p.predicted_revenue_before THEN c.cp ELSE p.current_price END AS bp,
         CASE WHEN c.rev IS NOT NULL AND p.predicted_revenue_before IS NOT NULL
                   AND c.rev > p.predicted_revenue_before THEN c.dem ELSE p.predicted_demand_before END AS predicted_demand_after,
         CASE WHEN c.rev IS NOT NULL AND p.predicted_revenue_before IS NOT NULL
                   AND c.rev > p.predicted_revenue_before THEN c.rev ELSE p.predicted_revenue_before END AS predicted_revenue_after
  FROM {src} p LEFT JOIN cand3 c ON c.listing_id = p.listing_id AND c.rk = 1)""",
        """opt AS (
  SELECT *, round_even(bp * 100, 0) / 100 AS optimized_price,
         predicted_revenue_after - predicted_revenue_before AS expected_improvement
  FROM best)""",
    ]


#: Fixed: the texts of the report, as they must read.
REPORT_CTE = f"""rep AS (
  SELECT *,
    CASE WHEN current_price = 0 THEN 'keep'
         WHEN (optimized_price - current_price) / current_price > {D(0.02)} THEN 'increase'
         WHEN (optimized_price - current_price) / current_price < -{D(0.02)} THEN 'decrease'
         ELSE 'keep' END AS recommendation
  FROM opt),
rep2 AS (
  SELECT *,
    CASE WHEN recommendation = 'increase' AND predicted_revenue_after > predicted_revenue_before
           THEN 'Increase price because expected revenue improves by ' || printf('%.2f', expected_improvement) || ' while demand remains acceptable.'
         WHEN recommendation = 'increase' THEN 'Increase price due to optimization output.'
         WHEN recommendation = 'decrease' AND predicted_demand_after > predicted_demand_before
           THEN 'Decrease price because lower price is expected to raise demand and improve revenue by ' || printf('%.2f', expected_improvement) || '.'
         WHEN recommendation = 'decrease' THEN 'Decrease price due to optimization output.'
         ELSE 'Keep current price because expected improvement is small and current price is already near optimal.' END AS reason
  FROM rep)"""

REPORT_SELECT = f"""SELECT listing_id, {R('current_price')} AS current_price, {R('optimized_price')} AS optimized_price,
       {R('predicted_demand_before')} AS predicted_demand_before, {R('predicted_revenue_before')} AS predicted_revenue_before,
       {R('predicted_demand_after')} AS predicted_demand_after, {R('predicted_revenue_after')} AS predicted_revenue_after,
       {R('expected_improvement')} AS expected_improvement, recommendation, reason
FROM rep2"""


def inference_report_ctes() -> list[str]:
    return [INFERENCE_INPUT, demand_cte("inp"), PRED, *closed_form_ctes(), REPORT_CTE]


def h1_inference() -> str:
    return with_listings(REPORT_SELECT, *inference_report_ctes())



def _rep(select_body: str, *extra_ctes: str) -> str:
    return with_listings(select_body, *inference_report_ctes(), *extra_ctes)


def h1_inference_room_elasticity() -> str:
    e = """CASE room_type WHEN 'Entire home/apt' THEN CAST(-0.6 AS DOUBLE) WHEN 'Private room' THEN CAST(-0.9 AS DOUBLE)
       WHEN 'Shared room' THEN CAST(-1.4 AS DOUBLE) WHEN 'Hotel room' THEN CAST(-1.1 AS DOUBLE) END"""
    ctes = [INFERENCE_INPUT, demand_cte("inp"),
            f"""pred AS (
  SELECT s.listing_id, s.price AS current_price, s.demand_score AS predicted_demand_before,
         s.price * s.demand_score AS predicted_revenue_before, el.e AS e
  FROM scored s JOIN (SELECT CAST(listing_id AS VARCHAR) AS listing_id, {e} AS e FROM listings) el
    ON el.listing_id = s.listing_id)"""]
    cf = closed_form_ctes()
    cf[0] = cf[0].replace("p.predicted_demand_before AS base", "p.predicted_demand_before AS base, p.e AS e")
    cf[1] = cf[1].replace(f"pow(cp / current_price, {D(-1.2)})", "pow(cp / current_price, e)")
    return with_listings(REPORT_SELECT, *ctes, *cf, REPORT_CTE)


def g08_inference_summary() -> str:
    return _rep(f"""SELECT count(*) AS total_listings,
  count(*) FILTER (WHERE recommendation = 'increase') AS increase_count,
  count(*) FILTER (WHERE recommendation = 'decrease') AS decrease_count,
  count(*) FILTER (WHERE recommendation = 'keep') AS keep_count,
  {R('sum(expected_improvement)')} AS total_expected_improvement,
  {R('avg(expected_improvement)')} AS average_expected_improvement,
  {R('max(expected_improvement)')} AS max_expected_improvement,
  {R('min(expected_improvement)')} AS min_expected_improvement
FROM rep2""")


def g11_dashboard_kpis() -> str:
    return _rep(f"""SELECT count(*) AS total_listings, {R('sum(expected_improvement)')} AS revenue_increase,
  {R(f"avg(CASE WHEN current_price = 0 THEN NULL ELSE (optimized_price - current_price) / current_price END) * {D(100)}")} AS avg_price_change_pct,
  {R(f"avg(CASE WHEN recommendation <> 'keep' THEN {D(1)} ELSE {D(0)} END) * {D(100)}")} AS pct_listings_changed
FROM rep2""")


def g12_revenue_impact() -> str:
    return _rep(f"""SELECT {R('sum(predicted_revenue_before)')} AS revenue_before, {R('sum(predicted_revenue_after)')} AS revenue_after,
  {R('sum(predicted_revenue_after) - sum(predicted_revenue_before)')} AS total_gain, count(*) AS total_listings,
  count(*) FILTER (WHERE recommendation = 'increase') AS increase_count,
  count(*) FILTER (WHERE recommendation = 'decrease') AS decrease_count,
  count(*) FILTER (WHERE recommendation = 'keep') AS keep_count
FROM rep2""")


DASH = f"""SELECT listing_id, {R('current_price')} AS current_price, {R('optimized_price')} AS optimized_price,
  {R('expected_improvement')} AS expected_improvement, recommendation, reason FROM rep2"""


def b16_filter_recommendations() -> str:
    return _rep(DASH + f" WHERE recommendation IN ('decrease') AND current_price BETWEEN {D(50)} AND {D(200)}")


def b16_filter_defaults() -> str:
    return _rep(DASH + " WHERE current_price BETWEEN (SELECT min(current_price) FROM rep2) AND (SELECT max(current_price) FROM rep2)")


def f05_explorer_listing() -> str:
    n = 30
    body = f"""SELECT listing_id, {R('current_price')} AS current_price, {R('predicted_demand_before')} AS predicted_demand_before,
  {R('optimized_price')} AS optimized_price, option_id, {R('candidate_price')} AS candidate_price,
  {R('predicted_demand')} AS predicted_demand, {R('candidate_price * predicted_demand')} AS expected_revenue
FROM (SELECT x.*, x.predicted_demand_before * pow(CASE WHEN x.current_price = 0 THEN NULL
                                                      ELSE x.candidate_price / x.current_price END, {D(-1.2)}) AS predicted_demand
      FROM (SELECT r.listing_id, r.current_price, r.predicted_demand_before, r.optimized_price, CAST(t.i AS INTEGER) AS option_id,
                   CASE WHEN t.i = {n - 1} THEN r.current_price * {D(1.3)}
                        ELSE r.current_price * {D(0.7)} + CAST(t.i AS DOUBLE)
                             * ((r.current_price * {D(1.3)} - r.current_price * {D(0.7)}) / {D(n - 1)}) END AS candidate_price
            FROM rep2 r CROSS JOIN range(0, {n}) t(i) WHERE r.listing_id = '42') x) y"""
    return _rep(body)


def g13_listing_insight() -> str:
    return _rep(f"""SELECT listing_id, {R('current_price')} AS current_price, {R('optimized_price')} AS optimized_price,
  {R('expected_improvement')} AS revenue_gain FROM rep2 WHERE listing_id = '42'""")


# ------------------------------------------------------------------ B

def b04_inference_input() -> str:
    return with_listings(f"""SELECT listing_id, {R('price')} AS price, {R('service_fee')} AS service_fee, room_type,
  neighbourhood_group, {R('availability_365')} AS availability_365, {R('number_of_reviews')} AS number_of_reviews,
  {R('reviews_per_month')} AS reviews_per_month FROM inp""", INFERENCE_INPUT)


def b05_parse_money() -> str:
    return with_listings(f"""SELECT listing_id, raw_price,
  {R("TRY_CAST(trim(regexp_replace(raw_price, '[$,]', '', 'g')) AS DOUBLE)")} AS parsed_price FROM listings""")


def _median_fill(cols, src="listings", where="") -> str:
    meds = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in cols)
    return f"(SELECT {meds} FROM {src} {where})"


def b07_impute_median() -> str:
    cols = ["reviews_per_month", "availability_365", "review_rate_number", "service_fee"]
    sel = ", ".join(f"{R(f'coalesce(l.{c}, m.m_{c})')} AS {c}" for c in cols)
    return with_listings(f"SELECT l.listing_id, {sel} FROM listings l, {_median_fill(cols)} m")


def _mode(col: str, src: str) -> str:
    return f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY count(*) DESC, {col} ASC LIMIT 1)"


def b08_impute_mode() -> str:
    cols = ["cancellation_policy", "instant_bookable", "neighbourhood_group"]
    sel = ", ".join(f"coalesce({c}, {_mode(c, 'listings')}) AS {c}" for c in cols)
    return with_listings(f"SELECT listing_id, {sel} FROM listings")


def h4_clean_batch() -> str:
    med = ["availability_365", "minimum_nights", "review_rate_number", "price", "service_fee"]
    raw = """raw AS (
  SELECT listing_id, host_id, service_fee, room_type, neighbourhood_group, minimum_nights, reviews_per_month, availability_365,
         review_rate_number, instant_bookable, lower(trim(cancellation_policy)) AS cancellation_policy, competitor_avg_price,
         CASE WHEN listing_id % 31 <> 0 THEN CAST(replace(replace(raw_price, '$', ''), ',', '') AS DOUBLE) END AS price,
         CASE WHEN listing_id % 37 <> 0 THEN number_of_reviews END AS number_of_reviews,
         CASE WHEN listing_id % 29 <> 0 THEN CASE WHEN listing_id % 3 = 0 THEN 'Canada' ELSE 'United States' END END AS country,
         CASE WHEN listing_id % 5 <> 0 THEN 'verified' END AS host_identity_verified
  FROM listings)"""
    filled = f"""filled AS (
  SELECT r.listing_id, r.host_id, r.room_type, r.host_identity_verified, r.competitor_avg_price,
         {", ".join(f"coalesce(r.{c}, m.m_{c}) AS {c}" for c in med)},
         coalesce(r.reviews_per_month, {D(0)}) AS reviews_per_month, coalesce(r.number_of_reviews, {D(0)}) AS number_of_reviews,
         coalesce(r.country, 'United States') AS country,
         {", ".join(f"coalesce(r.{c}, {_mode(c, 'raw')}) AS {c}" for c in ("instant_bookable", "neighbourhood_group", "cancellation_policy"))}
  FROM raw r, {_median_fill(med, 'raw')} m)"""
    doubles = med + ["reviews_per_month", "number_of_reviews", "competitor_avg_price"]
    body = f"""SELECT listing_id, host_id, room_type, neighbourhood_group, instant_bookable, cancellation_policy, country,
  host_identity_verified, {", ".join(R(c) + " AS " + c for c in doubles)}
FROM filled WHERE availability_365 >= 0 AND availability_365 <= 366"""
    return with_listings(body, raw, filled)


# ------------------------------------------------------------------ odd values

ODD_MONEY = ["5d", "$7f", "Infinity", "$1,234", " $12.50 ", "", "-3e2", "NaN", "0x10", "1.2.3"]
_ODD = "CASE listing_id % 10 " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(ODD_MONEY)) + " END"
_DECIMAL = "^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _number(text: str) -> str:
    return f"CASE WHEN regexp_matches(trim({text}), '{_DECIMAL}') THEN TRY_CAST(trim({text}) AS DOUBLE) END"


def b03_enforce_types() -> str:
    return with_listings(f"""SELECT listing_id, {R(f"CASE WHEN listing_id % 2 = 0 THEN {_number(_ODD)} ELSE price END")} AS price
FROM listings""")


def b05_parse_odd_money() -> str:
    bare = f"replace(replace({_ODD}, '$', ''), ',', '')"
    return with_listings(f"SELECT listing_id, {R(_number(bare))} AS parsed_price FROM listings")


def b01_b06_b09_names_and_fills() -> str:
    return with_listings("""SELECT listing_id, room_type, CASE WHEN listing_id % 3 > 0 THEN 'Canada' ELSE 'United States' END AS country
FROM listings""")


def b02_missing_columns() -> str:
    gone = ["service_fee", "room_type", "neighbourhood_group", "availability_365", "number_of_reviews", "reviews_per_month"]
    return with_listings(f"SELECT count(*) AS listings, 'input lacks columns: {', '.join(gone)}' AS said FROM listings")


def b07_integer_median() -> str:
    return with_listings("""SELECT listing_id, coalesce(CASE WHEN listing_id % 2 = 0 THEN CAST(listing_id AS DOUBLE) END,
  (SELECT quantile_cont(CAST(listing_id AS DOUBLE), 0.5) FROM listings WHERE listing_id % 2 = 0)) AS half FROM listings""")


#: Prices that are left of _with_odd_values: those that are missing there have no number.
_SOUND = "sound AS (SELECT listing_id, room_type, minimum_nights, CASE WHEN listing_id % 50 IN (1, 2, 3, 4) THEN NULL ELSE price END AS price FROM listings)"


def b13_odd_values_dropped() -> str:
    return with_listings(f"SELECT listing_id, room_type, {R('price')} AS price, {R('minimum_nights')} AS minimum_nights "
                         "FROM sound WHERE price IS NOT NULL", _SOUND)


def b14_leakage_columns() -> str:
    left = sorted(c for c in ALL_LISTING_COLS if c not in ("reviews_per_month", "availability_365"))
    return with_listings(f"SELECT count(*) AS listings, '{','.join(left)}' AS \"left\" FROM listings")


def c03_distinct_of_nothing() -> str:
    return with_listings("""SELECT 'room_type' AS "column", count(DISTINCT room_type) AS n_distinct FROM listings
UNION ALL SELECT 'no_text', CAST(0 AS BIGINT)""")


def c08_iqr_odd_values() -> str:
    parts = []
    for c in ("price", "minimum_nights"):
        q = f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM sound)"
        parts.append(f"""SELECT '{c}' AS "column", {R('q1')} AS q1, {R('q3')} AS q3, {R('q3 - q1')} AS iqr,
  {R(f'q1 - {D(1.5)} * (q3 - q1)')} AS lower, {R(f'q3 + {D(1.5)} * (q3 - q1)')} AS upper,
  (SELECT count(*) FROM sound WHERE {c} < q1 - {D(1.5)} * (q3 - q1) OR {c} > q3 + {D(1.5)} * (q3 - q1)) AS n_outliers FROM {q} q""")
    none = "CAST(NULL AS DOUBLE)"
    parts.append(f"SELECT 'nothing', {none}, {none}, {none}, {none}, {none}, CAST(0 AS BIGINT)")
    return with_listings("\nUNION ALL\n".join(parts), _SOUND)


def c09_histogram_odd_values() -> str:
    return with_listings(_histogram("sound", 200), _SOUND)


def _histogram(src: str, bins: int) -> str:
    b = _bucket("l.price", "s.lo", "s.hi", bins)
    return f"""SELECT CAST(e.bin AS INTEGER) AS bin, {R(f'lo + CAST(e.bin - 1 AS DOUBLE) * w')} AS lower,
  {R('lo + CAST(e.bin AS DOUBLE) * w')} AS upper, coalesce(c.n, 0) AS count
FROM range(1, {bins + 1}) e(bin), (SELECT min(price) AS lo, (max(price) - min(price)) / {D(bins)} AS w FROM {src}) s
LEFT JOIN (SELECT {b} AS bin, count(*) AS n FROM {src} l, (SELECT min(price) AS lo, max(price) AS hi FROM {src}) s
           WHERE l.price IS NOT NULL AND NOT isnan(l.price) GROUP BY 1) c ON c.bin = e.bin"""


def c06_data_summary() -> str:
    return with_listings("""SELECT count(*) AS n_rows, CAST(3 AS BIGINT) AS n_columns, CAST(3 AS INTEGER) AS n_missing,
  CAST(2 AS INTEGER) AS n_numeric, count(DISTINCT room_type) AS room_types FROM listings""")


def d03_minmax() -> str:
    return with_listings(f"""SELECT listing_id, {R('(price - lo) / (hi - lo + 1e-8)')} AS price_minmax
FROM listings, (SELECT min(price) AS lo, max(price) AS hi FROM listings)""")


def d14_indicators() -> str:
    kinds = ["Hotel room", "Private room", "Shared room"]
    return with_listings("SELECT listing_id, " + ", ".join(
        f"CASE WHEN room_type = '{k}' THEN {D(1)} ELSE {D(0)} END AS \"room_type_{k}\"" for k in kinds) + " FROM listings")


def d17_numeric_columns() -> str:
    return with_listings(f"SELECT count(*) AS listings, '{','.join(sorted(['listing_id', 'host_id', *LISTING_DOUBLES]))}' AS numeric FROM listings")


def g02_half_cents() -> str:
    x = "CAST(listing_id AS DOUBLE)"
    return with_listings(f"""SELECT listing_id, printf('%.2f', {x} / {D(1000)}) AS plain, printf('%.2f', -({x} / {D(1000)}) * {D(1.1)}) AS scaled,
  printf('%.2f', CAST(listing_id * 2 + 1 AS DOUBLE) / {D(8)}) AS ties FROM listings""")


LISTING_DOUBLES = ["price", "service_fee", "minimum_nights", "number_of_reviews", "reviews_per_month",
                   "availability_365", "review_rate_number", "competitor_avg_price"]
LISTING_OTHER = ["listing_id", "host_id", "room_type", "neighbourhood_group", "instant_bookable",
                 "cancellation_policy", "raw_price"]


def _listing_cols(prefix: str = "", override: dict | None = None) -> str:
    override = override or {}
    parts = []
    for c in LISTING_OTHER:
        parts.append(f"{override.get(c, prefix + c)} AS {c}")
    for c in LISTING_DOUBLES:
        parts.append(f"{R(override.get(c, prefix + c))} AS {c}")
    return ", ".join(parts)


def b12_drop_nulls() -> str:
    return with_listings(f"""SELECT {_listing_cols(override={'room_type': "coalesce(room_type, 'missing')"})}
FROM listings WHERE reviews_per_month IS NOT NULL AND availability_365 IS NOT NULL""")


# ------------------------------------------------------------------ C

ALL_LISTING_COLS = ["listing_id", "host_id", "price", "service_fee", "room_type", "neighbourhood_group",
                    "minimum_nights", "number_of_reviews", "reviews_per_month", "availability_365",
                    "review_rate_number", "instant_bookable", "cancellation_policy", "raw_price",
                    "competitor_avg_price"]
PROFILE_NUMERIC = ["price", "service_fee", "minimum_nights", "number_of_reviews", "reviews_per_month",
                   "availability_365", "review_rate_number"]
STRING_COLS = ["room_type", "neighbourhood_group", "cancellation_policy", "raw_price"]


def c01_profile_shape() -> str:
    return with_listings(f"SELECT count(*) AS n_rows, CAST({len(ALL_LISTING_COLS)} AS BIGINT) AS n_columns FROM listings")


def c02_profile_missing() -> str:
    parts = []
    for c in ALL_LISTING_COLS:
        miss = f"{c} IS NULL" + (f" OR isnan({c})" if c in LISTING_DOUBLES else "")
        parts.append(f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {miss}) AS missing_count,
  {R(f"CAST(count(*) FILTER (WHERE {miss}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * {D(100)}")} AS missing_pct FROM listings""")
    return with_listings("\nUNION ALL\n".join(parts))


def c03_profile_distinct() -> str:
    parts = [f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct FROM listings""" for c in STRING_COLS]
    return with_listings("\nUNION ALL\n".join(parts))


def _long(cols, src="listings") -> str:
    return "\nUNION ALL\n".join(f"""SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM {src}""" for c in cols)


def c04_profile_numeric() -> str:
    return with_listings(f"""SELECT col AS "column", count(v) AS count, {R('avg(v)')} AS mean, {R('stddev_samp(v)')} AS std,
  {R('min(v)')} AS min, {R('quantile_cont(v, 0.25)')} AS q25, {R('quantile_cont(v, 0.5)')} AS q50,
  {R('quantile_cont(v, 0.75)')} AS q75, {R('max(v)')} AS max
FROM lng WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY col""", f"lng AS ({_long(PROFILE_NUMERIC)})")


def c07_skew() -> str:
    return with_listings(f"""SELECT col AS "column", {R('CASE WHEN count(v) > 2 THEN skewness(v) END')} AS skewness
FROM lng GROUP BY col""", f"lng AS ({_long(PROFILE_NUMERIC)})")


def c08_iqr_outliers() -> str:
    q = f"""q AS (SELECT col, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM lng
  WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY col),
b AS (SELECT col, q1, q3, q3 - q1 AS iqr, q1 - {D(1.5)} * (q3 - q1) AS lower, q3 + {D(1.5)} * (q3 - q1) AS upper FROM q)"""
    return with_listings(f"""SELECT b.col AS "column", {R('b.q1')} AS q1, {R('b.q3')} AS q3, {R('b.iqr')} AS iqr,
  {R('b.lower')} AS lower, {R('b.upper')} AS upper,
  (SELECT count(*) FROM lng WHERE lng.col = b.col AND (lng.v < b.lower OR lng.v > b.upper)) AS n_outliers
FROM b""", f"lng AS ({_long(PROFILE_NUMERIC)})", q)


def _bucket(v: str, lo: str, hi: str, bins: int) -> str:
    w = f"(({hi} - {lo}) / {D(bins)})"
    return (f"CASE WHEN {hi} = {lo} THEN 1 ELSE least(CAST(floor(({v} - {lo}) / {w}) AS INTEGER) + 1, {bins}) END")


def c09_histogram() -> str:
    return with_listings(_histogram("listings", 50))


def _box(src: str, value: str, key: str) -> str:
    return f"""d AS (SELECT {key} AS k, CAST({value} AS DOUBLE) AS v FROM {src}
  WHERE {value} IS NOT NULL AND NOT isnan({value}) AND {key} IS NOT NULL),
q AS (SELECT k, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
      FROM d GROUP BY k),
f AS (SELECT k, q1, median, q3, q1 - {D(1.5)} * (q3 - q1) AS lf, q3 + {D(1.5)} * (q3 - q1) AS uf FROM q)"""


def _box_select(key: str) -> str:
    return f"""SELECT f.k AS {key}, count(*) AS count, {R('min(d.v)')} AS min, {R('any_value(f.q1)')} AS q1,
  {R('any_value(f.median)')} AS median, {R('any_value(f.q3)')} AS q3, {R('max(d.v)')} AS max,
  {R('min(CASE WHEN d.v >= f.lf AND d.v <= f.uf THEN d.v END)')} AS whisker_low,
  {R('max(CASE WHEN d.v >= f.lf AND d.v <= f.uf THEN d.v END)')} AS whisker_high,
  count(*) FILTER (WHERE NOT (d.v >= f.lf AND d.v <= f.uf)) AS n_outliers
FROM d JOIN f ON d.k = f.k GROUP BY f.k"""


def c10_box_price_by_room() -> str:
    return with_listings(_box_select("room_type"), _box("listings", "price", "room_type"))


def c10_box_demand_by_area() -> str:
    return with_listings(_box_select("neighbourhood_group"), demand_cte("listings"),
                         _box("scored", "demand_score", "neighbourhood_group"))


CORR_COLS = ["price", "number_of_reviews", "reviews_per_month", "availability_365", "demand_score"]


def c11_corr_matrix() -> str:
    parts = [f"SELECT '{a}' AS a, '{b}' AS b, {R(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS corr FROM scored"
             for a in CORR_COLS for b in CORR_COLS]
    return with_listings("\nUNION ALL\n".join(parts), demand_cte("listings"))


def c12_bin2d() -> str:
    bx = _bucket("CAST(s.price AS DOUBLE)", "m.xlo", "m.xhi", 20)
    by = _bucket("CAST(s.demand_score AS DOUBLE)", "m.ylo", "m.yhi", 20)
    return with_listings(f"""SELECT {bx} AS x_bin, {by} AS y_bin, count(*) AS count, {R('avg(s.price)')} AS mean_price
FROM scored s, (SELECT min(price) AS xlo, max(price) AS xhi, min(demand_score) AS ylo, max(demand_score) AS yhi FROM scored) m
WHERE s.price IS NOT NULL AND s.demand_score IS NOT NULL
GROUP BY 1, 2""", demand_cte("listings"))


def c13_value_counts() -> str:
    return with_listings("SELECT room_type, count(*) AS count FROM listings WHERE room_type IS NOT NULL GROUP BY room_type")


# ------------------------------------------------------------------ D

def d02_demand_score() -> str:
    return with_listings(f"SELECT listing_id, {R('demand_score')} AS demand_score FROM scored", demand_cte("listings"))


def h4_engineer_batch() -> str:
    fe = f"""fe AS (
  SELECT l.*, CASE WHEN availability_365 + {D(1)} = 0 THEN NULL ELSE reviews_per_month / (availability_365 + {D(1)}) END AS demand_score,
    CASE WHEN number_of_reviews + {D(1)} = 0 THEN NULL ELSE reviews_per_month / (number_of_reviews + {D(1)}) END AS review_intensity,
    CASE WHEN availability_365 <= {D(120)} THEN 'low' WHEN availability_365 <= {D(240)} THEN 'medium' ELSE 'high' END AS availability_bucket,
    CASE WHEN minimum_nights = 0 THEN NULL ELSE price / minimum_nights END AS price_per_minimum_night,
    ln({D(1)} + price) AS price_log
  FROM listings l),
ng AS (SELECT neighbourhood_group, avg(demand_score) AS neighbourhood_group_demand_avg FROM fe
       WHERE neighbourhood_group IS NOT NULL GROUP BY neighbourhood_group)"""
    doubles = [c for c in LISTING_DOUBLES] + ["demand_score", "review_intensity", "price_per_minimum_night", "price_log",
                                              "neighbourhood_group_demand_avg", "price_review_interaction",
                                              "availability_min_nights"]
    other = [c for c in LISTING_OTHER if c != "raw_price"] + ["availability_bucket", "room_type_neighbourhood"]
    expr = {"price_review_interaction": "fe.price * fe.reviews_per_month",
            "availability_min_nights": "fe.availability_365 * fe.minimum_nights",
            "room_type_neighbourhood": "fe.room_type || '_' || fe.neighbourhood_group",
            "neighbourhood_group_demand_avg": "ng.neighbourhood_group_demand_avg"}
    sel = ", ".join([f"{expr.get(c, 'fe.' + c)} AS {c}" for c in other] +
                    [f"{R(expr.get(c, 'fe.' + c))} AS {c}" for c in doubles])
    return with_listings(f"SELECT {sel} FROM fe LEFT JOIN ng ON ng.neighbourhood_group = fe.neighbourhood_group", fe)


def d12_model_features() -> str:
    return with_listings(f"""SELECT listing_id,
  {R(f'CASE WHEN price IS NULL THEN NULL ELSE ln({D(1)} + greatest(price, {D(0)})) END')} AS price_log,
  {R(f'CASE WHEN minimum_nights + {D(1)} = 0 THEN NULL ELSE price / (minimum_nights + {D(1)}) END')} AS price_per_minimum_night,
  coalesce(room_type, 'nan') || '_' || coalesce(neighbourhood_group, 'nan') AS room_type_neighbourhood
FROM listings""")


TEST_FLAG = "(substr(md5(CAST(listing_id AS VARCHAR) || ':42'), 1, 8) < '33333333')"


def d19_split() -> str:
    return with_listings(f"SELECT listing_id, {TEST_FLAG} AS is_test FROM listings")


SPLIT = f"sp AS (SELECT *, {TEST_FLAG} AS is_test FROM listings)"


def d13_frequency() -> str:
    freq = """fq AS (SELECT neighbourhood_group, CAST(count(*) AS DOUBLE) /
             CAST((SELECT count(neighbourhood_group) FROM sp WHERE NOT is_test) AS DOUBLE) AS f
           FROM sp WHERE NOT is_test AND neighbourhood_group IS NOT NULL GROUP BY neighbourhood_group)"""
    return with_listings(f"""SELECT sp.listing_id, sp.neighbourhood_group,
  {R(f'CASE WHEN sp.is_test THEN coalesce(fq.f, {D(0)}) ELSE fq.f END')} AS neighbourhood_group_freq, sp.is_test
FROM sp LEFT JOIN fq ON fq.neighbourhood_group = sp.neighbourhood_group""", SPLIT, freq)


def d14_category_index() -> str:
    cats = """cats AS (SELECT room_type, CAST(row_number() OVER (ORDER BY room_type) - 1 AS INTEGER) AS idx
  FROM (SELECT DISTINCT room_type FROM sp WHERE NOT is_test AND room_type IS NOT NULL) t)"""
    return with_listings("""SELECT l.listing_id, l.room_type, cats.idx AS room_type_index
FROM listings l LEFT JOIN cats ON cats.room_type = l.room_type""", SPLIT, cats)


def d15_median_imputer() -> str:
    cols = ["reviews_per_month", "availability_365", "service_fee"]
    sel = ", ".join(f"{R(f'coalesce(t.{c}, coalesce(m.m_{c}, {D(0)}))')} AS {c}" for c in cols)
    return with_listings(f"SELECT t.listing_id, {sel} FROM sp t, {_median_fill(cols, 'sp', 'WHERE NOT is_test')} m WHERE t.is_test",
                         SPLIT)


def d16_std_scaler() -> str:
    cols = ["price", "number_of_reviews", "minimum_nights"]
    st = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in cols)
    sel = ", ".join(
        f"{R(f'(t.{c} - s.mu_{c}) / CASE WHEN s.sd_{c} = 0 THEN {D(1)} ELSE s.sd_{c} END')} AS {c}" for c in cols)
    return with_listings(f"SELECT t.listing_id, {sel} FROM sp t, (SELECT {st} FROM sp WHERE NOT is_test) s WHERE t.is_test",
                         SPLIT)


# ------------------------------------------------------------------ F

def rint2(x: str, d: int) -> str:
    s = f"1e{d}"
    return f"(round_even(({x}) * {s}, 0) / {s})"


def curve_ctes(n: int = 15, lo_f: float = 0.8, hi_f: float = 1.2, e: float = -1.2) -> list[str]:
    lo = f"greatest(price * {D(lo_f)}, {D(1)})"
    return [
        demand_cte("listings"),
        f"""g0 AS (
  SELECT listing_id, price AS cur, demand_score AS base, room_type, neighbourhood_group, competitor_avg_price,
         {lo} AS lo, greatest(price * {D(hi_f)}, {lo} + {D(1)}) AS hi
  FROM scored)""",
        f"""g1 AS (
  SELECT g0.*, CAST(t.i AS INTEGER) AS option_id,
         {rint2(f"CASE WHEN t.i = {n - 1} THEN hi ELSE lo + CAST(t.i AS DOUBLE) * ((hi - lo) / {D(n - 1)}) END", 2)} AS cand
  FROM g0 CROSS JOIN range(0, {n}) t(i))""",
        f"""g2 AS (
  SELECT *, CASE WHEN cur = 0 OR base * pow(cand / cur, {D(e)}) IS NULL THEN NULL
                 WHEN base * pow(cand / cur, {D(e)}) < 0 THEN {D(0)} ELSE base * pow(cand / cur, {D(e)}) END AS dem
  FROM g1)""",
        f"""curve AS (
  SELECT listing_id, option_id, {rint2('cur', 2)} AS current_price, {rint2('cand', 2)} AS candidate_price,
         {rint2('dem', 6)} AS predicted_demand, {rint2('cand * dem', 6)} AS expected_revenue,
         {rint2('cand - cur', 2)} AS price_change,
         CASE WHEN cur <> 0 THEN {rint2(f'(cand - cur) / cur * {D(100)}', 4)} ELSE {D(0)} END AS price_change_pct,
         room_type, neighbourhood_group, competitor_avg_price
  FROM g2)""",
    ]


CURVE_COLS = ["listing_id", "option_id", "current_price", "candidate_price", "predicted_demand", "expected_revenue",
              "price_change", "price_change_pct", "room_type", "neighbourhood_group", "competitor_avg_price"]
CURVE_DOUBLES = {"current_price", "candidate_price", "predicted_demand", "expected_revenue", "price_change",
                 "price_change_pct", "competitor_avg_price"}


def f01_target_curve() -> str:
    sel = ", ".join(R(c) + " AS " + c if c in CURVE_DOUBLES else c for c in CURVE_COLS)
    return with_listings(f"SELECT {sel} FROM curve", *curve_ctes())


def f05_elastic_curve() -> str:
    n = 30
    g = f"""ec AS (
  SELECT s.listing_id, s.price AS current_price, s.demand_score AS predicted_demand_before, CAST(t.i AS INTEGER) AS option_id,
         CASE WHEN t.i = {n - 1} THEN s.price * {D(1.3)}
              ELSE s.price * {D(0.7)} + CAST(t.i AS DOUBLE) * ((s.price * {D(1.3)} - s.price * {D(0.7)}) / {D(n - 1)}) END AS candidate_price
  FROM scored s CROSS JOIN range(0, {n}) t(i)),
ec2 AS (SELECT *, predicted_demand_before * pow(CASE WHEN current_price = 0 THEN NULL ELSE candidate_price / current_price END, {D(-1.2)}) AS predicted_demand FROM ec)"""
    return with_listings(f"""SELECT listing_id, {R('current_price')} AS current_price, {R('predicted_demand_before')} AS predicted_demand_before,
  option_id, {R('candidate_price')} AS candidate_price, {R('predicted_demand')} AS predicted_demand,
  {R('candidate_price * predicted_demand')} AS expected_revenue FROM ec2""", demand_cte("listings"), g)


def f06_option_ids() -> str:
    return with_listings("""SELECT listing_id, option_id AS grid_option,
  CAST(row_number() OVER (PARTITION BY listing_id ORDER BY option_id) - 1 AS INTEGER) AS option_id FROM curve""",
                         *curve_ctes())


#: Fixed: ranks of room types, as the rules have them.
RANKS = {"Entire home/apt": 3, "Private room": 2, "Shared room": 1}


def rule_ctes(change_pct=None, area_pct=None, room_band=False, hierarchy=False, competitor=None, bounds=None,
              src: str = "curve") -> list[str]:
    conds = []
    ctes = []
    joins = []
    if change_pct is not None:
        conds.append(f"NOT (CASE WHEN c.current_price = 0 THEN FALSE ELSE coalesce(abs(c.candidate_price - c.current_price) / c.current_price * {D(100)} > {D(change_pct)}, FALSE) END)")
    if area_pct is not None:
        d = float(area_pct) / 100.0
        ctes.append(f"""ab AS (SELECT neighbourhood_group, min(current_price) * {D(1.0 - d)} AS lo, max(current_price) * {D(1.0 + d)} AS hi
  FROM {src} WHERE neighbourhood_group IS NOT NULL GROUP BY neighbourhood_group)""")
        joins.append("LEFT JOIN ab ON ab.neighbourhood_group = c.neighbourhood_group")
        conds.append("NOT coalesce(c.candidate_price < ab.lo OR c.candidate_price > ab.hi, FALSE)")
    if room_band:
        ctes.append(f"""rb AS (SELECT room_type, min(current_price) * {D(0.75)} AS lo, max(current_price) * {D(1.25)} AS hi
  FROM {src} WHERE room_type IS NOT NULL GROUP BY room_type)""")
        joins.append("LEFT JOIN rb ON rb.room_type = c.room_type")
        conds.append("NOT coalesce(c.candidate_price < rb.lo OR c.candidate_price > rb.hi, FALSE)")
    if hierarchy:
        rank = " ".join(f"WHEN '{k}' THEN {v}" for k, v in RANKS.items())
        ctes.append(f"""ra AS (SELECT room_type, CASE room_type {rank} END AS rk, avg(current_price) AS av FROM {src}
  GROUP BY room_type HAVING CASE room_type {rank} END IS NOT NULL),
rt AS (SELECT r1.room_type, (SELECT min(r2.av) FROM ra r2 WHERE r2.rk > r1.rk) AS thr FROM ra r1)""")
        joins.append("LEFT JOIN rt ON rt.room_type = c.room_type")
        conds.append("NOT coalesce(c.candidate_price > rt.thr, FALSE)")
    if competitor is not None:
        conds.append(f"NOT coalesce(c.candidate_price > c.competitor_avg_price * {D(competitor)}, FALSE)")
    if bounds is not None:
        lo, hi = bounds
        conds.append(f"coalesce(c.candidate_price >= {D(lo)}, TRUE) AND coalesce(c.candidate_price <= {D(hi)}, TRUE)")
    ok = " AND ".join(f"({x})" for x in conds) or "TRUE"
    ctes.append(f"flagged AS (SELECT c.*, {ok} AS feasible FROM {src} c {' '.join(joins)})")
    return ctes


SELECTED = """sel AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY expected_revenue DESC NULLS LAST, option_id ASC) AS rk
                 FROM flagged WHERE feasible) t WHERE rk = 1)"""

#: Fixed: the texts of the business table, as they must read.
BIZ = f"""biz AS (
  SELECT listing_id, current_price, candidate_price AS recommended_price, room_type, neighbourhood_group,
         predicted_demand AS predicted_demand_before, predicted_demand AS predicted_demand_after,
         current_price * predicted_demand AS expected_revenue_before,
         candidate_price * predicted_demand AS expected_revenue_after,
         candidate_price * predicted_demand - current_price * predicted_demand AS expected_revenue_change,
         candidate_price - current_price AS price_change,
         (candidate_price - current_price) / CASE WHEN current_price = 0 THEN {D(1)} ELSE current_price END * {D(100)} AS price_change_pct
  FROM sel),
biz2 AS (
  SELECT *, CASE WHEN price_change > 0 THEN 'Increase Price' WHEN price_change < 0 THEN 'Decrease Price' ELSE 'Keep Price' END AS price_action,
    CASE WHEN recommended_price < current_price AND predicted_demand_after > predicted_demand_before
           THEN 'Lower price is expected to increase demand and improve occupancy.'
         WHEN recommended_price > current_price AND expected_revenue_change > 0
           THEN 'Higher price is expected to improve revenue with acceptable demand loss.'
         WHEN abs(recommended_price - current_price) < {D(1e-6)} THEN 'Current price appears close to the best feasible price.'
         WHEN expected_revenue_change <= 0 THEN 'Recommendation is constrained by business rules or limited feasible options.'
         ELSE 'Selected as the best feasible price under the optimization model.' END AS reason
  FROM biz)"""

BIZ_SELECT = f"""SELECT listing_id, {R('current_price')} AS current_price, {R('recommended_price')} AS recommended_price,
  room_type, neighbourhood_group, price_action, {R('predicted_demand_before')} AS predicted_demand_before,
  {R('predicted_demand_after')} AS predicted_demand_after, {R('expected_revenue_before')} AS expected_revenue_before,
  {R('expected_revenue_after')} AS expected_revenue_after, {R('expected_revenue_change')} AS expected_revenue_change,
  {R('price_change')} AS price_change, {R('price_change_pct')} AS price_change_pct, reason FROM biz2"""


def recs(**rules) -> str:
    return with_listings(BIZ_SELECT, *curve_ctes(), *rule_ctes(**rules), SELECTED, BIZ)


ALL_RULES = dict(change_pct=20.0, area_pct=25.0, room_band=True, hierarchy=True, competitor=1.2)


def f09_infeasible() -> str:
    return with_listings("SELECT listing_id FROM flagged GROUP BY listing_id HAVING count(*) FILTER (WHERE feasible) = 0",
                         *curve_ctes(), *rule_ctes(**ALL_RULES))


def g09_recommendation_summary() -> str:
    return with_listings(f"""SELECT count(DISTINCT listing_id) AS num_listings, count(*) AS num_recommendations,
  count(*) FILTER (WHERE price_action = 'Increase Price') AS increase_price_count,
  count(*) FILTER (WHERE price_action = 'Decrease Price') AS decrease_price_count,
  count(*) FILTER (WHERE price_action = 'Keep Price') AS keep_price_count,
  {R('avg(price_change_pct)')} AS average_price_change_pct, {R('sum(expected_revenue_before)')} AS total_expected_revenue_before,
  {R('sum(expected_revenue_after)')} AS total_expected_revenue_after, {R('sum(expected_revenue_change)')} AS total_expected_revenue_change
FROM biz2""", *curve_ctes(), *rule_ctes(**ALL_RULES), SELECTED, BIZ)


SEL_METRICS = f"""sm AS (
  SELECT listing_id, option_id, current_price, candidate_price AS recommended_price, predicted_demand, expected_revenue,
         current_price * predicted_demand AS current_revenue_estimate,
         expected_revenue - current_price * predicted_demand AS expected_revenue_change,
         candidate_price - current_price AS price_change,
         (candidate_price - current_price) / CASE WHEN current_price = 0 THEN {D(1)} ELSE current_price END * {D(100)} AS price_change_pct
  FROM sel)"""


def g10_selection_summary() -> str:
    return with_listings(f"""SELECT (SELECT count(*) FROM curve) AS num_input_rows, (SELECT count(DISTINCT listing_id) FROM curve) AS num_listings,
  count(*) AS num_selected_rows, {R('sum(expected_revenue)')} AS total_expected_revenue_after,
  {R('sum(current_revenue_estimate)')} AS total_estimated_revenue_before,
  {R('sum(expected_revenue_change)')} AS total_expected_revenue_change, {R('avg(price_change_pct)')} AS average_price_change_pct,
  FALSE AS avg_price_change_enabled, TRUE AS neighborhood_consistency_enabled, FALSE AS room_type_fairness_enabled
FROM sm""", *curve_ctes(), *rule_ctes(area_pct=25.0), SELECTED, SEL_METRICS)


def f17_selection() -> str:
    reason = f"""CASE WHEN price_change > 0 AND expected_revenue_change > 0 THEN 'Higher price improves expected revenue.'
  WHEN price_change < 0 AND expected_revenue_change > 0 THEN 'Lower price improves demand enough to increase expected revenue.'
  WHEN abs(price_change) <= {D(1e-6)} THEN 'Current price already appears near-optimal.'
  ELSE 'Selected as best feasible option under optimization rules.' END"""
    return with_listings(f"""SELECT listing_id, option_id, {R('current_price')} AS current_price, {R('recommended_price')} AS recommended_price,
  {R('predicted_demand')} AS predicted_demand, {R('expected_revenue')} AS expected_revenue,
  {R('current_revenue_estimate')} AS current_revenue_estimate, {R('expected_revenue_change')} AS expected_revenue_change,
  {R('price_change')} AS price_change, {R('price_change_pct')} AS price_change_pct, {reason} AS reason FROM sm""",
                         *curve_ctes(), *rule_ctes(competitor=1.2), SELECTED, SEL_METRICS)


def f01_curve_without_price() -> str:
    return with_listings(f"""SELECT listing_id, count(*) AS options, {R('min(candidate_price)')} AS lowest FROM curve
WHERE listing_id % 41 <> 0 GROUP BY listing_id""", *curve_ctes())


def f08_without_revenue() -> str:
    return with_listings(f"""SELECT l.listing_id, coalesce(c.option_id, -1) AS option_id, {R('c.expected_revenue')} AS expected_revenue, c.option_id IS NOT NULL AS feasible
FROM (SELECT DISTINCT listing_id FROM curve) l LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY expected_revenue DESC, option_id) AS rk FROM curve
  WHERE listing_id % 7 <> 0 AND option_id <> 0 AND expected_revenue IS NOT NULL) c ON c.listing_id = l.listing_id AND c.rk = 1""",
                         *curve_ctes())


def g07_true_before() -> str:
    now = BIZ.replace("predicted_demand AS predicted_demand_before", "now AS predicted_demand_before") \
        .replace("current_price * predicted_demand AS expected_revenue_before", "current_price * now AS expected_revenue_before") \
        .replace("candidate_price * predicted_demand - current_price * predicted_demand AS",
                 "candidate_price * predicted_demand - current_price * now AS") \
        .replace("FROM sel)", "FROM (SELECT sel.*, scored.demand_score AS now FROM sel JOIN scored ON scored.listing_id = sel.listing_id))")
    return with_listings(BIZ_SELECT, *curve_ctes(), *rule_ctes(), SELECTED, now)


def _nearest(src: str = "curve") -> str:
    return f"""near AS (SELECT listing_id, predicted_demand AS now FROM (
    SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY abs(candidate_price - current_price), option_id,
      predicted_demand NULLS FIRST) AS nk FROM {src})
  WHERE nk = 1)"""


_BIZ_NEAREST = BIZ.replace("predicted_demand AS predicted_demand_before", "now AS predicted_demand_before") \
    .replace("current_price * predicted_demand AS expected_revenue_before", "current_price * now AS expected_revenue_before") \
    .replace("candidate_price * predicted_demand - current_price * predicted_demand AS",
             "candidate_price * predicted_demand - current_price * now AS") \
    .replace("FROM sel)", "FROM (SELECT sel.*, near.now FROM sel JOIN near USING (listing_id)))")


def g07_nearest_before() -> str:
    return with_listings(BIZ_SELECT, *curve_ctes(), *rule_ctes(**ALL_RULES), SELECTED, _nearest(), _BIZ_NEAREST)


def f08_repeated_ids() -> str:
    shared = "shared AS (SELECT * REPLACE (listing_id - listing_id % 2 AS listing_id) FROM curve)"
    chosen = SELECTED.replace("option_id ASC", "option_id ASC, candidate_price ASC, current_price ASC")
    return with_listings(BIZ_SELECT, *curve_ctes(), shared, *rule_ctes(**ALL_RULES, src="shared"), chosen, _nearest("shared"),
                         _BIZ_NEAREST)


def f16_column_bounds() -> str:
    most = f"CASE WHEN c.listing_id % 4 <> 0 THEN c.competitor_avg_price * {D(1.1)} END"
    return recs(bounds=(f"c.competitor_avg_price * {D(0.5)}", most))


def budget_ctes(src: str, max_avg_pct: float, where: str = "TRUE") -> list[str]:
    """Hull steps by recursion, then the cut by one running sum over all steps."""
    cost = f"abs(candidate_price - current_price) / CASE WHEN current_price = 0 THEN {D(1)} ELSE current_price END * {D(100)}"
    return [
        f"""op AS (SELECT listing_id, option_id AS o, {rint2(cost, 6)} AS c, expected_revenue AS v FROM {src}
  WHERE {where} AND expected_revenue IS NOT NULL AND candidate_price IS NOT NULL)""",
        f"""hull AS (
  SELECT listing_id, CAST(0 AS BIGINT) AS k, c, v, o, CAST('Infinity' AS DOUBLE) AS eff FROM (
    SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY c, v DESC, o) AS rn FROM op) WHERE rn = 1
  UNION ALL
  SELECT listing_id, k + 1, c2, v2, o2, least(eff, slope) FROM (
    SELECT h.listing_id, h.k, h.eff, op.c AS c2, op.v AS v2, op.o AS o2, (op.v - h.v) / (op.c - h.c) AS slope,
           row_number() OVER (PARTITION BY h.listing_id ORDER BY (op.v - h.v) / (op.c - h.c) DESC, op.c DESC, op.o) AS rn
    FROM hull h JOIN op ON op.listing_id = h.listing_id AND op.c > h.c AND op.v > h.v) WHERE rn = 1)""",
        """stp AS (SELECT listing_id, k, eff, md5(CAST(listing_id AS VARCHAR)) AS tie, CAST(c AS DECIMAL(18, 6))
    - CAST(lag(c) OVER (PARTITION BY listing_id ORDER BY k) AS DECIMAL(18, 6)) AS dc FROM hull)""",
        f"""room AS (SELECT CAST((SELECT count(DISTINCT listing_id) FROM {src}) * {max_avg_pct} AS DECIMAL(18, 6))
    - (SELECT sum(CAST(c AS DECIMAL(18, 6))) FROM hull WHERE k = 0) AS r)""",
        """cum AS (SELECT listing_id, k, sum(dc) OVER (ORDER BY eff DESC, tie, k ROWS UNBOUNDED PRECEDING) AS t FROM stp WHERE k > 0)""",
        """pick AS (SELECT h.listing_id, h.o FROM hull h JOIN (
    SELECT listing_id, max(k) AS k FROM (SELECT listing_id, k FROM cum, room WHERE t <= r UNION ALL SELECT listing_id, k FROM hull WHERE k = 0)
    GROUP BY listing_id) m ON m.listing_id = h.listing_id AND m.k = h.k)""",
        f"""taken AS (SELECT s.listing_id, s.option_id, s.current_price, s.candidate_price, s.expected_revenue, {cost} AS abs_price_change_pct
  FROM {src} s JOIN pick ON pick.listing_id = s.listing_id AND pick.o = s.option_id)"""]


_TAKEN = f"""SELECT listing_id, option_id, {R('current_price')} AS current_price, {R('candidate_price')} AS candidate_price,
  {R('expected_revenue')} AS expected_revenue, {R('abs_price_change_pct')} AS abs_price_change_pct FROM taken"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def f10_budget() -> str:
    return _recursive(with_listings(_TAKEN, *curve_ctes(), *budget_ctes("curve", 10.0)))


def f10_budget_alike() -> str:
    alike = f"""alike AS (SELECT listing_id, CAST(i AS INTEGER) AS option_id, {D(100)} AS current_price, {D(100)} + {D(5)} * i AS candidate_price,
  {D(100)} + CAST(i * (9 - i) AS DOUBLE) AS expected_revenue FROM listings CROSS JOIN range(0, 5) t(i))"""
    return _recursive(with_listings(_TAKEN, alike, *budget_ctes("alike", 7.0)))


def f10_budget_with_rules() -> str:
    return _recursive(with_listings(_TAKEN, *curve_ctes(), *rule_ctes(competitor=1.2), *budget_ctes("flagged", 5.0, "feasible")))


def f10_budget_summary() -> str:
    left = "(SELECT min(eff) FROM (SELECT eff FROM stp JOIN cum USING (listing_id, k), room WHERE t > r ORDER BY t LIMIT 1))"
    cost = "CAST((SELECT sum(CAST(round_even(abs_price_change_pct * 1e6, 0) / 1e6 AS DECIMAL(18, 6))) FROM taken) AS DOUBLE)"
    return _recursive(with_listings(f"""SELECT 'feasible' AS status, n AS num_listings, CAST(0 AS BIGINT) AS num_infeasible, {R(f'n * {D(10)}')} AS budget,
  {R(left)} AS multiplier, {R(cost)} AS used_cost, {R('v')} AS objective,
  {R(f"v + CAST(CAST(n * 10 AS DECIMAL(18, 6)) - (SELECT sum(CAST(round_even(abs_price_change_pct * 1e6, 0) / 1e6 AS DECIMAL(18, 6))) FROM taken) AS DOUBLE) * {left}")} AS upper_bound,
  {R(f"greatest(v + CAST(CAST(n * 10 AS DECIMAL(18, 6)) - (SELECT sum(CAST(round_even(abs_price_change_pct * 1e6, 0) / 1e6 AS DECIMAL(18, 6))) FROM taken) AS DOUBLE) * {left} - v, {D(0)})")} AS gap
FROM (SELECT count(*) AS n, sum(expected_revenue) AS v FROM taken)""", *curve_ctes(), *budget_ctes("curve", 10.0)))


_TRAIN = ["tr AS (SELECT * FROM scored WHERE NOT is_test)", """st AS (SELECT avg(price) AS mp, stddev_pop(price) AS sp, avg(number_of_reviews) AS mr,
  stddev_pop(number_of_reviews) AS sr, avg(demand_score) AS my FROM tr)""", """mo AS (SELECT sum(p * p) AS pp, sum(r * r) AS rr, sum(p * r) AS pr, sum(p * y) AS py, sum(r * y) AS ry, any_value(my) AS my
  FROM (SELECT (price - mp) / sp AS p, (number_of_reviews - mr) / sr AS r, demand_score - my AS y, my FROM tr, st))"""]


def _two(alpha: float) -> str:
    det = f"((pp + {D(alpha)}) * (rr + {D(alpha)}) - pr * pr)"
    split = f"spl AS (SELECT *, {TEST_FLAG} AS is_test FROM listings)"
    return with_listings(f"""SELECT 'price' AS term, {R(f'((rr + {D(alpha)}) * py - pr * ry) / {det}', 4)} AS value FROM mo
UNION ALL SELECT 'number_of_reviews', {R(f'((pp + {D(alpha)}) * ry - pr * py) / {det}', 4)} FROM mo
UNION ALL SELECT 'intercept', {R('my', 4)} FROM mo""", split, demand_cte("spl"), *_TRAIN)


def e01_linear_two() -> str:
    return _two(0.0)


def e02_ridge_two() -> str:
    return _two(1.0)


def d18_scaled() -> str:
    cols = ["price", "number_of_reviews", "minimum_nights"]
    st = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in cols)
    sel = ", ".join(f"{R(f'(t.{c} - s.mu_{c}) / CASE WHEN s.sd_{c} = 0 THEN {D(1)} ELSE s.sd_{c} END')} AS {c}" for c in cols)
    return with_listings(f"SELECT t.listing_id, {sel} FROM sp t, (SELECT {st} FROM sp WHERE NOT is_test) s WHERE t.is_test", SPLIT)


def h5_encoders() -> str:
    cols = ["price", "minimum_nights", "number_of_reviews", "reviews_per_month"]
    logs = "lg AS (SELECT listing_id, is_test, room_type, neighbourhood_group, reviews_per_month, " + ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN ln({D(1)} + greatest({c}, {D(0)})) END AS {c}" for c in cols[:3]) + " FROM sp)"
    fill = "fl AS (SELECT l.listing_id, l.is_test, l.room_type, l.neighbourhood_group, " + ", ".join(
        f"coalesce(l.{c}, coalesce(m.m_{c}, {D(0)})) AS {c}" for c in cols) + f" FROM lg l, {_median_fill(cols, 'lg', 'WHERE NOT is_test')} m)"
    st = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in cols)
    freq = """fq AS (SELECT neighbourhood_group, CAST(count(*) AS DOUBLE) / CAST((SELECT count(neighbourhood_group) FROM sp WHERE NOT is_test) AS DOUBLE) AS f
  FROM sp WHERE NOT is_test AND neighbourhood_group IS NOT NULL GROUP BY neighbourhood_group)"""
    sel = ", ".join(f"{R(f'(t.{c} - s.mu_{c}) / CASE WHEN s.sd_{c} = 0 THEN {D(1)} ELSE s.sd_{c} END')} AS {c}" for c in cols)
    ind = ", ".join(f"CASE WHEN t.room_type = '{k}' THEN {D(1)} ELSE {D(0)} END AS \"room_type_{k}\"" for k in ("Hotel room", "Private room"))
    return with_listings(f"""SELECT t.listing_id, {sel}, {ind}, {R(f'coalesce(fq.f, {D(0)})')} AS neighbourhood_group
FROM fl t CROSS JOIN (SELECT {st} FROM fl WHERE NOT is_test) s LEFT JOIN fq ON fq.neighbourhood_group = t.neighbourhood_group
WHERE t.is_test""", SPLIT, logs, fill, freq)


def e06_tuning_subset() -> str:
    return with_listings("""SELECT listing_id FROM sp WHERE NOT is_test
ORDER BY substr(md5(CAST(listing_id AS VARCHAR) || ':43'), 1, 8), listing_id LIMIT 300""", SPLIT)


def h3_training_facts() -> str:
    return with_listings("""SELECT CAST(4 AS BIGINT) AS models, CAST(count(*) AS INTEGER) AS test_rows, TRUE AS best_has_the_top_r2,
  TRUE AS metrics_recomputed FROM sp WHERE is_test""", SPLIT)


def d18_scaled_odd_values() -> str:
    cols = ["price", "minimum_nights"]
    med = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in cols)
    fill = "fl AS (SELECT s.listing_id, s.is_test, " + ", ".join(f"coalesce(s.{c}, m.m_{c}) AS {c}" for c in cols) + \
        f" FROM so s, (SELECT {med} FROM so WHERE NOT is_test) m)"
    st = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in cols)
    sel = ", ".join(f"{R(f'(t.{c} - s.mu_{c}) / s.sd_{c}')} AS {c}" for c in cols)
    return with_listings(f"SELECT t.listing_id, {sel}, {D(0)} AS nothing FROM fl t, (SELECT {st} FROM fl WHERE NOT is_test) s WHERE t.is_test",
                         _SOUND, f"so AS (SELECT *, {TEST_FLAG} AS is_test FROM sound)", fill)


def d12_stage_in_a_pipeline() -> str:
    whole = d12_model_features()
    return whole.replace("\nFROM listings", f""",
  {R(f'CASE WHEN price IS NULL THEN NULL ELSE ln({D(1)} + greatest(price, {D(0)})) END')} AS bare_price_log, FALSE AS bare_has_area
FROM listings""")


def e05_grid_search() -> str:
    fold = "CAST('0x' || substr(md5(CAST(listing_id AS VARCHAR) || ':44'), 1, 8) AS BIGINT) % 3"
    return with_listings(f"""SELECT CAST(p.i AS INTEGER) AS point, CAST(f.fold AS INTEGER) AS fold, f.n AS rows, f.n AS listings,
  TRUE AS r2_from_predictions, TRUE AS best_has_the_top_mean, TRUE AS first_point
FROM range(0, 4) p(i) CROSS JOIN (SELECT {fold} AS fold, count(*) AS n FROM (
  SELECT listing_id FROM sp WHERE NOT is_test AND demand_score IS NOT NULL
  ORDER BY substr(md5(CAST(listing_id AS VARCHAR) || ':43'), 1, 8), listing_id LIMIT 1000) GROUP BY 1) f""",
                         demand_cte("listings"), f"sp AS (SELECT *, {TEST_FLAG} AS is_test FROM scored)")


def e03_forest_facts() -> str:
    return with_listings("""SELECT count(*) AS predicted, TRUE AS within_labels, TRUE AS error_below_that_of_the_mean,
  CAST(12 AS INTEGER) AS trees, TRUE AS depth_kept, TRUE AS importances_sum_to_one FROM sp WHERE is_test""", SPLIT)


def e04_staged_losses() -> str:
    return with_listings("""SELECT CAST(12 AS BIGINT) AS rounds, CAST(count(*) FILTER (NOT is_test) AS INTEGER) AS train_rows,
  CAST(count(*) FILTER (is_test) AS INTEGER) AS validation_rows, TRUE AS train_never_rises, TRUE AS last_is_the_models,
  TRUE AS best_has_the_least FROM sp""", SPLIT)


def e10_training_log() -> str:
    return with_listings("""SELECT m.name AS run_name, CAST(n.train AS VARCHAR) AS train_rows, CAST(n.test AS VARCHAR) AS test_rows,
  m.rounds AS max_iter, TRUE AS metrics_as_compared, TRUE AS timed
FROM (VALUES ('linear', NULL), ('ridge', NULL), ('gbt', '5')) m(name, rounds),
     (SELECT count(*) FILTER (NOT is_test) AS train, count(*) FILTER (is_test) AS test FROM sp) n""", SPLIT)


def f04_static_once() -> str:
    return with_listings("SELECT listing_id, CAST(15 AS BIGINT) AS options, TRUE AS same FROM listings WHERE price IS NOT NULL")


def f10_budget_refined() -> str:
    return with_listings("""SELECT count(*) AS listings, count(DISTINCT listing_id) AS distinct_listings, TRUE AS within_budget,
  TRUE AS never_worse, TRUE AS gap_not_larger FROM listings WHERE price IS NOT NULL""")


def e10_run_log() -> str:
    return with_listings(f"""SELECT 'run' || i AS run_name, CAST((SELECT count(*) FROM listings) AS VARCHAR) AS rows, {D(1)} + i AS rmse,
  {D(0.5)} AS mae, {D(0.1)} AS r2, TRUE AS timed FROM range(0, 2) t(i)""")


def f04_model_curve_facts() -> str:
    return with_listings("""SELECT count(*) AS listings, 15 * count(*) AS options, TRUE AS all_fifteen, TRUE AS demand_not_negative,
  TRUE AS revenue_is_price_times_demand FROM listings WHERE price IS NOT NULL""")


def e11_score_facts() -> str:
    return with_listings("SELECT count(*) AS listings, count(*) AS predicted, TRUE AS product FROM listings")


def a01_csv_scan() -> str:
    return with_listings(f"""SELECT listing_id, 'said "no", ' || room_type || chr(10) || 'then left' AS house_rules, {R('price')} AS price,
  instant_bookable FROM listings""")


def a01_rejected_rows() -> str:
    return with_listings("""SELECT CASE listing_id % 10 WHEN 1 THEN 'listing_id: it is no bigint' WHEN 2 THEN 'minimum_nights: it is no double'
  WHEN 3 THEN 'columns' WHEN 4 THEN 'columns' ELSE 'good' END AS said, count(*) AS records FROM listings GROUP BY 1""")


def c03_c04_sketches() -> str:
    parts = [f"SELECT '{c}' AS \"column\", count({c}) AS n, TRUE AS within_bound, TRUE AS merged_is_one_pass FROM listings"
             for c in ("price", "minimum_nights", "reviews_per_month")]
    parts += [f"SELECT '{c}', count(DISTINCT {c}), TRUE, TRUE FROM listings" for c in ("room_type", "neighbourhood_group", "listing_id")]
    return with_listings("\nUNION ALL\n".join(parts))


def a02_a03_first_path_or_frame() -> str:
    return with_listings(f"SELECT listing_id, {R('price')} AS price FROM listings")


def a07_model_saved() -> str:
    return with_listings("SELECT count(*) AS rows, TRUE AS same FROM sp WHERE is_test", SPLIT)


def e01_linear_single() -> str:
    fit = """fit AS (SELECT regr_slope(demand_score, number_of_reviews) AS b, regr_intercept(demand_score, number_of_reviews) AS a
  FROM scored WHERE NOT is_test AND number_of_reviews IS NOT NULL AND demand_score IS NOT NULL)"""
    pr = """pr AS (SELECT s.demand_score AS y, f.a + f.b * s.number_of_reviews AS p FROM scored s, fit f
  WHERE s.is_test AND s.number_of_reviews IS NOT NULL)"""
    split = f"spl AS (SELECT *, {TEST_FLAG} AS is_test FROM listings)"
    return with_listings(f"""SELECT {R('sqrt(avg((y - p) * (y - p)))')} AS rmse, {R('avg(abs(y - p))')} AS mae,
  {R(f'{D(1)} - sum((y - p) * (y - p)) / regr_syy(y, p)')} AS r2 FROM pr""", split, demand_cte("spl"), fit, pr)


ORACLES = {
    "b03_enforce_types": b03_enforce_types,
    "b05_parse_odd_money": b05_parse_odd_money,
    "b01_b06_b09_names_and_fills": b01_b06_b09_names_and_fills,
    "b02_missing_columns": b02_missing_columns,
    "b07_integer_median": b07_integer_median,
    "b13_odd_values_dropped": b13_odd_values_dropped,
    "b14_leakage_columns": b14_leakage_columns,
    "c03_distinct_of_nothing": c03_distinct_of_nothing,
    "c08_iqr_odd_values": c08_iqr_odd_values,
    "c09_histogram_odd_values": c09_histogram_odd_values,
    "c06_data_summary": c06_data_summary,
    "d03_minmax": d03_minmax,
    "d14_indicators": d14_indicators,
    "d17_numeric_columns": d17_numeric_columns,
    "g02_half_cents": g02_half_cents,
    "f01_curve_without_price": f01_curve_without_price,
    "f08_without_revenue": f08_without_revenue,
    "g07_true_before": g07_true_before,
    "g07_nearest_before": g07_nearest_before,
    "g07_nearest_before_long": g07_nearest_before,
    "f08_repeated_ids": f08_repeated_ids,
    "f08_repeated_ids_long": f08_repeated_ids,
    "f16_column_bounds": f16_column_bounds,
    "f16_column_bounds_long": f16_column_bounds,
    "f10_budget": f10_budget,
    "f10_budget_alike": f10_budget_alike,
    "f10_budget_refined": f10_budget_refined,
    "f10_budget_long_curve": f10_budget,
    "f10_budget_packed_rules": f10_budget_with_rules,
    "f10_budget_with_rules": f10_budget_with_rules,
    "f10_budget_summary": f10_budget_summary,
    "e01_linear_two": e01_linear_two,
    "e02_ridge_two": e02_ridge_two,
    "d18_scaled": d18_scaled,
    "d18_scaled_odd_values": d18_scaled_odd_values,
    "d12_stage_in_a_pipeline": d12_stage_in_a_pipeline,
    "e05_grid_search": e05_grid_search,
    "e03_forest_facts": e03_forest_facts,
    "e04_staged_losses": e04_staged_losses,
    "e10_training_log": e10_training_log,
    "f04_static_once": f04_static_once,
    "h5_encoders": h5_encoders,
    "e06_tuning_subset": e06_tuning_subset,
    "h3_training_facts": h3_training_facts,
    "e10_run_log": e10_run_log,
    "f04_model_curve_facts": f04_model_curve_facts,
    "e11_score_facts": e11_score_facts,
    "a01_csv_scan": a01_csv_scan,
    "a01_rejected_rows": a01_rejected_rows,
    "a06_curve_by_listing": g07_nearest_before,
    "c03_c04_sketches": c03_c04_sketches,
    "a02_a03_first_path_or_frame": a02_a03_first_path_or_frame,
    "a07_model_saved": a07_model_saved,
    "a04_report_csv": h1_inference,
    "a05_summary_json": g08_inference_summary,
    "a06_curve_parquet": f01_target_curve,
    "f08_long_curve": lambda: recs(),
    "h2_long_curve": lambda: recs(**ALL_RULES),
    "e01_linear_single": e01_linear_single,
    "s01_stream_inference": h1_inference,
    "h1_inference": h1_inference,
    "h1_inference_room_elasticity": h1_inference_room_elasticity,
    "g08_inference_summary": g08_inference_summary,
    "g11_dashboard_kpis": g11_dashboard_kpis,
    "g12_revenue_impact": g12_revenue_impact,
    "b16_filter_recommendations": b16_filter_recommendations,
    "b16_filter_defaults": b16_filter_defaults,
    "g13_listing_insight": g13_listing_insight,
    "f05_explorer_listing": f05_explorer_listing,
    "b04_inference_input": b04_inference_input,
    "b05_parse_money": b05_parse_money,
    "b07_impute_median": b07_impute_median,
    "b08_impute_mode": b08_impute_mode,
    "h4_clean_batch": h4_clean_batch,
    "b12_drop_nulls": b12_drop_nulls,
    "c01_profile_shape": c01_profile_shape,
    "c02_profile_missing": c02_profile_missing,
    "c03_profile_distinct": c03_profile_distinct,
    "c04_profile_numeric": c04_profile_numeric,
    "c07_skew": c07_skew,
    "c08_iqr_outliers": c08_iqr_outliers,
    "c09_histogram": c09_histogram,
    "c10_box_price_by_room": c10_box_price_by_room,
    "c10_box_demand_by_area": c10_box_demand_by_area,
    "c11_corr_matrix": c11_corr_matrix,
    "c12_bin2d": c12_bin2d,
    "c13_value_counts": c13_value_counts,
    "d02_demand_score": d02_demand_score,
    "h4_engineer_batch": h4_engineer_batch,
    "d12_model_features": d12_model_features,
    "d19_split": d19_split,
    "d13_frequency": d13_frequency,
    "d14_category_index": d14_category_index,
    "d15_median_imputer": d15_median_imputer,
    "d16_std_scaler": d16_std_scaler,
    "f01_target_curve": f01_target_curve,
    "f05_elastic_curve": f05_elastic_curve,
    "f06_option_ids": f06_option_ids,
    "f08_select_best": lambda: recs(),
    "f11_limit_change": lambda: recs(change_pct=10.0),
    "f12_area_band": lambda: recs(area_pct=25.0),
    "f13_room_band": lambda: recs(room_band=True),
    "f14_room_hierarchy": lambda: recs(hierarchy=True),
    "f15_competitor_cap": lambda: recs(competitor=1.2),
    "f16_price_bounds": lambda: recs(bounds=(20.0, 400.0)),
    "h2_recommendation": lambda: recs(**ALL_RULES),
    "f09_infeasible": f09_infeasible,
    "g09_recommendation_summary": g09_recommendation_summary,
    "g10_selection_summary": g10_selection_summary,
    "f17_selection": f17_selection,
}


def oracle_sql() -> dict[str, str]:
    return {k: f() for k, f in ORACLES.items()}

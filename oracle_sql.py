"""DuckDB oracle SQL for every registered query.

Independent SQL renditions of the queries in ``stratum.plans.queries``,
written against the driver's pre-registered views (``orders``,
``customer``, ``nation``, ``region``, ``lineitem``). A shared CTE prefix
derives the raw extracts and the eight models; each query adds its final
SELECT. Exact rounding is written out in integer / DECIMAL arithmetic,
because DuckDB turns DECIMAL division into DOUBLE.
"""

from __future__ import annotations

from stratum import fixed
from stratum.plans.queries import AS_OF, BATCH_TS

NUM = r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?"
DATE = r"\d{4}-\d{2}-\d{2}"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_q(v) for v in values)


def tnum(x: str) -> str:
    return (f"TRY_CAST(TRY_CAST(CASE WHEN regexp_full_match(trim({x}), '{NUM}') THEN trim({x}) END "
            f"AS DECIMAL(38,0)) AS BIGINT)")


def tdbl(x: str) -> str:
    return f"TRY_CAST(CASE WHEN regexp_full_match(trim({x}), '{NUM}') THEN trim({x}) END AS DOUBLE)"


def tdate(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '{DATE}') THEN CAST(try_strptime({x}, '%Y-%m-%d') AS DATE) END"


def flag(x: str) -> str:
    return f"COALESCE({x} = 't', false)"


def rnd(x: str, places: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(28,10)), {places}) AS DOUBLE)"


def q6(n: str, d: str) -> str:
    """n/d rounded half up to 6 places, in millionths (n, d >= 0)."""
    return f"((2 * CAST({n} AS HUGEINT) * 1000000 + ({d})) // (2 * CAST({d} AS HUGEINT)))"


def pct(n: str, d: str) -> str:
    """round(round(n/d, 6) * 100, 2) as DOUBLE; NULL when d = 0."""
    return f"CASE WHEN ({d}) = 0 THEN NULL ELSE CAST((2 * {q6(n, d)} + 100) // 200 AS DOUBLE) / 100 END"


def plain_ratio(n: str, d: str) -> str:
    """round(round(n/d, 6), 2) as DOUBLE; NULL when d = 0."""
    return f"CASE WHEN ({d}) = 0 THEN NULL ELSE CAST((2 * {q6(n, d)} + 10000) // 20000 AS DOUBLE) / 100 END"


def nulltok(x: str) -> str:
    return f"CASE WHEN {x} IN ({_list(fixed.NULL_TOKENS)}) THEN NULL ELSE {x} END"


SCORES = ("review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
          "review_scores_checkin", "review_scores_communication", "review_scores_location",
          "review_scores_value")

_CITY_VALUES = ", ".join(f"({_q(c)}, {_q(cur)}, CAST({rate!r} AS DOUBLE))"
                         for c, cur, rate in fixed.CITY_CURRENCY_RATES)


def _raw_listings_sql() -> str:
    k, cu = "o.o_orderkey", "o.o_custkey"
    s = lambda x: f"CAST({x} AS VARCHAR)"
    score_cols = ",\n    ".join(
        f"CASE WHEN {k} % 3 = 0 THEN NULL ELSE {s(f'({k} + {i}) % 81 + 20')} END AS {name}"
        for i, name in enumerate(SCORES))
    return f"""
  SELECT
    {s(k)} AS listing_id,
    'order-' || {s(k)} AS name,
    {s(cu)} AS host_id,
    CASE WHEN {k} % 89 = 0 THEN 'bad-date' ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS host_since,
    CASE WHEN {k} % 11 = 0 THEN 'NA' ELSE n.n_name || ', ' || r.r_name END AS host_location,
    (['NULL', 'within an hour', 'within a few hours', 'within a day', 'a few days or more'])[{k} % 5 + 1]
      AS host_response_time,
    CASE WHEN {k} % 2 = 0 THEN NULL ELSE {s(f'{k} % 101')} || '%' END AS host_response_rate,
    CASE WHEN {k} % 3 = 1 THEN 'null' ELSE {s(f'({k} * 7) % 101')} || '%' END AS host_acceptance_rate,
    CASE WHEN o.o_orderstatus = 'F' THEN 't' WHEN o.o_orderstatus = 'O' THEN 'f' ELSE '' END
      AS host_is_superhost,
    {s(f'{cu} % 7 + 1')} AS host_listings_count,
    CASE WHEN {cu} % 3 = 0 THEN 'f' ELSE 't' END AS host_identity_verified,
    CASE WHEN {cu} % 10 = 0 THEN 'f' ELSE 't' END AS host_has_profile_pic,
    CASE WHEN {k} % 4 = 0 THEN NULL ELSE r.r_name END AS neighbourhood,
    CASE WHEN {k} % 4 = 0 OR {k} % 7 = 0 THEN 'NA' ELSE r.r_name || '-' || {s(f'{k} % 3')} END AS district,
    CASE WHEN c.c_nationkey < {len(fixed.CITIES)} THEN ([{_list(fixed.CITIES)}])[c.c_nationkey + 1]
         ELSE n.n_name END AS city,
    {s(f'{k} % 90')} || '.' || {s(f'{k} % 10')} AS latitude,
    CASE WHEN {cu} % 2 = 0 THEN '-' ELSE '' END || {s(f'{cu} % 180')} || '.' || {s(f'{cu} % 100')} AS longitude,
    c.c_mktsegment AS property_type,
    o.o_orderpriority AS room_type,
    {s(f'{k} % 17')} AS accommodates,
    CASE WHEN {k} % 10 = 0 THEN NULL WHEN {k} % 10 = 3 THEN {s(f'{k} % 5 + 1')} || '.0'
         ELSE {s(f'{k} % 5 + 1')} END AS bedrooms,
    (['["Wifi"]', '["Wifi", "Kitchen"]', '[]'])[{k} % 3 + 1] AS amenities,
    CASE WHEN {k} % 97 = 0 THEN 'abc' ELSE {s('o.o_totalprice / 40')} END AS price,
    {s(f'{k} % 40 + 1')} AS minimum_nights,
    CASE WHEN {k} % 50 = 0 THEN '2147483647' ELSE {s(f'{k} % 1000 + 30')} END AS maximum_nights,
    {score_cols},
    CASE WHEN {k} % 5 < 2 THEN 't' ELSE 'f' END AS instant_bookable
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey"""


def _tokens_sql(src: str, columns) -> str:
    return "SELECT " + ", ".join(f"{nulltok(c)} AS {c}" for c in columns) + f" FROM {src}"


def _bronze_listings_sql() -> str:
    scores = ",\n    ".join(f"{tdbl(x)} AS {x}" for x in SCORES)
    return f"""
  SELECT
    {tnum('listing_id')} AS listing_id,
    {tnum('host_id')} AS host_id,
    name AS listing_name,
    host_since AS host_since_raw,
    {tdate('host_since')} AS host_since_date,
    host_location,
    {tnum('host_listings_count')} AS host_listings_count,
    {flag('host_is_superhost')} AS host_is_superhost,
    {flag('host_identity_verified')} AS host_identity_verified,
    {flag('host_has_profile_pic')} AS host_has_profile_pic,
    {flag('instant_bookable')} AS instant_bookable,
    host_response_time,
    {tdbl("replace(host_response_rate, '%', '')")} AS host_response_rate_pct,
    {tdbl("replace(host_acceptance_rate, '%', '')")} AS host_acceptance_rate_pct,
    city, neighbourhood, district,
    {tdbl('latitude')} AS latitude,
    {tdbl('longitude')} AS longitude,
    property_type, room_type,
    {tnum('accommodates')} AS accommodates,
    {tnum('bedrooms')} AS bedrooms,
    amenities,
    {tdbl('price')} AS price_raw,
    {tnum('minimum_nights')} AS minimum_nights,
    {tnum('maximum_nights')} AS maximum_nights,
    {scores},
    loaded_at
  FROM raw_listings
  WHERE listing_id IS NOT NULL"""


def _silver_listings_sql() -> str:
    price = "b.price_raw * COALESCE(d.rate, 1.0)"
    stay = " ".join(f"WHEN b.minimum_nights <= {b} THEN {_q(lab)}" for b, lab in fixed.STAY_TIERS)
    tiers = " ".join(f"WHEN {price} < {b} THEN {_q(lab)}" for b, lab in fixed.PRICE_TIERS)
    scores = ",\n    ".join(f"COALESCE(b.{x}, 0) AS {x}" for x in SCORES)
    return f"""
  SELECT
    b.listing_id, b.listing_name, b.host_id, b.host_since_date, b.host_location,
    b.host_listings_count, b.host_is_superhost, b.host_identity_verified, b.host_has_profile_pic,
    b.instant_bookable,
    COALESCE(b.host_response_time, 'Unknown') AS host_response_time,
    COALESCE(b.host_response_rate_pct, 0) AS host_response_rate_pct,
    COALESCE(b.host_acceptance_rate_pct, 0) AS host_acceptance_rate_pct,
    b.city,
    COALESCE(b.neighbourhood, 'Unknown') AS neighbourhood,
    COALESCE(b.district, 'Unknown') AS district,
    b.latitude, b.longitude, b.property_type, b.room_type,
    COALESCE(b.accommodates, 1) AS accommodates,
    COALESCE(b.bedrooms, 1) AS bedrooms,
    b.amenities,
    COALESCE(d.currency, 'USD') AS currency,
    b.price_raw,
    {rnd(price, 2)} AS price_usd,
    b.minimum_nights, b.maximum_nights,
    {scores},
    CAST(year(DATE '{AS_OF}') - year(b.host_since_date) AS INTEGER) AS host_years_active,
    CASE {stay} ELSE {_q(fixed.STAY_OTHER)} END AS stay_type,
    CASE {tiers} ELSE {_q(fixed.PRICE_OTHER)} END AS price_category,
    CASE WHEN b.host_is_superhost THEN 'Superhost' ELSE 'Regular Host' END AS host_type,
    b.loaded_at
  FROM bronze_listings b
  LEFT JOIN city_dim d ON b.city = d.city
  WHERE b.listing_id IS NOT NULL
    AND b.price_raw > 0 AND b.price_raw < 10000
    AND b.accommodates > 0
    AND b.city IN ({_list(fixed.CITIES)})"""


def _silver_reviews_sql() -> str:
    season = " ".join(f"WHEN month(review_date) IN ({', '.join(map(str, ms))}) THEN {_q(name)}"
                      for ms, name in fixed.SEASONS)
    return f"""
  SELECT
    review_id, listing_id, reviewer_id, review_date,
    CAST(date_trunc('month', review_date) AS DATE) AS review_month,
    CAST(date_trunc('year', review_date) AS DATE) AS review_year,
    CAST(dayofweek(review_date) AS INTEGER) AS day_of_week,
    strftime(review_date, '%b') AS month_name,
    CAST(month(review_date) AS INTEGER) AS month_number,
    CAST(year(review_date) AS INTEGER) AS year_number,
    CAST(quarter(review_date) AS INTEGER) AS quarter_number,
    CASE {season} ELSE {_q(fixed.SEASON_OTHER)} END AS season,
    loaded_at
  FROM bronze_reviews
  WHERE review_date IS NOT NULL"""


def _price_stats(src_price: str = "price_usd") -> str:
    p = src_price
    return (f"{rnd(f'AVG({p})', 2)} AS avg_price_usd, {rnd(f'MEDIAN({p})', 2)} AS median_price_usd, "
            f"{rnd(f'MIN({p})', 2)} AS min_price_usd, {rnd(f'MAX({p})', 2)} AS max_price_usd")


def _tier_counts(suffix: str) -> str:
    names = ("budget", "midrange", "premium", "luxury")
    return ", ".join(f"COUNT(*) FILTER (WHERE price_category = {_q(cat)}) AS {n}_{suffix}"
                     for n, cat in zip(names, fixed.PRICE_CATEGORIES))


def _avg_nz(c: str, alias: str, places: int = 2) -> str:
    return f"{rnd(f'AVG(NULLIF({c}, 0))', places)} AS {alias}"


FCT_REVENUE = f"""
  SELECT city, currency,
    COUNT(DISTINCT listing_id) AS total_listings,
    COUNT(DISTINCT host_id) AS total_hosts,
    COUNT(DISTINCT CASE WHEN host_is_superhost THEN host_id END) AS superhost_count,
    {pct('COUNT(DISTINCT CASE WHEN host_is_superhost THEN host_id END)', 'COUNT(DISTINCT host_id)')}
      AS superhost_pct,
    {rnd('AVG(price_usd)', 2)} AS avg_price_usd,
    {rnd('MIN(price_usd)', 2)} AS min_price_usd,
    {rnd('MAX(price_usd)', 2)} AS max_price_usd,
    {rnd('MEDIAN(price_usd)', 2)} AS median_price_usd,
    {_avg_nz('review_scores_rating', 'avg_rating')},
    {_avg_nz('review_scores_cleanliness', 'avg_cleanliness_score')},
    {_avg_nz('review_scores_location', 'avg_location_score')},
    {rnd('AVG(minimum_nights)', 1)} AS avg_minimum_nights,
    COUNT(DISTINCT CASE WHEN instant_bookable THEN listing_id END) AS instant_bookable_count,
    {pct('COUNT(DISTINCT CASE WHEN instant_bookable THEN listing_id END)', 'COUNT(DISTINCT listing_id)')}
      AS instant_bookable_pct,
    {_tier_counts('listings')}
  FROM silver_listings
  GROUP BY city, currency"""

FCT_SUPERHOST = f"""
  SELECT city, host_type, host_is_superhost,
    COUNT(DISTINCT host_id) AS total_hosts,
    COUNT(DISTINCT listing_id) AS total_listings,
    {_price_stats()},
    {_avg_nz('review_scores_rating', 'avg_rating')},
    {_avg_nz('review_scores_cleanliness', 'avg_cleanliness')},
    {_avg_nz('review_scores_value', 'avg_value_score')},
    {_avg_nz('review_scores_location', 'avg_location_score')},
    {_avg_nz('review_scores_communication', 'avg_communication_score')},
    {rnd('AVG(host_response_rate_pct)', 2)} AS avg_response_rate_pct,
    {rnd('AVG(host_acceptance_rate_pct)', 2)} AS avg_acceptance_rate_pct,
    {rnd('AVG(host_years_active)', 1)} AS avg_host_years_active,
    {rnd('AVG(host_listings_count)', 1)} AS avg_listings_per_host,
    {rnd('AVG(minimum_nights)', 1)} AS avg_minimum_nights,
    {pct('COUNT(*) FILTER (WHERE instant_bookable)', 'COUNT(*)')} AS instant_bookable_pct,
    {_tier_counts('count')}
  FROM silver_listings
  GROUP BY city, host_type, host_is_superhost"""

FCT_SEASONAL = f"""
  SELECT l.city, r.year_number, r.month_number, r.month_name, r.quarter_number, r.season,
    l.room_type, l.price_category,
    COUNT(r.review_id) AS total_reviews,
    COUNT(DISTINCT r.listing_id) AS active_listings,
    COUNT(DISTINCT r.reviewer_id) AS unique_reviewers,
    {plain_ratio('COUNT(r.review_id)', 'COUNT(DISTINCT r.listing_id)')} AS avg_reviews_per_listing
  FROM silver_reviews r
  JOIN silver_listings l ON r.listing_id = l.listing_id
  GROUP BY l.city, r.year_number, r.month_number, r.month_name, r.quarter_number, r.season,
    l.room_type, l.price_category"""

FCT_PRICE_RATING = f"""
  SELECT city, room_type, property_type, price_category,
    COUNT(DISTINCT listing_id) AS total_listings,
    COUNT(DISTINCT host_id) AS total_hosts,
    {_price_stats()},
    {_avg_nz('review_scores_rating', 'avg_rating')},
    {_avg_nz('review_scores_cleanliness', 'avg_cleanliness')},
    {_avg_nz('review_scores_value', 'avg_value_score')},
    {_avg_nz('review_scores_location', 'avg_location_score')},
    {rnd('AVG(accommodates)', 1)} AS avg_accommodates,
    {rnd('AVG(bedrooms)', 1)} AS avg_bedrooms,
    {rnd('AVG(minimum_nights)', 1)} AS avg_minimum_nights,
    {pct('COUNT(*) FILTER (WHERE host_is_superhost)', 'COUNT(*)')} AS superhost_pct,
    {rnd('AVG(host_response_rate_pct)', 2)} AS avg_response_rate,
    {pct('COUNT(*) FILTER (WHERE instant_bookable)', 'COUNT(*)')} AS instant_bookable_pct
  FROM silver_listings
  WHERE price_usd > 0 AND review_scores_rating > 0
  GROUP BY city, room_type, property_type, price_category"""


def _prefix() -> str:
    raw_reviews = """
  SELECT
    CAST(l_orderkey AS VARCHAR) AS listing_id,
    CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS review_id,
    CASE WHEN (l_orderkey + l_linenumber) % 211 = 0 THEN '2024-02-30'
         ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date,
    CAST(l_suppkey AS VARCHAR) AS reviewer_id
  FROM lineitem"""
    bronze_reviews = f"""
  SELECT listing_id, review_id, review_date, reviewer_id, loaded_at FROM (
    SELECT *, row_number() OVER (
      PARTITION BY review_id
      ORDER BY loaded_at ASC NULLS LAST, review_date ASC NULLS LAST,
               reviewer_id ASC NULLS LAST, listing_id ASC NULLS LAST) AS rn
    FROM (
      SELECT CAST(CAST(trim(listing_id) AS DECIMAL(38,0)) AS BIGINT) AS listing_id,
             CAST(CAST(trim(review_id) AS DECIMAL(38,0)) AS BIGINT) AS review_id,
             {tdate('date')} AS review_date,
             CAST(CAST(trim(reviewer_id) AS DECIMAL(38,0)) AS BIGINT) AS reviewer_id,
             loaded_at
      FROM raw_reviews
      WHERE listing_id IS NOT NULL AND review_id IS NOT NULL))
  WHERE rn = 1"""
    ctes = {
        "city_dim": f"SELECT * FROM (VALUES {_CITY_VALUES}) t(city, currency, rate)",
        "raw_listings_text": _raw_listings_sql(),
        "listings_tokens": _tokens_sql("raw_listings_text", fixed.RAW_LISTING_COLUMNS),
        "raw_listings": f"SELECT *, TIMESTAMP '{BATCH_TS}' AS loaded_at FROM listings_tokens",
        "raw_reviews_text": raw_reviews,
        "reviews_tokens": _tokens_sql("raw_reviews_text", fixed.RAW_REVIEW_COLUMNS),
        "raw_reviews": f"SELECT *, TIMESTAMP '{BATCH_TS}' AS loaded_at FROM reviews_tokens",
        "bronze_listings": _bronze_listings_sql(),
        "bronze_reviews": bronze_reviews,
        "silver_listings": _silver_listings_sql(),
        "silver_reviews": _silver_reviews_sql(),
        "fct_revenue_by_city": FCT_REVENUE,
        "fct_superhost_performance": FCT_SUPERHOST,
        "fct_seasonal_trends": FCT_SEASONAL,
        "fct_price_vs_rating": FCT_PRICE_RATING,
    }
    return "WITH\n" + ",\n".join(f"{name} AS ({body}\n)" for name, body in ctes.items()) + "\n"


def _except(table: str, *cols: str) -> str:
    return f"SELECT * EXCLUDE ({', '.join(cols)}) FROM {table}"


def _data_tests(kind: str) -> str:
    parts = []
    for i, (model, column, test, arg) in enumerate(fixed.DATA_TESTS, start=1):
        if test != kind:
            continue
        head = f"SELECT CAST({i} AS INTEGER) AS test_id, {_q(model)} AS model, {_q(column)} AS column_name, " \
               f"{_q(test)} AS test_name, "
        if test == "not_null":
            parts.append(head + f"CAST(COUNT(*) FILTER (WHERE {column} IS NULL) AS BIGINT) AS failures FROM {model}")
        elif test == "unique":
            parts.append(head + f"CAST(COUNT(*) AS BIGINT) AS failures FROM (SELECT {column} FROM {model} "
                                f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING COUNT(*) > 1)")
        else:
            parts.append(head + f"CAST(COUNT(*) AS BIGINT) AS failures FROM (SELECT DISTINCT {column} "
                                f"FROM {model} WHERE {column} IS NOT NULL AND {column} NOT IN ({_list(arg)}))")
    return "\nUNION ALL\n".join(parts)


LISTINGS = ("listings_tokens", fixed.RAW_LISTING_COLUMNS)
REVIEWS = ("reviews_tokens", fixed.RAW_REVIEW_COLUMNS)


def _null_census(threshold: float, src=LISTINGS) -> str:
    table, cols = src
    unpivot = "\nUNION ALL\n".join(
        f"SELECT {_q(c)} AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls, COUNT(*) AS total "
        f"FROM {table}" for c in cols)
    share = "CAST(nulls AS DOUBLE) / total * 100"
    return (f"SELECT column_name, nulls, {rnd(share, 2)} AS null_pct FROM ({unpivot}) "
            f"WHERE nulls > 0 AND {share} > {threshold!r}")


def _present(cols, wanted):
    return [c for c in wanted if c in cols]


def _value_counts(src=LISTINGS) -> str | None:
    table, cols = src
    parts = [f"SELECT {_q(c)} AS column_name, CAST({c} AS VARCHAR) AS value, COUNT(*) AS n "
             f"FROM {table} GROUP BY {c}" for c in _present(cols, fixed.PROFILE_CATEGORICAL)]
    return "\nUNION ALL\n".join(parts) if parts else None


def _money(c: str) -> str:
    return tdbl(f"regexp_replace(CAST({c} AS VARCHAR), '[$,]', '', 'g')")


def _numeric_ranges(src=LISTINGS) -> str | None:
    table, cols = src
    parts = [f"SELECT {_q(c)} AS column_name, {rnd(f'MIN({_money(c)})', 2)} AS min_value, "
             f"{rnd(f'MAX({_money(c)})', 2)} AS max_value, {rnd(f'AVG({_money(c)})', 2)} AS mean_value, "
             f"COUNT(*) FILTER (WHERE {_money(c)} IS NULL) AS nulls FROM {table}"
             for c in _present(cols, fixed.PROFILE_NUMERIC)]
    return "\nUNION ALL\n".join(parts) if parts else None


def _klass(c: str) -> str:
    t = f"trim(CAST({c} AS VARCHAR))"
    return (f"CASE WHEN regexp_full_match({t}, '[+-]?\\d+') THEN 'integer' "
            f"WHEN regexp_full_match({t}, '{NUM}') THEN 'decimal' "
            f"WHEN regexp_full_match({t}, '{DATE}') THEN 'date' ELSE 'text' END")


CLASSES = ("integer", "decimal", "date", "text")


def _type_census(src=LISTINGS) -> str:
    table, cols = src
    rows = []
    for c in cols:
        k = _klass(c)
        counts = ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {k} = '{cls}') AS {cls}_values"
                           for cls in CLASSES)
        rows.append(f"SELECT {_q(c)} AS column_name, {counts} FROM {table}")
    body = "\nUNION ALL\n".join(rows)
    used = " + ".join(f"CAST({cls}_values > 0 AS INTEGER)" for cls in CLASSES)
    return f"SELECT *, ({used}) > 1 AS mixed FROM ({body})"


def _duplicates(src) -> str:
    table, cols = src
    return (f"SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows FROM ("
            f"SELECT COUNT(*) AS n FROM {table} GROUP BY {', '.join(cols)})")


def _profile(src, name: str, coverage_key: str | None = None) -> str:
    """Long-format report: (section, column_name, value, metric, amount)."""
    table, cols = src
    none = "CAST(NULL AS VARCHAR)"

    def rows(section, frm, column, value, metrics):
        return [f"SELECT {_q(section)} AS section, {column} AS column_name, {value} AS value, "
                f"{_q(m)} AS metric, CAST({m} AS DOUBLE) AS amount FROM ({frm})" for m in metrics]

    parts = rows("shape", f"SELECT COUNT(*) AS rows, {len(cols)} AS columns FROM {table}",
                 none, none, ["rows", "columns"])
    parts += rows("duplicates", _duplicates(src), none, none, ["duplicate_rows"])
    parts += rows("nulls", _null_census(0.0, src), "column_name", none, ["nulls", "null_pct"])
    vc = _value_counts(src)
    if vc:
        parts += rows("values", vc, "column_name", "value", ["n"])
        parts += rows("distinct", f"SELECT column_name, COUNT(value) AS distinct_values FROM ({vc}) "
                                  f"GROUP BY column_name", "column_name", none, ["distinct_values"])
    nr = _numeric_ranges(src)
    if nr:
        parts += rows("ranges", nr, "column_name", none, ["min_value", "max_value", "mean_value", "nulls"])
    parts += rows("types", f"SELECT * REPLACE (CAST(mixed AS INTEGER) AS mixed) FROM ({_type_census(src)})",
                  "column_name", none, [f"{c}_values" for c in CLASSES] + ["mixed"])
    if coverage_key:
        k = coverage_key
        parts += rows("coverage", f"SELECT {k}, COUNT(*) AS rows FROM {table} WHERE {k} IS NOT NULL "
                                  f"AND {k} NOT IN (SELECT city FROM city_dim) GROUP BY {k}",
                      _q(k), f"CAST({k} AS VARCHAR)", ["rows"])
    return "\nUNION ALL\n".join(parts)


def _row_gates() -> str:
    parts = ["SELECT 'raw_listings' AS table_name, COUNT(*) AS rows, CAST(1 AS BIGINT) AS min_rows FROM raw_listings",
             "SELECT 'raw_reviews', COUNT(*), CAST(1 AS BIGINT) FROM raw_reviews"]
    parts += [f"SELECT {_q(t)}, COUNT(*), CAST({n} AS BIGINT) FROM {t}" for t, n in fixed.GOLD_MIN_ROWS]
    return f"SELECT *, rows >= min_rows AS passed FROM ({' UNION ALL '.join(parts)})"


def _csv_field(f: str) -> str:
    """A text value as the CSV writer renders it: NULL empty, '' quoted, quotes doubled."""
    return (f"CASE WHEN {f} IS NULL THEN '' WHEN {f} = '' THEN '\"\"' "
            f"WHEN contains({f}, ',') OR contains({f}, '\"') OR contains({f}, chr(10)) "
            f"OR contains({f}, chr(13)) THEN '\"' || replace({f}, '\"', '\"\"') || '\"' ELSE {f} END")


def _rejects() -> str:
    from stratum.sources.binding import EXTRA_FIELD_EVERY, MISSING_FIELDS_EVERY
    cols = fixed.RAW_LISTING_COLUMNS
    extra = " || ',' || ".join([_csv_field(c) for c in cols] + ["'x'"])
    short = " || ',' || ".join(_csv_field(c) for c in cols[:-3])
    k = "CAST(listing_id AS BIGINT)"
    return (f"SELECT listing_id AS first_field, {extra} AS line FROM raw_listings_text "
            f"WHERE {k} % {EXTRA_FIELD_EVERY} = 0\nUNION ALL\n"
            f"SELECT listing_id AS first_field, {short} AS line FROM raw_listings_text "
            f"WHERE {k} % {MISSING_FIELDS_EVERY} = 0")


QUOTED_NAMES = """
  SELECT listing_id,
         CASE WHEN CAST(listing_id AS BIGINT) % 5 = 0
              THEN 'Caf' || chr(233) || ' "' || name || '"' || chr(10) || 'first, second'
              WHEN CAST(listing_id AS BIGINT) % 5 = 1 THEN 'Stra' || chr(223) || 'e ' || name
              ELSE name END AS name,
         amenities
  FROM raw_listings_text"""


def _repeated(table: str, key: str, every: int) -> str:
    return (f"(SELECT * FROM {table} UNION ALL SELECT * FROM {table} WHERE CAST({key} AS BIGINT) % {every} = 0)")


def _found() -> str:
    """Failures of the tests over the flawed tables, every test and list written out."""
    rows = _repeated("raw_listings_text", "listing_id", 9)
    token = lambda c: f"CASE WHEN {c} IN ('NA', 'NULL', 'null', '') THEN NULL ELSE {c} END"
    price = "TRY_CAST(price AS DOUBLE)"
    tables = {
        "b": f"SELECT {token('neighbourhood')} AS listing_id, {price} AS price_raw FROM {rows}",
        "s": (f"SELECT listing_id, city, {price} AS price_usd, {token('district')} AS price_category, "
              f"{token('host_response_time')} AS host_type, room_type AS stay_type, "
              f"substr(city, 1, 3) AS currency FROM {rows}"),
        "f": (f"SELECT city, room_type, COUNT(*) AS total_listings, AVG({price}) AS avg_price_usd "
              f"FROM {rows} GROUP BY city, room_type"),
    }
    cities = ("'Paris', 'New York', 'Bangkok', 'Rio de Janeiro', 'Sydney', 'Istanbul', 'Rome', "
              "'Hong Kong', 'Mexico City', 'Cape Town'")
    lists = {"city": cities, "price_category": "'Budget', 'Mid-range', 'Premium', 'Luxury'",
             "host_type": "'Superhost', 'Regular Host'", "stay_type": "'Flexible', 'Weekly', 'Monthly', 'Long Stay'",
             "currency": "'USD', 'EUR', 'AUD', 'THB', 'ZAR', 'MXN', 'TRY', 'HKD', 'BRL'"}
    tests = [(1, "b", "listing_id", "n"), (2, "b", "listing_id", "u"), (3, "b", "price_raw", "n"),
             (7, "s", "listing_id", "n"), (8, "s", "listing_id", "u"), (9, "s", "city", "n"), (10, "s", "city", "a"),
             (11, "s", "price_usd", "n"), (12, "s", "price_category", "n"), (13, "s", "price_category", "a"),
             (14, "s", "host_type", "n"), (15, "s", "host_type", "a"), (16, "s", "stay_type", "n"),
             (17, "s", "stay_type", "a"), (18, "s", "currency", "n"), (19, "s", "currency", "a"),
             (25, "f", "city", "n"), (26, "f", "city", "u"), (27, "f", "total_listings", "n"),
             (28, "f", "avg_price_usd", "n")]
    model = {"b": "bronze_listings", "s": "silver_listings", "f": "fct_revenue_by_city"}
    kind = {"n": "not_null", "u": "unique", "a": "accepted_values"}
    out = []
    for i, t, c, k in tests:
        count = {"n": f"SELECT COUNT(*) FROM ({tables[t]}) WHERE {c} IS NULL",
                 "u": f"SELECT COUNT(*) FROM (SELECT {c} FROM ({tables[t]}) WHERE {c} IS NOT NULL "
                      f"GROUP BY {c} HAVING COUNT(*) > 1)",
                 "a": f"SELECT COUNT(DISTINCT {c}) FROM ({tables[t]}) WHERE {c} NOT IN ({lists.get(c, 'NULL')})"}[k]
        out.append(f"SELECT CAST({i} AS INTEGER) AS test_id, '{model[t]}' AS model, '{c}' AS column_name, "
                   f"'{kind[k]}' AS test_name, CAST(({count}) AS BIGINT) AS failures")
    return "\nUNION ALL\n".join(out)


def _order() -> str:
    def part(name, src, keys, order):
        key = " || '|' || ".join(f"COALESCE(CAST({k} AS VARCHAR), '?')" for k in keys)
        return (f"SELECT '{name}' AS table_name, CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS position, "
                f"{key} AS key FROM ({src})")
    up = lambda *cols: ", ".join(f"{c} ASC NULLS FIRST" for c in cols)
    return "\nUNION ALL\n".join((
        part("fct_revenue_by_city", "SELECT * FROM fct_revenue_by_city", ["city", "total_listings"],
             f"total_listings DESC NULLS LAST, {up('city')}"),
        part("fct_superhost_performance", "SELECT * FROM fct_superhost_performance", ["city", "host_type"],
             f"{up('city')}, host_is_superhost DESC NULLS LAST, {up('host_type')}"),
        part("fct_seasonal_trends", "SELECT * FROM fct_seasonal_trends",
             ["city", "year_number", "month_number", "room_type", "price_category"],
             up("city", "year_number", "month_number", "room_type", "price_category")),
        part("fct_price_vs_rating", "SELECT * FROM fct_price_vs_rating",
             ["city", "price_category", "room_type", "property_type"],
             up("city", "price_category", "room_type", "property_type")),
        part("null_summary", _null_census(0.0), ["column_name", "nulls"],
             f"nulls DESC NULLS LAST, {up('column_name')}"),
        part("value_counts", _value_counts(), ["column_name", "n", "value"],
             f"{up('column_name')}, n DESC NULLS LAST, value ASC NULLS LAST")))


def _finals() -> dict[str, str]:
    return {
        "bronze_listings": _except("bronze_listings", "loaded_at"),
        "bronze_reviews_dedupe": _except("bronze_reviews", "loaded_at"),
        "bronze_reviews_table": _except("bronze_reviews", "loaded_at"),
        "silver_listings": _except("silver_listings", "loaded_at"),
        "silver_reviews": _except("silver_reviews", "loaded_at"),
        "silver_listings_view": _except("silver_listings", "loaded_at"),
        "silver_reviews_view": _except("silver_reviews", "loaded_at"),
        "fct_revenue_by_city": "SELECT * FROM fct_revenue_by_city",
        "fct_superhost_performance": "SELECT * FROM fct_superhost_performance",
        "fct_seasonal_trends": "SELECT * FROM fct_seasonal_trends",
        "fct_price_vs_rating": "SELECT * FROM fct_price_vs_rating",
        "years_active": (f"SELECT listing_id, host_since_date, CAST(year(DATE '{AS_OF}') - year(host_since_date) "
                         f"AS INTEGER) AS host_years_active FROM bronze_listings"),
        "null_tokens": "SELECT * FROM listings_tokens",
        "csv_load_good": "SELECT * FROM listings_tokens",
        "csv_load_rejects": _rejects(),
        "table_versions": (
            "SELECT v.version, v.room_type, v.listings, n.room_type IS NOT NULL AS newest FROM ("
            "SELECT 1 AS version, room_type, COUNT(*) AS listings FROM bronze_listings GROUP BY room_type UNION ALL "
            "SELECT 2, room_type, COUNT(*) FROM silver_listings GROUP BY room_type) v LEFT JOIN ("
            "SELECT room_type, COUNT(*) AS listings FROM silver_listings GROUP BY room_type) n "
            "ON n.room_type = v.room_type AND n.listings = v.listings"),
        "write_metrics": (
            "SELECT 'bronze_listings' AS table_name, COUNT(*) AS rows, 'price_raw' AS column_name, "
            "COUNT(*) FILTER (WHERE price_raw IS NULL) AS nulls FROM bronze_listings UNION ALL "
            "SELECT 'bronze_reviews', COUNT(*), 'review_date', COUNT(*) FILTER (WHERE review_date IS NULL) FROM bronze_reviews"),
        "build_stamps": (
            "SELECT 'fct_revenue_by_city' AS table_name, COUNT(*) AS rows, true AS stamped FROM fct_revenue_by_city UNION ALL "
            "SELECT 'fct_price_vs_rating', COUNT(*), true FROM fct_price_vs_rating UNION ALL "
            "SELECT 'fct_superhost_performance', COUNT(*), true FROM fct_superhost_performance"),
        "uncovered_keys": ("SELECT t.city, COUNT(*) AS rows FROM listings_tokens t "
                           "WHERE t.city IS NOT NULL AND t.city NOT IN (SELECT city FROM city_dim) "
                           "GROUP BY t.city"),
        "avg_ignore_zero": (f"SELECT city, {_avg_nz('review_scores_rating', 'avg_rating_nonzero')}, "
                            f"{rnd('AVG(review_scores_rating)', 2)} AS avg_rating_all, "
                            f"{_avg_nz('review_scores_value', 'avg_value_nonzero')} "
                            f"FROM silver_listings GROUP BY city"),
        "price_stats_median": f"SELECT room_type, {_price_stats()} FROM silver_listings GROUP BY room_type",
        "ratio_pct": (f"SELECT city, "
                      f"{pct('COUNT(DISTINCT CASE WHEN host_is_superhost THEN host_id END)', 'COUNT(DISTINCT host_id)')}"
                      f" AS superhost_host_pct, "
                      f"{pct('COUNT(*) FILTER (WHERE instant_bookable)', 'COUNT(*)')} AS instant_row_pct, "
                      f"{plain_ratio('COUNT(*)', 'COUNT(DISTINCT host_id)')} AS listings_per_host "
                      f"FROM silver_listings GROUP BY city"),
        "null_summary": _null_census(0.0),
        "null_rate_report": _null_census(fixed.NULL_RATE_REPORT_PCT),
        "duplicate_rows": _duplicates(REVIEWS),
        "profile_listings": _profile(LISTINGS, "listings", coverage_key="city"),
        "profile_states": _profile(LISTINGS, "listings", coverage_key="city"),
        "profile_reviews": _profile(REVIEWS, "reviews"),
        "value_counts": _value_counts(),
        "distinct_values": (f"SELECT column_name, COUNT(value) AS distinct_values FROM ({_value_counts()}) "
                            f"GROUP BY column_name"),
        "numeric_ranges": _numeric_ranges(),
        "type_census": _type_census(),
        "table_shape": (f"SELECT 'listings' AS table_name, COUNT(*) AS rows, "
                        f"{len(fixed.RAW_LISTING_COLUMNS)} AS columns FROM listings_tokens "
                        f"UNION ALL SELECT 'reviews', COUNT(*), {len(fixed.RAW_REVIEW_COLUMNS)} FROM reviews_tokens"),
        "not_null_tests": _data_tests("not_null"),
        "unique_tests": _data_tests("unique"),
        "accepted_values_tests": _data_tests("accepted_values"),
        "row_count_gates": _row_gates(),
        "reviews_csv_load": "SELECT *, '2025-01-01 06:00:00' AS loaded_at FROM reviews_tokens",
        "csv_quoted_breaks": QUOTED_NAMES,
        "csv_named_latin1": QUOTED_NAMES,
        "duplicate_rows_found": _duplicates((_repeated("reviews_tokens", "review_id", 7), fixed.RAW_REVIEW_COLUMNS)),
        "data_tests_found": _found(),
        "presentation_order": _order(),
    }


def oracle_sql() -> dict[str, str]:
    prefix = _prefix()
    return {name: prefix + body for name, body in _finals().items()}

"""The registered queries once more, as plain SQL over the given tables."""

from __future__ import annotations

from math import log2

from cartloom.operators.ranking import FEATURES, MISSING

# The three model tables and the two splits.
VIEWS = """
v_interactions AS (
  SELECT e.event_id AS interaction_id, e.user_id * 100 + (extract(day FROM e.ts) - 1) // 3 AS session_id,
    CAST(e.ts AS DATE) AS date, e.ts AS timestamp_local,
    CASE WHEN (e.user_id * 100 + (extract(day FROM e.ts) - 1) // 3) % 4 <> 0 THEN e.user_id END AS user_id,
    (c.c_nationkey + CASE WHEN e.event_id % 6 = 0 THEN 1 ELSE 0 END) % 25 AS country,
    CAST(regexp_extract(e.props, '[0-9]+', 0) AS BIGINT) AS partnumber,
    (e.user_id * 100 + (extract(day FROM e.ts) - 1) // 3) % 3 + 1 AS device_type,
    CASE WHEN e.event_id % 50 <> 0 THEN e.event_id % 5 + 1 END AS pagetype,
    CASE WHEN e.event_type = 'purchase' THEN 1 ELSE 0 END AS add_to_cart
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey),
train AS (SELECT * FROM v_interactions WHERE date < DATE '2024-01-25'),
test AS (SELECT * EXCLUDE (add_to_cart) FROM v_interactions WHERE date >= DATE '2024-01-25'),
v_users AS (
  SELECT o_custkey AS user_id, (c_nationkey + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) % 25 AS country,
    R, F, M
  FROM (SELECT o_custkey, o_orderstatus, date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-08-02') AS R,
          count(*) AS F, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS M
        FROM orders GROUP BY o_custkey, o_orderstatus)
  JOIN customer ON o_custkey = c_custkey),
v_products AS (
  SELECT p_partkey AS partnumber, CAST(regexp_extract(p_brand, '[0-9]+', 0) AS BIGINT) AS family,
    p_size % 10 AS color_id, CASE WHEN p_partkey % 9 <> 0 THEN p_type END AS cod_section,
    CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END AS discount,
    CASE WHEN p_partkey % 8 <> 3 THEN embedding END AS embedding
  FROM part LEFT JOIN embeddings ON p_partkey = vec_id)"""

USERS = """
one_user AS (
  SELECT user_id, country AS user_country, R, F, M FROM v_users
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY F DESC, R DESC, M DESC, country) = 1),
user_ratios AS (
  SELECT *, M / nullif(F, 0) AS avg_value_per_purchase, coalesce(F / nullif(R, 0), 0) AS purchase_rate,
    coalesce(M / nullif(R, 0), 0) AS spend_rate_per_day, M * F AS total_value_frequency,
    coalesce(R / nullif(F, 0), 0) AS avg_days_between_purchases FROM one_user),
user_countries AS (
  SELECT *, CAST(sum(CAST(M AS DECIMAL(20,6))) OVER c AS DOUBLE) / count(*) OVER c AS country_avg_monetary, avg(F) OVER c AS country_avg_frequency,
    avg(R) OVER c AS country_avg_recency, M / (CAST(sum(CAST(M AS DECIMAL(20,6))) OVER c AS DOUBLE) / count(*) OVER c) AS relative_monetary_value,
    F / avg(F) OVER c AS relative_frequency, R / avg(R) OVER c AS relative_recency
  FROM user_ratios WINDOW c AS (PARTITION BY user_country)),
user_marks AS (
  SELECT *, CAST(M > country_avg_monetary AS INT) AS is_high_value_incountry,
    CAST(F > country_avg_frequency AS INT) AS is_frequent_buyer_incountry,
    CAST(R > country_avg_recency AS INT) AS is_recent_customer_incountry,
    CAST(M > CAST(sum(CAST(M AS DECIMAL(20,6))) OVER () AS DOUBLE) / count(*) OVER () AS INT) AS is_high_value, CAST(F > avg(F) OVER () AS INT) AS is_frequent_buyer,
    CAST(R > avg(R) OVER () AS INT) AS is_recent_customer FROM user_countries),
user_ranked AS (
  SELECT *,
    rank() OVER (PARTITION BY user_country ORDER BY R DESC) + (count(*) OVER (PARTITION BY user_country, R) - 1) / 2 AS r_rank,
    rank() OVER (PARTITION BY user_country ORDER BY F DESC) + (count(*) OVER (PARTITION BY user_country, F) - 1) / 2 AS f_rank,
    rank() OVER (PARTITION BY user_country ORDER BY M DESC) + (count(*) OVER (PARTITION BY user_country, M) - 1) / 2 AS m_rank
  FROM user_marks),
rank_edges AS (
  SELECT quantile_cont(r_rank, [0.2, 0.4, 0.6, 0.8]) AS r, quantile_cont(f_rank, [0.2, 0.4, 0.6, 0.8]) AS f,
    quantile_cont(m_rank, [0.2, 0.4, 0.6, 0.8]) AS m FROM user_ranked),
user_fe AS (
  SELECT u.*, CAST(floor(r_rank) AS BIGINT) AS r_rank_in_country, CAST(floor(f_rank) AS BIGINT) AS f_rank_in_country,
    CAST(floor(m_rank) AS BIGINT) AS m_rank_in_country,
    1 + len(list_filter(list_distinct(e.r), lambda x: u.r_rank > x)) AS r_segment,
    1 + len(list_filter(list_distinct(e.f), lambda x: u.f_rank > x)) AS f_segment,
    1 + len(list_filter(list_distinct(e.m), lambda x: u.m_rank > x)) AS m_segment
  FROM user_ranked u, rank_edges e)"""

PRODUCTS = """
section_mode AS (
  SELECT family, cod_section AS mode_section FROM v_products WHERE cod_section IS NOT NULL
  GROUP BY family, cod_section
  QUALIFY row_number() OVER (PARTITION BY family ORDER BY count(*) DESC, cod_section) = 1),
product_sections AS (
  SELECT p.* EXCLUDE (cod_section), coalesce(p.cod_section, mode_section) AS cod_section
  FROM v_products p LEFT JOIN section_mode USING (family)),
product_stats AS (
  SELECT *, count(color_id) OVER (PARTITION BY family) AS color_family_frequency,
    avg(discount) OVER (PARTITION BY family) AS family_discount_rate,
    avg(discount) OVER (PARTITION BY cod_section) AS section_discount_rate,
    count(DISTINCT color_id) OVER (PARTITION BY family)
      + max(CASE WHEN color_id IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY family) AS family_unique_colors
  FROM product_sections),
family_parts AS (
  SELECT family, pos, avg(CAST(x AS DOUBLE)) AS m FROM (
    SELECT family, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos
    FROM v_products WHERE embedding IS NOT NULL) GROUP BY family, pos),
family_vectors AS (SELECT family, list(m ORDER BY pos) AS mean_embedding FROM family_parts GROUP BY family),
half_filled AS (
  SELECT p.partnumber, p.family, coalesce(CAST(p.embedding AS DOUBLE[]), f.mean_embedding) AS embedding
  FROM v_products p LEFT JOIN family_vectors f USING (family)),
overall_vector AS (
  SELECT list(m ORDER BY pos) AS v FROM (
    SELECT pos, avg(x) AS m FROM (
      SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM half_filled
      WHERE embedding IS NOT NULL) GROUP BY pos)),
filled AS (SELECT partnumber, family, coalesce(embedding, (SELECT v FROM overall_vector)) AS embedding FROM half_filled)"""

ROWS = """
imputed AS (
  SELECT interaction_id, session_id, timestamp_local, coalesce(user_id, -1) AS user_id, country, partnumber, device_type,
    coalesce(pagetype, (SELECT pagetype FROM train WHERE pagetype IS NOT NULL GROUP BY pagetype
                        ORDER BY count(*) DESC, pagetype LIMIT 1)) AS pagetype,
    add_to_cart, CASE WHEN user_id IS NULL THEN -1 ELSE 1 END AS known_user, 1 AS flag FROM train
  UNION ALL
  SELECT interaction_id, session_id, timestamp_local, coalesce(user_id, -1), country, partnumber, device_type,
    coalesce(pagetype, (SELECT pagetype FROM test WHERE pagetype IS NOT NULL GROUP BY pagetype
                        ORDER BY count(*) DESC, pagetype LIMIT 1)),
    NULL, CASE WHEN user_id IS NULL THEN -1 ELSE 1 END, 0 FROM test),
page_ratio AS (SELECT pagetype, avg(add_to_cart) AS page_cart_ratio FROM imputed WHERE flag = 1 GROUP BY pagetype),
device_ratio AS (SELECT device_type, avg(add_to_cart) AS device_cart_ratio FROM imputed WHERE flag = 1 GROUP BY device_type),
country_ratio AS (SELECT country, avg(add_to_cart) AS country_cart_ratio FROM imputed WHERE flag = 1 GROUP BY country),
with_ratios AS (
  SELECT i.*, coalesce(page_cart_ratio, -1) AS page_cart_ratio, device_cart_ratio, country_cart_ratio
  FROM imputed i LEFT JOIN page_ratio USING (pagetype) LEFT JOIN device_ratio USING (device_type)
    LEFT JOIN country_ratio USING (country)),
counted AS (
  SELECT *,
    sum(coalesce(add_to_cart, 0)) OVER u AS adds_so_far, count(*) OVER u AS rows_so_far
  FROM with_ratios WINDOW u AS (PARTITION BY user_id ORDER BY flag DESC, timestamp_local, interaction_id
                                ROWS UNBOUNDED PRECEDING)),
timed AS (
  SELECT *, lag(timestamp_local) OVER s AS ts_before, lead(timestamp_local) OVER s AS ts_after,
    min(timestamp_local) OVER (PARTITION BY session_id) AS ts_first, max(timestamp_local) OVER (PARTITION BY session_id) AS ts_last,
    count(*) OVER (PARTITION BY session_id) AS total_session_interactions
  FROM counted WINDOW s AS (PARTITION BY session_id ORDER BY timestamp_local, interaction_id)),
row_fe AS (
  SELECT interaction_id, session_id, timestamp_local, user_id, country, partnumber, device_type, pagetype, add_to_cart,
    known_user, flag, page_cart_ratio, coalesce(device_cart_ratio, 0) AS device_cart_ratio,
    coalesce(country_cart_ratio, 0) AS country_cart_ratio,
    CASE WHEN known_user = -1 THEN -1 WHEN add_to_cart IS NULL THEN 0 ELSE adds_so_far END AS user_previous_cart_additions,
    CASE WHEN known_user = -1 THEN -1 ELSE rows_so_far END AS user_previous_interactions,
    coalesce((date_diff('microsecond', ts_before, timestamp_local) + 50000) // 100000 / 10.0, 0) AS seconds_since_last_interaction,
    (date_diff('microsecond', ts_first, ts_last) + 50000) // 100000 / 10.0 AS total_session_time,
    coalesce((date_diff('microsecond', timestamp_local, ts_after) + 50000) // 100000 / 10.0, 0) AS interaction_length,
    total_session_interactions, extract(day FROM timestamp_local) AS day_number,
    extract(isodow FROM timestamp_local) AS weekday_number, extract(hour FROM timestamp_local) AS hour,
    CASE WHEN extract(hour FROM timestamp_local) BETWEEN 6 AND 11 THEN 0
      WHEN extract(hour FROM timestamp_local) BETWEEN 12 AND 17 THEN 1
      WHEN extract(hour FROM timestamp_local) >= 18 THEN 2 ELSE 3 END AS day_frame
  FROM timed),
train_fe AS (
  SELECT *, row_number() OVER (PARTITION BY session_id, partnumber ORDER BY timestamp_local, interaction_id)
    AS product_interaction_count FROM row_fe WHERE flag = 1),
test_fe AS (SELECT * FROM row_fe WHERE flag = 0)"""

CANDIDATES = """
universe AS (SELECT partnumber FROM train UNION SELECT partnumber FROM test),
cand_global AS (
  SELECT partnumber, count(add_to_cart) AS score FROM train GROUP BY partnumber ORDER BY score DESC, partnumber LIMIT 10),
cand_country AS (
  SELECT country, partnumber, sum(add_to_cart) AS total_add_to_cart FROM train GROUP BY country, partnumber
  QUALIFY row_number() OVER (PARTITION BY country ORDER BY sum(add_to_cart) DESC, partnumber) <= 5),
cand_user AS (
  SELECT user_id, partnumber, product_interaction_count, interaction_length,
    row_number() OVER (PARTITION BY user_id ORDER BY product_interaction_count DESC, interaction_length DESC, interaction_id) AS rank
  FROM train_fe WHERE user_id <> -1 AND add_to_cart = 0 QUALIFY rank <= 5),
own_vectors AS (SELECT partnumber, embedding FROM v_products SEMI JOIN universe USING (partnumber) WHERE embedding IS NOT NULL),
near AS (
  SELECT a.partnumber, b.partnumber AS neighbour,
    round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) AS cosine
  FROM own_vectors a, own_vectors b WHERE a.partnumber <> b.partnumber),
similar_items AS (
  SELECT partnumber, neighbour, row_number() OVER (PARTITION BY partnumber ORDER BY cosine DESC, neighbour) AS rank
  FROM near QUALIFY rank <= 5),
offers AS (
  SELECT DISTINCT session_id, g.partnumber, CAST(NULL AS BIGINT) AS country, CAST(NULL AS BIGINT) AS user_id, 'global' AS source
  FROM test_fe, cand_global g
  UNION ALL
  SELECT DISTINCT t.session_id, c.partnumber, t.country, NULL, 'country' FROM test_fe t JOIN cand_country c USING (country)
  UNION ALL
  SELECT DISTINCT t.session_id, c.partnumber, NULL, t.user_id, 'user' FROM test_fe t JOIN cand_user c USING (user_id)
  UNION ALL
  SELECT DISTINCT t.session_id, s.neighbour, NULL, NULL, 'similar' FROM test_fe t JOIN similar_items s USING (partnumber)),
made AS (SELECT DISTINCT session_id, partnumber, country, user_id FROM offers),
items AS (
  SELECT session_id, partnumber, max(country) AS country, max(user_id) AS user_id,
    string_agg(DISTINCT source, ',' ORDER BY source) AS sources
  FROM offers GROUP BY session_id, partnumber),
extended AS (
  SELECT * EXCLUDE (flag, add_to_cart), CAST(NULL AS BIGINT) AS synthetic_candidate FROM test_fe
  UNION ALL BY NAME
  SELECT *, 1 AS synthetic_candidate FROM made),
latest AS (
  SELECT * FROM test_fe QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY timestamp_local DESC, interaction_id DESC) = 1),
session_means AS (
  SELECT session_id, CAST(sum(CAST(seconds_since_last_interaction AS DECIMAL(20,6))) AS DOUBLE) / count(seconds_since_last_interaction) AS seconds_mean, CAST(sum(CAST(interaction_length AS DECIMAL(20,6))) AS DOUBLE) / count(interaction_length) AS length_mean,
    max(known_user) AS known_user, max(page_cart_ratio) AS page_cart_ratio, max(device_cart_ratio) AS device_cart_ratio,
    max(country_cart_ratio) AS country_cart_ratio, max(user_previous_cart_additions) AS user_previous_cart_additions,
    max(user_previous_interactions) AS user_previous_interactions,
    max(total_session_interactions) AS total_session_interactions
  FROM test_fe GROUP BY session_id),
done AS (
  SELECT e.interaction_id, e.session_id, coalesce(e.timestamp_local, l.timestamp_local) AS timestamp_local,
    coalesce(e.user_id, l.user_id) AS user_id, coalesce(e.country, l.country) AS country, e.partnumber,
    coalesce(e.device_type, l.device_type) AS device_type, coalesce(e.pagetype, l.pagetype) AS pagetype,
    coalesce(e.total_session_time, l.total_session_time) AS total_session_time,
    coalesce(e.day_number, l.day_number) AS day_number, coalesce(e.weekday_number, l.weekday_number) AS weekday_number,
    coalesce(e.hour, l.hour) AS hour, coalesce(e.day_frame, l.day_frame) AS day_frame,
    coalesce(e.seconds_since_last_interaction, m.seconds_mean) AS seconds_since_last_interaction,
    coalesce(e.interaction_length, m.length_mean) AS interaction_length,
    coalesce(e.known_user, m.known_user) AS known_user, coalesce(e.page_cart_ratio, m.page_cart_ratio) AS page_cart_ratio,
    coalesce(e.device_cart_ratio, m.device_cart_ratio) AS device_cart_ratio,
    coalesce(e.country_cart_ratio, m.country_cart_ratio) AS country_cart_ratio,
    coalesce(e.user_previous_cart_additions, m.user_previous_cart_additions) AS user_previous_cart_additions,
    coalesce(e.user_previous_interactions, m.user_previous_interactions) AS user_previous_interactions,
    coalesce(e.total_session_interactions, m.total_session_interactions) AS total_session_interactions,
    e.synthetic_candidate
  FROM extended e LEFT JOIN latest l USING (session_id) LEFT JOIN session_means m USING (session_id))"""

POPULARITY = """
popularity AS (SELECT partnumber, count(*) AS score, sum(add_to_cart) AS adds FROM train GROUP BY partnumber),
scored AS (
  SELECT t.session_id, t.partnumber, t.interaction_id, t.add_to_cart, p.score,
    CASE WHEN p.adds * 5 >= p.score THEN 1 ELSE 0 END AS prediction
  FROM train t JOIN popularity p USING (partnumber))"""

PARTS = {
    "views": VIEWS, "users": USERS, "products": PRODUCTS, "rows": ROWS, "candidates": CANDIDATES,
    "popularity": POPULARITY,
}

CASTS = {
    "i": "CAST({c} AS BIGINT)",
    "d": "CAST(CAST({c} AS DECIMAL(38,6)) AS DOUBLE)",
    "s": "CAST({c} AS VARCHAR)",
    "t": "CAST({c} AS TIMESTAMP)",
    "a": "CAST({c} AS DATE)",
}


def statement(parts: str, columns: list[tuple[str, str]], body: str) -> str:
    """WITH <parts> around `body`, its columns cast to the kinds the query returns."""
    ctes = ",".join(PARTS[p] for p in parts.split())
    shown = ", ".join(f"{CASTS[kind].format(c=name)} AS {name}" for name, kind in columns)
    return f"WITH {ctes}\nSELECT {shown} FROM (\n{body}\n) AS answer"


# Discount of the places 1..5, summed up: entry i holds places 1..i.
_UPTO = [sum(1 / log2(j + 1) for j in range(1, i + 1)) for i in range(6)]
_PLACES = "[" + ", ".join(f"{x!r}::DOUBLE" for x in _UPTO) + "]"

Q1 = """SELECT partnumber FROM v_products WHERE color_id = 3 AND discount = 1 ORDER BY family, partnumber LIMIT 1"""
Q2 = """SELECT user_id FROM v_users WHERE country = (
  SELECT country FROM v_users WHERE M < 500000 GROUP BY country ORDER BY {size} DESC, country LIMIT 1)
ORDER BY F, R DESC, user_id LIMIT 1"""
Q3_ROWS = """SELECT session_id, partnumber,
  sum(add_to_cart) OVER (PARTITION BY session_id, partnumber ORDER BY timestamp_local, interaction_id ROWS UNBOUNDED PRECEDING) AS adds,
  max(add_to_cart) OVER (PARTITION BY session_id, partnumber) AS added
FROM train WHERE partnumber IN (SELECT partnumber FROM train WHERE add_to_cart = 1)"""
Q4 = """SELECT device_type, count(*) AS count FROM train JOIN v_products USING (partnumber)
WHERE add_to_cart = 1 AND discount = 1 GROUP BY device_type"""
Q5 = """SELECT user_id FROM train WHERE device_type = 3 AND user_id IN (
  SELECT user_id FROM v_users
  QUALIFY row_number() OVER (PARTITION BY country ORDER BY F DESC, user_id, R DESC, M DESC) <= 3)
GROUP BY user_id ORDER BY count(DISTINCT partnumber) DESC, user_id LIMIT 1"""
Q6 = """SELECT count(DISTINCT family) AS unique_families FROM train t
JOIN v_users u ON t.user_id = u.user_id AND t.country <> u.country JOIN v_products p ON p.partnumber = t.partnumber"""
Q7 = """SELECT family, pagetype FROM train LEFT JOIN v_products USING (partnumber)
WHERE timestamp_local BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-07' AND add_to_cart = 1
GROUP BY family, pagetype
QUALIFY row_number() OVER (PARTITION BY family ORDER BY count(*) DESC, pagetype NULLS FIRST) = 1"""
METRICS = """SELECT user_id, session_id,
  (date_diff('microsecond', min(timestamp_local), max(timestamp_local)) + 5000) // 10000 / 100.0 AS total_session_time,
  round_even(100.0 * sum(add_to_cart) / count(*), 2) AS cart_addition_ratio
FROM v_interactions WHERE {users} GROUP BY user_id, session_id"""
VECTOR = "SELECT partnumber, {pos} AS pos, {value} AS value FROM {source}"
SCORED_OFFERS = """SELECT session_id, partnumber, max(coalesce(score, 0)) AS score FROM (
  SELECT session_id, partnumber FROM test_fe UNION ALL SELECT session_id, partnumber FROM items)
LEFT JOIN popularity USING (partnumber) GROUP BY session_id, partnumber"""
TOP5 = f"""SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY score DESC, partnumber) AS rank
FROM ({SCORED_OFFERS}) QUALIFY rank <= 5"""
NDCG = f"""SELECT session_id, CASE WHEN pos > 0 THEN dcg / {_PLACES}[least(pos, 5) + 1] ELSE 0 END AS ndcg FROM (
  SELECT session_id, CAST(sum(gain) AS BIGINT) AS pos,
    sum(gain / n * ({_PLACES}[least(done, 5) + 1] - {_PLACES}[least(done - n, 5) + 1])) AS dcg
  FROM (SELECT session_id, score, count(*) AS n, sum(add_to_cart) AS gain,
          CAST(sum(count(*)) OVER (PARTITION BY session_id ORDER BY score DESC) AS BIGINT) AS done
        FROM scored GROUP BY session_id, score)
  GROUP BY session_id)"""
DRAW = "md5(concat({key}, '|23'))"


def _per_column(names: list[str], line: str, source: str) -> str:
    return "\nUNION ALL ".join(f"SELECT '{n}' AS column_name, {line.format(c=n)} FROM {source}" for n in names)


TRAIN_COLUMNS = [
    "interaction_id", "session_id", "date", "timestamp_local", "user_id", "country", "partnumber",
    "device_type", "pagetype", "add_to_cart",
]
NUMBERS = [c for c in TRAIN_COLUMNS if c not in ("date", "timestamp_local")]
SUMMARY = (
    "count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS q25, "
    "quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max"
)

# key -> (parts, SQL body)
Q3 = f"""SELECT round(CAST(avg(n) AS DECIMAL(18,6)), 2) AS average_previous_visits
FROM (SELECT partnumber, count(*) AS n FROM ({Q3_ROWS}) WHERE adds = 0 GROUP BY partnumber)"""
ASSEMBLED = """SELECT * FROM train_fe
LEFT JOIN (SELECT * EXCLUDE (embedding) FROM product_stats) USING (partnumber) LEFT JOIN user_fe USING (user_id)"""
# The model matrix: nulls are -1, the section is its place in the alphabet (null behind all), then three flags.
MATRIX = ", ".join(
    "section_place" if c == "cod_section" else f"coalesce(CAST({c} AS DOUBLE), -1.0)" for c in FEATURES
) + "".join(f", CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END" for c in MISSING.values())

BODIES: dict[str, tuple[str, str]] = {
    # analytic questions
    "q1_lowest_family_product": ("views", Q1),
    "q1_global_min_family": ("views", """SELECT partnumber FROM v_products WHERE color_id = 3 AND discount = 1
AND family = (SELECT min(family) FROM v_products) ORDER BY partnumber LIMIT 1"""),
    "q1_sql_text": ("views", """SELECT min(partnumber) AS partnumber FROM v_products WHERE color_id = 3 AND discount = 1
AND family = (SELECT min(family) FROM v_products) HAVING count(*) > 0"""),
    "q2_least_frequent_user": ("views", Q2.format(size="count(*)")),
    "q2_distinct_users": ("views", Q2.format(size="count(DISTINCT user_id)")),
    "q3_avg_visits_before_add": ("views", Q3),
    "q3_visits_per_added_group": ("views", f"""SELECT round(CAST(avg(n) AS DECIMAL(18,6)), 2) AS average_previous_visits
FROM (SELECT session_id, partnumber, count(*) FILTER (WHERE adds = 0) AS n FROM ({Q3_ROWS}) WHERE added = 1
      GROUP BY session_id, partnumber)"""),
    "q4_device_counts": ("views", Q4),
    "q4_top_device": ("views", f"SELECT device_type FROM ({Q4}) ORDER BY count DESC, device_type LIMIT 1"),
    "q5_top_user": ("views", Q5),
    "q5_top_frequency_users": ("views", """SELECT user_id, country, F,
row_number() OVER (PARTITION BY country ORDER BY F DESC, user_id, R DESC, M DESC) AS rank_in_country
FROM v_users QUALIFY rank_in_country <= 3"""),
    "q6_families_outside_home": ("views", Q6),
    "q7_top_pagetype": ("views", Q7),
    "answers": ("views", f"""SELECT query, key, CAST(value AS VARCHAR) AS value FROM (
SELECT 'query_1' AS query, 'partnumber' AS key, CAST(partnumber AS BIGINT) AS value FROM ({Q1})
UNION ALL SELECT 'query_2', 'user_id', user_id FROM ({Q2.format(size="count(*)")})
UNION ALL SELECT 'query_4', 'device_type', device_type FROM (SELECT device_type FROM ({Q4}) ORDER BY count DESC, device_type LIMIT 1)
UNION ALL SELECT 'query_5', 'user_id', user_id FROM ({Q5})
UNION ALL SELECT 'query_6', 'unique_families', unique_families FROM ({Q6})
UNION ALL SELECT 'query_7', CAST(family AS VARCHAR), pagetype FROM ({Q7}))
UNION ALL SELECT 'query_3', 'average_previous_visits', CAST(CAST(average_previous_visits AS DOUBLE) AS VARCHAR) FROM ({Q3})"""),
    "csv_round_trip": ("views", "SELECT * FROM train"),
    "parquet_projection": ("views", "SELECT session_id, partnumber FROM train"),
    "merged_batches": ("views", "SELECT user_id, country, R, F, M FROM v_users"),
    "merged_batches_incremental": ("views", "SELECT user_id, country, R, F, M FROM v_users"),
    "session_metrics_streamed": ("views", METRICS.format(users="user_id IS NOT NULL")),
    "session_metrics": ("views", METRICS.format(users="user_id IS NOT NULL")),
    "session_metrics_user": ("views", METRICS.format(users="user_id = 7")),
    # users
    "users_dedup": ("views users", "SELECT * FROM one_user"),
    "user_ratio_features": ("views users", "SELECT * FROM user_ratios"),
    "user_country_features": ("views users", "SELECT * FROM user_countries"),
    "user_flags": ("views users", "SELECT * FROM user_marks"),
    "rfm_ranks": ("views users", "SELECT * FROM user_fe"),
    "rfm_segments": ("views users", "SELECT * FROM user_fe"),
    "rfm_segments_by_country": ("views users", """SELECT u.user_id,
1 + len(list_filter(list_distinct(e.r), lambda x: u.r_rank > x)) AS r_segment,
1 + len(list_filter(list_distinct(e.f), lambda x: u.f_rank > x)) AS f_segment,
1 + len(list_filter(list_distinct(e.m), lambda x: u.m_rank > x)) AS m_segment
FROM user_ranked u JOIN (
  SELECT user_country, quantile_cont(r_rank, [0.2, 0.4, 0.6, 0.8]) AS r, quantile_cont(f_rank, [0.2, 0.4, 0.6, 0.8]) AS f,
    quantile_cont(m_rank, [0.2, 0.4, 0.6, 0.8]) AS m FROM user_ranked GROUP BY user_country) e USING (user_country)"""),
    "user_record_rows": ("views", "SELECT user_id, country, R, F, M FROM v_users"),
    "user_record_recent": ("views", """SELECT user_id, country, R, F, M FROM v_users
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY R, F, M, country) = 1"""),
    # products
    "product_universe": ("views", """SELECT partnumber, family, color_id, cod_section, discount FROM v_products
WHERE partnumber IN (SELECT partnumber FROM train UNION SELECT partnumber FROM test)"""),
    "product_section_impute": ("views products", "SELECT partnumber, cod_section FROM product_sections"),
    "product_embedding_impute": ("views products", "SELECT partnumber, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding) AS value FROM filled"),
    "product_norm": ("views", """SELECT partnumber, generate_subscripts(embedding, 1) - 1 AS pos,
unnest(list_transform(embedding, lambda x: CAST(x AS DOUBLE) / sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))))) AS value
FROM v_products WHERE embedding IS NOT NULL"""),
    "product_features": ("views products", "SELECT * FROM product_stats"),
    # interactions
    "interactions_cast": ("views", "SELECT * FROM train"),
    "interactions_imputed": ("views rows", "SELECT * FROM imputed"),
    "cart_ratios": ("views rows", "SELECT * FROM with_ratios"),
    "user_running_counts": ("views rows", "SELECT * FROM row_fe"),
    "user_running_counts_strict": ("views rows", """SELECT interaction_id,
CASE WHEN known_user = -1 THEN -1 ELSE adds_so_far - coalesce(add_to_cart, 0) END AS user_previous_cart_additions,
CASE WHEN known_user = -1 THEN -1 ELSE rows_so_far - 1 END AS user_previous_interactions FROM counted"""),
    "session_time_features": ("views rows", "SELECT * FROM row_fe WHERE flag = 1"),
    "calendar_features": ("views rows", "SELECT * FROM row_fe WHERE flag = 1"),
    "session_size": ("views rows", "SELECT * FROM row_fe WHERE flag = 1"),
    "session_size_bucketed": ("views rows", "SELECT * FROM row_fe WHERE flag = 1"),
    "product_touch_index": ("views rows", "SELECT * FROM train_fe"),
    "train_features": ("views rows", "SELECT * FROM train_fe"),
    "assembled_train": ("views users products rows", ASSEMBLED),
    "feature_matrix": ("views users products rows", f"""SELECT interaction_id, unnest(range({len(FEATURES) + len(MISSING)})) AS pos,
unnest([{MATRIX}]) AS value
FROM (SELECT *, CAST(dense_rank() OVER (ORDER BY cod_section NULLS LAST) - 1 AS DOUBLE) AS section_place FROM ({ASSEMBLED}))"""),
    # similarity
    "top_k_similar": ("views products", """SELECT partnumber, neighbour, cosine, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY partnumber ORDER BY cosine DESC, neighbour) AS rank FROM (
    SELECT a.partnumber, b.partnumber AS neighbour, round(list_cosine_similarity(a.embedding, b.embedding), 9) AS cosine
    FROM filled a, filled b WHERE a.partnumber <> b.partnumber)) WHERE rank <= 10"""),
    "similar_exploded": ("views rows candidates", "SELECT partnumber, neighbour, 1 AS synthetic_candidate FROM similar_items"),
    "cosine_pairs": ("views", """SELECT a.rep AS partnumber_a, b.rep AS partnumber_b, a.copies AS copies_a, b.copies AS copies_b,
  round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) AS cosine
FROM (SELECT embedding, min(partnumber) AS rep, count(*) AS copies FROM v_products WHERE embedding IS NOT NULL GROUP BY embedding) a
JOIN (SELECT embedding, min(partnumber) AS rep, count(*) AS copies FROM v_products WHERE embedding IS NOT NULL GROUP BY embedding) b
  ON a.rep < b.rep AND round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) >= 0.3"""),
    # candidates
    "cand_global": ("views rows candidates", "SELECT * FROM cand_global"),
    "cand_country": ("views rows candidates", "SELECT * FROM cand_country"),
    "cand_known_user": ("views rows candidates", "SELECT * FROM cand_user"),
    "cand_similar": ("views rows candidates", "SELECT session_id, partnumber FROM offers WHERE source = 'similar'"),
    "test_extended": ("views rows candidates", "SELECT * FROM extended"),
    "test_extended_items": ("views rows candidates", "SELECT * FROM items"),
    "candidates_filled": ("views rows candidates", "SELECT * FROM done"),
    "fill_session_nulls": ("views rows candidates", "SELECT * FROM done"),
    "test_features": ("views rows candidates", """SELECT *, row_number() OVER (PARTITION BY session_id, partnumber
  ORDER BY coalesce(synthetic_candidate, 0) DESC, timestamp_local DESC, interaction_id DESC, country NULLS FIRST, user_id NULLS FIRST)
  AS product_interaction_count FROM done"""),
    "test_touch_index_by_time": ("views rows candidates", """SELECT *, row_number() OVER (PARTITION BY session_id, partnumber
  ORDER BY coalesce(synthetic_candidate, 0), timestamp_local, interaction_id, country NULLS FIRST, user_id NULLS FIRST)
  AS product_interaction_count FROM done"""),
    # learning
    "sessions_min_adds": ("views", """SELECT * FROM train WHERE session_id IN (
  SELECT session_id FROM train GROUP BY session_id HAVING sum(add_to_cart) >= 5)"""),
    "downsample": ("views", f"""SELECT interaction_id, add_to_cart FROM train WHERE add_to_cart = 1
UNION ALL SELECT interaction_id, add_to_cart FROM (
  SELECT interaction_id, add_to_cart, row_number() OVER (ORDER BY {DRAW.format(key="interaction_id")}, interaction_id) AS n
  FROM train WHERE add_to_cart = 0)
WHERE n <= (SELECT floor(count(*) * CAST(1.5 AS DOUBLE)) FROM train WHERE add_to_cart = 1)"""),
    "random_rows": ("views", f"""SELECT interaction_id, partnumber FROM train
QUALIFY row_number() OVER (ORDER BY {DRAW.format(key="interaction_id")}, interaction_id) <= 500"""),
    "first_rows": ("views", "SELECT interaction_id, partnumber FROM train ORDER BY interaction_id LIMIT 500"),
    "timestamps_parsed": ("views", "SELECT interaction_id, timestamp_local FROM train"),
    "session_holdout": ("views", f"""SELECT session_id, CASE WHEN n <= floor(total * CAST(0.1 AS DOUBLE)) THEN 1 ELSE 0 END AS held FROM (
  SELECT session_id, row_number() OVER (ORDER BY {DRAW.format(key="session_id")}, session_id) AS n, count(*) OVER () AS total
  FROM (SELECT DISTINCT session_id FROM train))"""),
    "group_folds": ("views", f"""SELECT interaction_id, CAST('0x' || substr({DRAW.format(key="session_id")}, 1, 8) AS BIGINT) % 5 AS fold FROM train"""),
    "strat_folds": ("views", f"""SELECT session_id, adds,
  (row_number() OVER (PARTITION BY adds ORDER BY {DRAW.format(key="session_id")}, session_id) - 1) % 5 AS fold
FROM (SELECT session_id, sum(add_to_cart) AS adds FROM train GROUP BY session_id)"""),
    "group_sizes": ("views", "SELECT session_id, count(*) AS rows FROM train GROUP BY session_id"),
    "session_ndcg": ("views popularity", NDCG),
    "ndcg_at_5": ("views popularity", f"SELECT avg(ndcg) AS ndcg, count(*) AS sessions FROM ({NDCG})"),
    "f1_score": ("views popularity", """SELECT tp, fp, fn, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM (
  SELECT count(*) FILTER (WHERE prediction = 1 AND add_to_cart = 1) AS tp,
    count(*) FILTER (WHERE prediction = 1 AND add_to_cart = 0) AS fp,
    count(*) FILTER (WHERE prediction = 0 AND add_to_cart = 1) AS fn FROM scored)"""),
    "recommend_top5": ("views rows candidates popularity", TOP5),
    "recommendation_json": ("views rows candidates popularity", f"""SELECT
  '{{"target":{{"' || session_id || '":[' || string_agg(CAST(partnumber AS VARCHAR), ',' ORDER BY rank) || ']}}}}' AS value
FROM ({TOP5}) GROUP BY session_id"""),
    # profiles
    "null_counts": ("views", _per_column(TRAIN_COLUMNS, "count(*) FILTER (WHERE {c} IS NULL) AS nulls", "train")),
    "distinct_counts": ("views", _per_column(
        TRAIN_COLUMNS, "count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS distinct_values", "train")),
    "split_overview": ("views", """SELECT 'train' AS split, count(DISTINCT session_id) AS sessions, count(DISTINCT partnumber) AS products,
  min(date) AS first_date, max(date) AS last_date FROM train
UNION ALL SELECT 'test', count(DISTINCT session_id), count(DISTINCT partnumber), min(date), max(date) FROM test"""),
    "key_overlap": ("views", """SELECT partnumber, CASE WHEN min(s) < max(s) THEN 'both' WHEN min(s) = 1 THEN 'train' ELSE 'test' END AS found_in
FROM (SELECT partnumber, 1 AS s FROM train UNION ALL SELECT partnumber, 2 FROM test) GROUP BY partnumber"""),
    "common_keys": ("views", "SELECT user_id FROM train INTERSECT SELECT user_id FROM test"),
    "test_only_keys": ("views", "SELECT session_id FROM test EXCEPT SELECT session_id FROM train"),
    "long_sessions": ("views", """SELECT session_id, count(user_id) AS rows FROM train
WHERE user_id IS NOT NULL AND pagetype IS NOT NULL GROUP BY session_id HAVING count(user_id) >= 5"""),
    "label_distribution": ("views", """SELECT add_to_cart, count(*) AS rows, count(*) / sum(count(*)) OVER () AS share,
  (SELECT count(*) FILTER (WHERE add_to_cart = 0) / count(*) FILTER (WHERE add_to_cart = 1) FROM train) AS negative_ratio
FROM train GROUP BY add_to_cart"""),
    "popularity_histogram": ("views popularity", """SELECT b.bin, lo + (hi - lo) * b.bin / 20 AS low, lo + (hi - lo) * (b.bin + 1) / 20 AS high,
  count(p.score) AS n
FROM (SELECT min(score) AS lo, max(score) AS hi FROM popularity WHERE score > 5), (SELECT unnest(range(20)) AS bin) b
LEFT JOIN (SELECT score, least(floor((score - l) / nullif(CAST(h - l AS DOUBLE), 0) * 20), 19) AS bin FROM popularity,
  (SELECT min(score) AS l, max(score) AS h FROM popularity WHERE score > 5) WHERE score > 5) p ON p.bin = b.bin
GROUP BY b.bin, lo, hi"""),
    "users_per_session": ("views", """SELECT users, count(*) AS sessions FROM (
  SELECT session_id, count(DISTINCT user_id) AS users FROM train WHERE user_id IS NOT NULL AND pagetype IS NOT NULL
  GROUP BY session_id) GROUP BY users"""),
    "numeric_summary": ("views", _per_column(NUMBERS, SUMMARY, "train")),
}

"""DuckDB oracle SQL for every SQL-checkable query of the catalog.

Each statement is self-contained: it rebuilds the fixture views from the
driver tables in a WITH clause, then computes the query in plain SQL.  The
SQL is written independently of the DataFrame code (joins on pairs of raters,
no probe trick), so agreement checks the plan, not a transcription of it.
Doubles are cast explicitly: a bare 0.8 is DECIMAL in DuckDB.
"""

from __future__ import annotations

FX = """
fx_ratings AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
         CAST(1 + floor((l.l_quantity - 1) / 10) AS DOUBLE) AS stars,
         CASE WHEN o.o_custkey % 37 = 0 OR l.l_partkey % 41 = 0 THEN 'test'
              WHEN o.o_custkey % 53 = 0 OR l.l_partkey % 59 = 0
                THEN CASE WHEN o.o_orderkey % 2 = 0 THEN 'val' ELSE 'test' END
              WHEN o.o_orderkey % 10 IN (0, 1) THEN 'test'
              WHEN o.o_orderkey % 10 = 2 THEN 'val'
              ELSE 'train' END AS split
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
train AS (SELECT user_id, item_id, stars FROM fx_ratings WHERE split = 'train'),
val AS (SELECT user_id, item_id, stars FROM fx_ratings WHERE split = 'val'),
r AS (SELECT user_id, item_id, max(stars) AS stars FROM train GROUP BY user_id, item_id),
tg AS (SELECT user_id, item_id, max(stars) AS label FROM fx_ratings WHERE split = 'test'
       GROUP BY user_id, item_id),
um AS (SELECT user_id, avg(stars) AS mean_stars, count(*) AS n FROM train GROUP BY user_id),
im AS (SELECT item_id, avg(stars) AS mean_stars, count(*) AS n FROM r GROUP BY item_id)
"""

USERS = """
fx_users AS (
  WITH s AS (SELECT user_id, count(*) AS n, avg(stars) AS m FROM fx_ratings GROUP BY user_id),
  e AS (SELECT user_id,
          count(CASE WHEN event_type = 'view' THEN 1 END) AS useful,
          count(CASE WHEN event_type = 'click' THEN 1 END) AS funny,
          count(CASE WHEN event_type = 'purchase' THEN 1 END) AS cool,
          count(CASE WHEN event_type = 'signup' THEN 1 END) AS fans
        FROM events GROUP BY user_id)
  SELECT c.c_custkey AS user_id, CAST(coalesce(s.n, 0) AS INT) AS review_count,
         coalesce(s.m, CAST(0.0 AS DOUBLE)) AS average_stars,
         CAST(coalesce(e.useful, 0) AS INT) AS useful, CAST(coalesce(e.funny, 0) AS INT) AS funny,
         CAST(coalesce(e.cool, 0) AS INT) AS cool, CAST(coalesce(e.fans, 0) AS INT) AS fans
  FROM customer c LEFT JOIN s ON s.user_id = c.c_custkey
                  LEFT JOIN e ON e.user_id = c.c_custkey
  WHERE c.c_custkey % 29 <> 0)
"""

ITEMS = """
fx_items AS (
  WITH s AS (SELECT item_id, count(*) AS n, avg(stars) AS m FROM fx_ratings GROUP BY item_id)
  SELECT p.p_partkey AS item_id, coalesce(s.m, CAST(0.0 AS DOUBLE)) AS stars,
         CAST(coalesce(s.n, 0) AS INT) AS review_count,
         CASE WHEN p.p_size % 4 = 0 THEN 0 ELSE 1 END AS is_open,
         CASE WHEN p.p_partkey % 17 = 0 THEN NULL
              WHEN p.p_partkey % 19 = 0 THEN ''
              ELSE concat_ws(', ', p.p_type, p.p_brand, replace(p.p_name, ' ', ', ')) END
           AS categories
  FROM part p LEFT JOIN s ON s.item_id = p.p_partkey
  WHERE p.p_partkey % 43 <> 0)
"""

# CF stages, in order; each CTE only uses the ones before it.
CF = """
routed AS (
  SELECT t.user_id, t.item_id, t.label, um.mean_stars AS user_mean,
         CASE WHEN um.user_id IS NOT NULL AND im.item_id IS NOT NULL THEN 'both'
              WHEN um.user_id IS NOT NULL THEN 'user_only'
              WHEN im.item_id IS NOT NULL THEN 'item_only'
              ELSE 'neither' END AS route
  FROM tg t LEFT JOIN um ON um.user_id = t.user_id LEFT JOIN im ON im.item_id = t.item_id),
cand AS (
  SELECT w.user_id, w.item_id, r.item_id AS neighbour_id, r.stars,
         least(w.item_id, r.item_id) AS item_i, greatest(w.item_id, r.item_id) AS item_j
  FROM routed w JOIN r ON r.user_id = w.user_id WHERE w.route = 'both'),
pairs AS (SELECT DISTINCT item_i, item_j FROM cand),
co AS (
  SELECT p.item_i, p.item_j, count(*) AS n_co,
         sum(1 - abs(a.stars - b.stars) / CAST(5 AS DOUBLE)) AS s_close,
         sum((a.stars - mi.mean_stars) * (b.stars - mj.mean_stars)) AS s_ij,
         sum((a.stars - mi.mean_stars) * (a.stars - mi.mean_stars)) AS ss_i,
         sum((b.stars - mj.mean_stars) * (b.stars - mj.mean_stars)) AS ss_j
  FROM pairs p
  JOIN r a ON a.item_id = p.item_i
  JOIN r b ON b.item_id = p.item_j AND b.user_id = a.user_id
  JOIN im mi ON mi.item_id = p.item_i JOIN im mj ON mj.item_id = p.item_j
  GROUP BY p.item_i, p.item_j),
pw0 AS (
  SELECT p.item_i, p.item_j, CAST(coalesce(co.n_co, 0) AS BIGINT) AS n_co,
         mi.mean_stars AS m_i, mj.mean_stars AS m_j, co.s_close, co.s_ij, co.ss_i, co.ss_j
  FROM pairs p JOIN im mi ON mi.item_id = p.item_i JOIN im mj ON mj.item_id = p.item_j
  LEFT JOIN co ON co.item_i = p.item_i AND co.item_j = p.item_j),
pw AS (
  SELECT item_i, item_j, n_co,
         CASE WHEN n_co = 0 THEN 1 - abs(m_i - m_j) / CAST(5 AS DOUBLE)
              WHEN n_co <= 2 THEN s_close / n_co
              WHEN sqrt(ss_i) = 0 OR sqrt(ss_j) = 0 THEN s_close / n_co
              ELSE s_ij / (sqrt(ss_i) * sqrt(ss_j)) END AS raw_w
  FROM pw0),
kept AS (
  SELECT item_i, item_j, n_co, raw_w, raw_w * pow(abs(raw_w), CAST(1.5 AS DOUBLE)) AS weight
  FROM pw
  WHERE CASE WHEN n_co = 0 THEN raw_w > CAST(0.8 AS DOUBLE)
             WHEN n_co = 1 THEN raw_w > CAST(0.6 AS DOUBLE)
             WHEN n_co = 2 THEN raw_w > CAST(0.7 AS DOUBLE)
             ELSE raw_w >= CAST(0.1 AS DOUBLE) END),
wn AS (
  SELECT c.user_id, c.item_id, c.neighbour_id, c.stars, k.n_co, k.raw_w, k.weight
  FROM cand c JOIN kept k ON k.item_i = c.item_i AND k.item_j = c.item_j),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, item_id
                               ORDER BY round(raw_w, 9) DESC, neighbour_id) AS rank
  FROM wn),
top AS (SELECT * FROM ranked WHERE rank <= 30),
sc AS (
  SELECT user_id, item_id, sum(weight * stars) AS num, sum(abs(weight)) AS den,
         count(*) AS n_neighbours
  FROM top GROUP BY user_id, item_id),
cfp AS (
  SELECT t.user_id, t.item_id, t.label,
         round(CASE WHEN t.route = 'both' THEN coalesce(sc.num / nullif(sc.den, 0), t.user_mean)
                    WHEN t.route = 'user_only' THEN t.user_mean
                    ELSE CAST(3.75 AS DOUBLE) END, 6) AS prediction,
         CASE WHEN t.route = 'both' THEN coalesce(sc.num / nullif(sc.den, 0), t.user_mean)
              WHEN t.route = 'user_only' THEN t.user_mean
              ELSE CAST(3.75 AS DOUBLE) END AS pred_raw,
         CAST(coalesce(sc.n_neighbours, 0) AS BIGINT) AS n_neighbours, t.route
  FROM routed t LEFT JOIN sc ON sc.user_id = t.user_id AND sc.item_id = t.item_id)
"""


def with_ctes(*blocks: str) -> str:
    return "WITH " + ",\n".join(b.strip() for b in blocks) + "\n"


def cf_sql(select: str) -> str:
    return with_ctes(FX, CF) + select


SQL: dict[str, str] = {}


def _add(key: str, sql: str) -> None:
    SQL[key] = sql.strip()


_add("ratings_scan", with_ctes(FX) + "SELECT user_id, item_id, stars, split FROM fx_ratings")
_add("split_counts", with_ctes(FX) +
     "SELECT split, count(*) AS n FROM fx_ratings GROUP BY split")
_add("train_val_union", with_ctes(FX) +
     "SELECT user_id, item_id, stars FROM train UNION ALL SELECT user_id, item_id, stars FROM val")
_add("ratings_dedup", with_ctes(FX) + "SELECT user_id, item_id, stars FROM r")
_add("user_mean", with_ctes(FX) +
     "SELECT user_id AS id, round(mean_stars, 6) AS mean_stars, n FROM um")
_add("item_mean", with_ctes(FX) +
     "SELECT item_id AS id, round(mean_stars, 6) AS mean_stars, n FROM im")
_add("targets_scan", with_ctes(FX) + "SELECT user_id, item_id, label FROM tg")
_add("cf_routes", cf_sql("SELECT route, count(*) AS n FROM routed GROUP BY route"))
_add("warm_targets", cf_sql("SELECT user_id, item_id FROM routed WHERE route = 'both'"))
_add("cold_targets", cf_sql("SELECT user_id, item_id FROM routed WHERE route <> 'both'"))
_add("candidate_neighbours", cf_sql("SELECT user_id, item_id, neighbour_id, stars FROM cand"))
_add("candidate_pairs", cf_sql("SELECT item_i, item_j FROM pairs"))
_add("pair_co_raters", cf_sql("SELECT item_i, item_j, n_co FROM pw0"))
_add("pair_co_raters_by_bitmap", cf_sql("SELECT item_i, item_j, n_co FROM pw0"))
_add("pair_closeness", cf_sql(
    "SELECT item_i, item_j, n_co, "
    "round(CASE WHEN n_co = 0 THEN 1 - abs(m_i - m_j) / CAST(5 AS DOUBLE) "
    "ELSE s_close / n_co END, 6) AS closeness FROM pw0 WHERE n_co <= 2"))
_add("pair_pearson", cf_sql(
    "SELECT pw.item_i, pw.item_j, pw.n_co, round(pw.raw_w, 6) AS raw_w, "
    "(sqrt(pw0.ss_i) = 0 OR sqrt(pw0.ss_j) = 0) AS fallback "
    "FROM pw JOIN pw0 ON pw0.item_i = pw.item_i AND pw0.item_j = pw.item_j WHERE pw.n_co >= 3"))
_add("pair_weight", cf_sql(
    "SELECT item_i, item_j, n_co, round(raw_w, 6) AS raw_w, round(weight, 6) AS weight FROM kept"))
_add("item_rater_bitmaps", with_ctes(FX) + """
  SELECT item_id, CAST(place // 64 AS INTEGER) AS word,
         bit_or(CASE place % 64 WHEN 63 THEN -9223372036854775808 ELSE CAST(1 AS BIGINT) << CAST(place % 64 AS INTEGER) END) AS bits
  FROM r JOIN (SELECT user_id, row_number() OVER (ORDER BY count(*) DESC, user_id) - 1 AS place FROM r GROUP BY user_id) u USING (user_id)
  GROUP BY 1, 2""")
_LATER = "(SELECT user_id, item_id, max(stars) AS stars FROM fx_ratings WHERE split IN ('train', 'val') GROUP BY user_id, item_id)"
_SUMS = f"""
  SELECT p.item_i, p.item_j, count(a.user_id) AS n_co, coalesce(sum(a.stars), 0.0) AS s_i, coalesce(sum(b.stars), 0.0) AS s_j,
         coalesce(sum(a.stars * a.stars), 0.0) AS q_i, coalesce(sum(b.stars * b.stars), 0.0) AS q_j,
         coalesce(sum(a.stars * b.stars), 0.0) AS p_ij, coalesce(sum(abs(a.stars - b.stars)), 0.0) AS d_ij
  FROM pairs p LEFT JOIN ({_LATER} a JOIN {_LATER} b ON a.user_id = b.user_id AND a.item_id <= b.item_id)
    ON p.item_i = a.item_id AND p.item_j = b.item_id GROUP BY p.item_i, p.item_j"""
_add("pair_sums_updated", cf_sql(_SUMS))
_add("pair_weight_updated", cf_sql(f"""
SELECT item_i, item_j, n_co, round(CASE WHEN n_co = 0 THEN 1 - abs(m_i - m_j) / CAST(5 AS DOUBLE)
    WHEN n_co <= 2 OR sqrt(ss_i) = 0 OR sqrt(ss_j) = 0 THEN s_close / n_co ELSE s_ij / (sqrt(ss_i) * sqrt(ss_j)) END, 6) AS raw_w
FROM (SELECT p.item_i, p.item_j, any_value(mi.m) AS m_i, any_value(mj.m) AS m_j, count(a.user_id) AS n_co,
             sum(1 - abs(a.stars - b.stars) / CAST(5 AS DOUBLE)) AS s_close, sum((a.stars - mi.m) * (b.stars - mj.m)) AS s_ij,
             sum((a.stars - mi.m) * (a.stars - mi.m)) AS ss_i, sum((b.stars - mj.m) * (b.stars - mj.m)) AS ss_j
      FROM pairs p JOIN (SELECT item_id, avg(stars) AS m FROM {_LATER} GROUP BY item_id) mi ON mi.item_id = p.item_i
      JOIN (SELECT item_id, avg(stars) AS m FROM {_LATER} GROUP BY item_id) mj ON mj.item_id = p.item_j
      LEFT JOIN ({_LATER} a JOIN {_LATER} b ON a.user_id = b.user_id AND a.item_id <= b.item_id) ON p.item_i = a.item_id AND p.item_j = b.item_id
      GROUP BY p.item_i, p.item_j) x"""))
_add("weighted_neighbours", cf_sql(
    "SELECT user_id, item_id, neighbour_id, round(weight, 6) AS weight, stars FROM wn"))
_add("topn_neighbours", cf_sql("SELECT user_id, item_id, rank, neighbour_id FROM top"))
_add("cf_predict", cf_sql(
    "SELECT user_id, item_id, prediction, n_neighbours, route FROM cfp"))
_add("cf_rmse", cf_sql(
    "SELECT count(*) AS n, round(sqrt(avg((prediction - label) * (prediction - label))), 6) AS rmse "
    "FROM cfp"))
_add("error_histogram", cf_sql("""
SELECT b.bucket, CAST(count(e.err) AS BIGINT) AS n
FROM (VALUES (0, '[0,1)'), (1, '[1,2)'), (2, '[2,3)'), (3, '[3,4)'), (4, '[4,inf)')) b(k, bucket)
LEFT JOIN (SELECT abs(prediction - label) AS err FROM cfp) e
  ON least(CAST(floor(e.err) AS BIGINT), 4) = b.k
GROUP BY b.bucket"""))
_add("prediction_lines", cf_sql(
    "SELECT concat_ws(',', CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR), "
    "CAST(prediction AS VARCHAR)) AS line FROM cfp"))

# ---------------------------------------------------------------- profiles, features
CATS = """
ic AS (
  SELECT DISTINCT item_id, category
  FROM (SELECT item_id, unnest(string_split(categories, ', ')) AS category
        FROM fx_items WHERE categories IS NOT NULL AND categories <> '') x),
vocab AS (
  SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS category_id
  FROM (SELECT DISTINCT category FROM ic) c),
iid AS (
  SELECT ic.item_id, count(*) AS n,
         string_agg(CAST(v.category_id AS VARCHAR), ',' ORDER BY v.category_id) AS ids
  FROM ic JOIN vocab v ON v.category = ic.category GROUP BY ic.item_id),
tv AS (SELECT user_id, item_id, stars, split FROM fx_ratings WHERE split IN ('train', 'val'))
"""

PROFILE = with_ctes(FX, USERS, ITEMS, CATS)

_add("item_profiles", with_ctes(FX, ITEMS) +
     "SELECT item_id, stars, review_count, is_open, categories FROM fx_items")
_add("user_profiles", with_ctes(FX, USERS) +
     "SELECT user_id, review_count, average_stars, useful, funny, cool, fans FROM fx_users")
_add("item_categories", PROFILE + "SELECT item_id, category FROM ic")
_add("category_vocab", PROFILE + "SELECT category, category_id FROM vocab")
_add("item_multi_hot", PROFILE + """
SELECT t.item_id, iid.n AS n_categories, iid.ids AS category_ids
FROM (SELECT DISTINCT item_id FROM tv) t LEFT JOIN iid ON iid.item_id = t.item_id""")
_add("item_multi_hot_filled", PROFILE + """
SELECT t.item_id, CAST(coalesce(iid.n, 0) AS BIGINT) AS n_categories,
       coalesce(iid.ids, '') AS category_ids
FROM (SELECT DISTINCT item_id FROM tv) t LEFT JOIN iid ON iid.item_id = t.item_id""")
_add("feature_rows", PROFILE + """
SELECT t.user_id, t.item_id, t.stars, t.split,
       u.review_count, u.average_stars, u.useful, u.funny, u.cool, u.fans,
       i.stars AS item_stars, i.review_count AS item_review_count, i.is_open,
       iid.n AS n_categories
FROM tv t LEFT JOIN fx_users u ON u.user_id = t.user_id
LEFT JOIN fx_items i ON i.item_id = t.item_id
LEFT JOIN iid ON iid.item_id = t.item_id""")
_add("first_occurrence", PROFILE + """
SELECT user_id, item_id AS first_item_id, stars AS first_stars
FROM (SELECT user_id, item_id, stars,
             row_number() OVER (PARTITION BY user_id
                                ORDER BY CASE split WHEN 'train' THEN 0 ELSE 1 END, item_id, stars) AS rn
      FROM tv) x
WHERE rn = 1""")
_add("first_occurrence_items", PROFILE + """
SELECT item_id, user_id AS first_user_id, stars AS first_stars
FROM (SELECT user_id, item_id, stars,
             row_number() OVER (PARTITION BY item_id
                                ORDER BY CASE split WHEN 'train' THEN 0 ELSE 1 END, user_id, stars) AS rn
      FROM tv) x
WHERE rn = 1""")
_add("first_by_position", PROFILE + """
SELECT user_id, item_id AS first_item_id, stars AS first_stars
FROM (SELECT user_id, item_id, stars,
             row_number() OVER (PARTITION BY user_id ORDER BY item_id DESC, stars) AS rn
      FROM tv) x
WHERE rn = 1""")
_add("user_history_rows", with_ctes(FX) + """
SELECT user_id AS id, item_id AS member, count(*) OVER (PARTITION BY user_id) AS n
FROM (SELECT DISTINCT user_id, item_id FROM train) d""")
_add("item_raters_rows", with_ctes(FX) + """
SELECT item_id AS id, user_id AS member, count(*) OVER (PARTITION BY item_id) AS n
FROM (SELECT DISTINCT user_id, item_id FROM train) d""")
_add("json_items", with_ctes(FX, ITEMS) + """
SELECT CAST(item_id AS VARCHAR) AS business_id, stars, CAST(review_count AS INTEGER) AS review_count,
       CAST(is_open AS INTEGER) AS is_open, categories FROM fx_items""")
_add("json_users", with_ctes(FX, USERS) + """
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(review_count AS INTEGER) AS review_count, average_stars,
       CAST(useful AS INTEGER) AS useful, CAST(funny AS INTEGER) AS funny, CAST(cool AS INTEGER) AS cool,
       CAST(fans AS INTEGER) AS fans FROM fx_users""")
_add("csv_ratings", with_ctes(FX) + """
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id, stars FROM fx_ratings""")
_add("csv_targets", with_ctes(FX) + """
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id FROM tg""")
_add("csv_repeated_headers", with_ctes(FX) + """
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id, stars FROM fx_ratings""")
_PLACED = with_ctes(FX) + """
, placed AS (SELECT row_number() OVER (ORDER BY user_id, item_id, stars) - 1 AS position, CAST(user_id AS VARCHAR) AS user_id,
                    CAST(item_id AS VARCHAR) AS item_id, stars FROM fx_ratings)"""
_add("split_at_row", _PLACED + """
SELECT position, user_id, item_id, stars,
       CASE WHEN position < (SELECT count(*) FROM placed) * 7 // 10 THEN 'train' ELSE 'val' END AS split FROM placed""")
_add("zip_by_position", _PLACED + "SELECT position, user_id, item_id, stars FROM placed")
_add("first_in_file_order", _PLACED + """
SELECT item_id, user_id AS first_user_id, stars AS first_stars FROM placed
WHERE position IN (SELECT min(position) FROM placed GROUP BY item_id)""")
_add("known_users", with_ctes(FX) + """
SELECT user_id AS id, bool_or(split = 'train') AS in_train, bool_or(split = 'val') AS in_val
FROM fx_ratings WHERE split IN ('train', 'val') GROUP BY user_id""")
_add("known_items", with_ctes(FX) + """
SELECT item_id AS id, bool_or(split = 'train') AS in_train, bool_or(split = 'val') AS in_val
FROM fx_ratings WHERE split IN ('train', 'val') GROUP BY item_id""")
_add("user_history", with_ctes(FX) + """
SELECT user_id AS id, count(*) AS n, min(item_id) AS min_id, max(item_id) AS max_id,
       CAST(sum(((item_id % 1000003) + 1000003) % 1000003) AS BIGINT) AS id_checksum
FROM (SELECT DISTINCT user_id, item_id FROM train) d GROUP BY user_id""")
_add("item_raters", with_ctes(FX) + """
SELECT item_id AS id, count(*) AS n, min(user_id) AS min_id, max(user_id) AS max_id,
       CAST(sum(((user_id % 1000003) + 1000003) % 1000003) AS BIGINT) AS id_checksum
FROM (SELECT DISTINCT user_id, item_id FROM train) d GROUP BY item_id""")

MODEL = """
ku AS (SELECT DISTINCT user_id FROM tv),
ki AS (SELECT DISTINCT item_id FROM tv),
mr AS (
  SELECT t.user_id, t.item_id, t.label,
         CASE WHEN ku.user_id IS NOT NULL AND ki.item_id IS NOT NULL THEN 'both'
              WHEN ku.user_id IS NOT NULL THEN 'user_only'
              WHEN ki.item_id IS NOT NULL THEN 'item_only'
              ELSE 'neither' END AS route
  FROM tg t LEFT JOIN ku ON ku.user_id = t.user_id LEFT JOIN ki ON ki.item_id = t.item_id),
tf AS (
  SELECT m.user_id, m.item_id, m.label, m.route,
         CASE WHEN m.route IN ('both', 'user_only') THEN u.review_count END AS review_count,
         CASE WHEN m.route IN ('both', 'user_only') THEN u.average_stars END AS average_stars,
         CASE WHEN m.route IN ('both', 'user_only') THEN u.useful END AS useful,
         CASE WHEN m.route IN ('both', 'user_only') THEN u.funny END AS funny,
         CASE WHEN m.route IN ('both', 'user_only') THEN u.cool END AS cool,
         CASE WHEN m.route IN ('both', 'user_only') THEN u.fans END AS fans,
         CASE WHEN m.route IN ('both', 'item_only') THEN i.stars END AS item_stars,
         CASE WHEN m.route IN ('both', 'item_only') THEN i.review_count END AS item_review_count,
         CASE WHEN m.route IN ('both', 'item_only') THEN i.is_open END AS is_open
  FROM mr m LEFT JOIN fx_users u ON u.user_id = m.user_id
  LEFT JOIN fx_items i ON i.item_id = m.item_id)
"""

_add("model_routes", with_ctes(FX, USERS, ITEMS, CATS, MODEL) + "SELECT route, count(*) AS n FROM mr GROUP BY route")
_add("target_features", with_ctes(FX, USERS, ITEMS, CATS, MODEL) + """
SELECT user_id, item_id, label, route, review_count, average_stars, useful, funny, cool, fans,
       item_stars, item_review_count, is_open FROM tf""")
_add("embed_by_rule", PROFILE + f"""
SELECT t.item_id, {", ".join(f"CAST(coalesce(sum((v.category_id * 7 + {3 * k}) % 11 - 5), 0) / 8.0 + {k / 8} AS DOUBLE) AS e{k}" for k in range(16))}
FROM (SELECT DISTINCT item_id FROM tv) t LEFT JOIN ic ON ic.item_id = t.item_id
LEFT JOIN vocab v ON v.category = ic.category GROUP BY t.item_id""")
_add("gbt_unscored_routes", with_ctes(FX, USERS, ITEMS, CATS, MODEL) + """
SELECT user_id, item_id, route,
       round(CASE route WHEN 'user_only' THEN coalesce(average_stars, CAST(3.75 AS DOUBLE))
                        WHEN 'item_only' THEN coalesce(item_stars, CAST(3.75 AS DOUBLE))
                        ELSE CAST(3.75 AS DOUBLE) END, 6) AS prediction
FROM tf WHERE route <> 'both'""")
_NAMES = ["review_count", "average_stars", "useful", "funny", "cool", "fans", "item_stars", "item_review_count", "is_open"]
_add("gbt_by_rule", with_ctes(FX, USERS, ITEMS, CATS, MODEL) + f"""
, forest AS (
  SELECT t, i, (t * 4 + i * 5) % 9 AS f, ((t * 7 + i * 13) % 48) / CAST(8 AS DOUBLE) AS threshold, (t + i) % 2 = 0 AS missing_left,
         ((t * 31 + i * 17) % 23 - 11) / CAST(16 AS DOUBLE) AS value
  FROM range(24) a(t), range(15) b(i)),
x AS (SELECT row_number() OVER () AS k, user_id, item_id, [{", ".join(f"CAST({c} AS DOUBLE)" for c in _NAMES)}] AS v FROM tf),
level0 AS (SELECT k, t, CAST(0 AS BIGINT) AS i FROM x, range(24) a(t)),
{",".join(f"""
level{d + 1} AS (
  SELECT l.k, l.t, CASE WHEN CASE WHEN x.v[f.f + 1] IS NULL THEN f.missing_left ELSE x.v[f.f + 1] < f.threshold END
                        THEN 2 * l.i + 1 ELSE 2 * l.i + 2 END AS i
  FROM level{d} l JOIN x ON x.k = l.k JOIN forest f ON f.t = l.t AND f.i = l.i)""" for d in range(3))}
SELECT x.user_id, x.item_id, sum(f.value) AS score
FROM level3 l JOIN x ON x.k = l.k JOIN forest f ON f.t = l.t AND f.i = l.i GROUP BY x.k, x.user_id, x.item_id""")
_add("hybrid_blend", with_ctes(FX, USERS, ITEMS, CATS, MODEL, CF) + """
, hb AS (
  SELECT tf.user_id, tf.item_id, tf.route, c.pred_raw AS cf, c.n_neighbours,
         CASE WHEN tf.route = 'both' THEN
           CASE WHEN c.n_neighbours < 30 THEN CAST(0.05 AS DOUBLE) ELSE CAST(0.15 AS DOUBLE) END
         END AS alpha,
         (coalesce(tf.average_stars, CAST(3.75 AS DOUBLE))
          + coalesce(tf.item_stars, CAST(3.75 AS DOUBLE))) / 2 AS model_all,
         tf.average_stars, tf.item_stars
  FROM tf LEFT JOIN cfp c ON c.user_id = tf.user_id AND c.item_id = tf.item_id)
SELECT user_id, item_id, round(cf, 6) AS cf, n_neighbours, alpha,
       round(CASE WHEN route = 'both' THEN model_all END, 6) AS model,
       round(CASE WHEN route = 'both' THEN alpha * cf + (1 - alpha) * model_all
                  WHEN route = 'user_only' THEN coalesce(average_stars, CAST(3.75 AS DOUBLE))
                  WHEN route = 'item_only' THEN coalesce(item_stars, CAST(3.75 AS DOUBLE))
                  ELSE CAST(3.75 AS DOUBLE) END, 6) AS prediction,
       route
FROM hb""")

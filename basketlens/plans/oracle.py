"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code, in the original's own shape: the
session features are three aggregates over the events joined back together,
the label a separate aggregate + left join.  Only the driver tables
``events`` and ``part`` are read.
"""

from __future__ import annotations

# raw -> clean -> categorized -> session features, shared by every oracle
_BASE = """
WITH ev AS (
  SELECT e.event_id, e.ts AS event_time,
         CASE WHEN e.event_type = 'click' THEN 'cart' ELSE e.event_type END AS event_type,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS product_id,
         e.value AS price, e.user_id, e.ts
  FROM events e
),
raw AS (
  SELECT ev.event_id, ev.event_time, ev.event_type, ev.product_id,
         CASE WHEN ev.product_id % 10 = 0 THEN NULL
              ELSE lower(p.p_type) || '.' || replace(p.p_name, ' ', '_') END AS category_code,
         ev.price, ev.user_id,
         CASE WHEN ev.product_id % 25 = 7 THEN NULL
              ELSE CAST(ev.user_id AS VARCHAR) || '-' || strftime(ev.ts, '%Y%m%d') END AS user_session
  FROM ev LEFT JOIN part p ON p.p_partkey = ev.product_id
),
clean AS (
  SELECT * FROM raw
  WHERE user_id IS NOT NULL AND user_session IS NOT NULL
    AND event_type IN ('view', 'cart', 'purchase')
),
cat AS (
  SELECT *, split_part(category_code, '.', 1) AS category_main
  FROM clean WHERE category_code IS NOT NULL
),
base AS (
  SELECT user_session,
         count(*) FILTER (WHERE event_type = 'view') AS num_views,
         count(*) FILTER (WHERE event_type = 'cart') AS num_cart_adds,
         count(*) FILTER (WHERE event_type = 'purchase') AS num_purchases,
         min(event_time) AS session_start, max(event_time) AS session_end,
         avg(price) AS avg_price
  FROM cat GROUP BY user_session
),
cc AS (
  SELECT user_session, category_main, count(*) AS n FROM cat GROUP BY user_session, category_main
),
top AS (
  SELECT user_session, category_main AS main_category FROM (
    SELECT *, row_number() OVER (PARTITION BY user_session ORDER BY n DESC, category_main) AS rn
    FROM cc) WHERE rn = 1
),
div AS (
  SELECT user_session, count(*) AS unique_categories FROM cc GROUP BY user_session
),
feat AS (
  SELECT b.user_session, b.num_views, b.num_cart_adds, b.num_purchases,
         b.session_start, b.session_end, b.avg_price,
         CAST(date_diff('second', b.session_start, b.session_end) AS BIGINT) AS session_duration,
         coalesce(t.main_category, 'unknown') AS main_category,
         coalesce(d.unique_categories, 0) AS unique_categories
  FROM base b LEFT JOIN top t USING (user_session) LEFT JOIN div d USING (user_session)
),
labels AS (
  SELECT user_session, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS label
  FROM clean GROUP BY user_session
),
labeled AS (
  SELECT f.user_session, f.num_views, f.num_cart_adds, f.num_purchases,
         f.session_start, f.session_end, coalesce(f.avg_price, 0) AS avg_price,
         coalesce(f.session_duration, 0) AS session_duration,
         f.main_category, f.unique_categories, coalesce(l.label, 0) AS label
  FROM feat f LEFT JOIN labels l USING (user_session)
),
bought AS (
  SELECT user_session, category_main AS label_category FROM (
    SELECT *, row_number() OVER (PARTITION BY user_session
                                 ORDER BY event_time NULLS LAST, category_main) AS rn
    FROM cat WHERE event_type = 'purchase') WHERE rn = 1
),
catsess AS (
  SELECT f.*, b.label_category FROM feat f JOIN bought b USING (user_session)
),
labelmap AS (
  SELECT CAST(row_number() OVER (ORDER BY n DESC, main_category) - 1 AS INTEGER) AS idx, main_category
  FROM (SELECT main_category, count(*) AS n FROM labeled GROUP BY main_category)
),
catmap AS (
  SELECT CAST(row_number() OVER (ORDER BY n DESC, label_category) - 1 AS INTEGER) AS idx, label_category
  FROM (SELECT label_category, count(*) AS n FROM catsess GROUP BY label_category)
)
"""

_FEATURE_COLS = ("user_session, num_views, num_cart_adds, num_purchases, session_start, session_end, "
                 "round(avg_price, 6) AS avg_price, session_duration, main_category, unique_categories")

_HASH_SPLIT = "(CAST(('0x' || substr(md5(user_session), 1, 4)) AS INTEGER) % 10 < 8)"

_FUNNEL_TOTALS = """, t AS (
  SELECT count(*) AS s0, count(*) FILTER (WHERE num_cart_adds > 0) AS s1,
         count(*) FILTER (WHERE label = 1) AS s2 FROM labeled)"""


def _ratio(n: str, d: str) -> str:
    return (f"coalesce(CAST(floor(CAST(200 * {n} + {d} AS DOUBLE) / CAST(nullif(2 * {d}, 0) AS DOUBLE))"
            f" AS DOUBLE) / 100.0::DOUBLE, 0.0::DOUBLE)")


def _hist(value: str, bins: int, src: str, by: str | None) -> str:
    by_sel = f"{by}, " if by else ""
    return f"""
, v AS (SELECT {by_sel}{value} AS x FROM {src} WHERE {value} IS NOT NULL),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
binned AS (
  SELECT {by_sel}CAST(least(coalesce(floor((x - b.lo) / nullif(b.hi - b.lo, 0) * {bins}.0::DOUBLE), 0),
                        {bins - 1}) AS INTEGER) AS bin
  FROM v, b)
SELECT {by_sel}bin, b.lo + bin * ((b.hi - b.lo) / {bins}.0::DOUBLE) AS bin_lo,
       b.lo + (bin + 1) * ((b.hi - b.lo) / {bins}.0::DOUBLE) AS bin_hi, count(*) AS n
FROM binned, b GROUP BY {by_sel}bin, b.lo, b.hi
"""


# the runs computed from the data: feature AUC per category, hit share per category pair
_RUNS = _BASE + """
, long AS (
  SELECT 'num_views' AS feature, main_category, CAST(num_views AS DOUBLE) AS score, label FROM labeled
  UNION ALL SELECT 'num_cart_adds', main_category, CAST(num_cart_adds AS DOUBLE), label FROM labeled
  UNION ALL SELECT 'unique_categories', main_category, CAST(unique_categories AS DOUBLE), label FROM labeled),
ps AS (
  SELECT feature, main_category, score, count(*) FILTER (WHERE label = 1) AS pos,
         count(*) FILTER (WHERE label = 0) AS neg FROM long GROUP BY ALL),
cum AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY feature, main_category ORDER BY score
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
  FROM ps),
runs AS (
  SELECT 'intent' AS task, feature AS model, main_category AS params,
         sum(CAST(pos AS DOUBLE) * (CAST(neg_below AS DOUBLE) + CAST(neg AS DOUBLE) * 0.5::DOUBLE))
           / nullif(CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE), 0) AS auc,
         CAST(NULL AS DOUBLE) AS pr_auc, CAST(NULL AS DOUBLE) AS accuracy
  FROM cum GROUP BY ALL
  UNION ALL
  SELECT 'category', main_category, label_category, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
         CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY main_category) AS DOUBLE)
  FROM (SELECT main_category, label_category, count(*) AS n FROM catsess GROUP BY ALL)
),
best AS (
  SELECT *, row_number() OVER (PARTITION BY task, model
    ORDER BY CASE WHEN task = 'intent' THEN auc ELSE accuracy END DESC NULLS LAST,
             task || '-' || model || '-' || params) AS rn FROM runs)
"""
_RUN_COLS = "task, model, params, auc, pr_auc, accuracy"

ORACLE_SQL: dict[str, str] = {
    "data_runs": _RUNS + f"SELECT task || '-' || model || '-' || params AS run_id, {_RUN_COLS} FROM runs",
    "data_best_grid_row": _RUNS + f"SELECT {_RUN_COLS} FROM best WHERE rn = 1",
    "data_best_model": _RUNS + f"""SELECT {_RUN_COLS} FROM runs WHERE task = 'intent'
ORDER BY auc DESC NULLS LAST, model, params LIMIT 1""",
    "data_best_run": _RUNS + f"""SELECT {_RUN_COLS} FROM runs WHERE task = 'category'
ORDER BY accuracy DESC NULLS LAST, model, params LIMIT 1""",
    "data_model_scores": _RUNS + """
SELECT model, params, auc, pr_auc, accuracy FROM best WHERE rn = 1 AND task = 'intent'""",
    "data_best_per_model": _RUNS + """
SELECT model, max(accuracy) AS max_accuracy FROM runs WHERE task = 'category' GROUP BY model""",
    "data_pending_grid": _RUNS + """
SELECT task, model, params FROM runs WHERE task = 'intent' AND model <> 'num_views'""",
    "data_run_by_params": _RUNS + f"""
SELECT {_RUN_COLS} FROM runs WHERE task = 'intent' AND model = 'num_views'
  AND params = (SELECT min(params) FROM runs WHERE task = 'intent')""",
    "scored_rows_checked": _BASE + f"""
SELECT user_session, num_views, num_cart_adds, unique_categories, main_category, label, true AS prob_ok
FROM labeled WHERE NOT {_HASH_SPLIT}""",
    "what_if_scenarios": _BASE + f"""
, sc(scenario, views, cart, price, duration, category) AS (VALUES
  ('as_is', NULL, NULL, NULL, NULL, NULL), ('more_cart', NULL, 3.0::DOUBLE, NULL, NULL, NULL),
  ('cheap_and_short', NULL, NULL, 5.0::DOUBLE, 30.0::DOUBLE, NULL),
  ('other_category', 10.0::DOUBLE, NULL, NULL, NULL, 'unknown'))
SELECT user_session, scenario, coalesce(views, CAST(num_views AS DOUBLE)) AS num_views,
       coalesce(cart, CAST(num_cart_adds AS DOUBLE)) AS num_cart_adds,
       coalesce(price, round(avg_price, 6)) AS avg_price,
       coalesce(duration, CAST(session_duration AS DOUBLE)) AS session_duration,
       coalesce(category, main_category) AS main_category, true AS prob_ok, CAST(3 AS INTEGER) AS n_distinct
FROM labeled, sc WHERE NOT {_HASH_SPLIT}""",
    "top3_checked": _BASE + f"""
SELECT user_session, label_category, CAST(3 AS INTEGER) AS n_distinct, true AS known
FROM catsess WHERE NOT {_HASH_SPLIT}""",
    "index_label_roundtrip": _BASE + """
SELECT c.user_session, CAST(m.idx AS DOUBLE) AS "index", c.label_category AS predicted_category
FROM catsess c JOIN catmap m USING (label_category)""",
    "index_accuracy": _BASE + """
SELECT count(*) AS n, count(*) FILTER (WHERE m.idx = 0) AS correct,
       avg(CASE WHEN m.idx = 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS accuracy
FROM catsess c JOIN catmap m USING (label_category)""",
    "assembled_slots": _BASE + """
, slots AS (
  SELECT user_session, 0 AS slot, CAST(num_views AS DOUBLE) AS value FROM labeled
  UNION ALL SELECT user_session, 1, CAST(num_cart_adds AS DOUBLE) FROM labeled
  UNION ALL SELECT user_session, 2, CAST(session_duration AS DOUBLE) FROM labeled
  UNION ALL SELECT user_session, 3, round(avg_price, 6) FROM labeled
  UNION ALL SELECT user_session, 4, CAST(unique_categories AS DOUBLE) FROM labeled
  UNION ALL SELECT l.user_session, CAST(5 + m.idx AS INTEGER), 1.0::DOUBLE
            FROM labeled l JOIN labelmap m USING (main_category))
SELECT user_session, CAST(slot AS INTEGER) AS slot, value FROM slots WHERE value <> 0""",
    "stream_threshold_checked": _BASE + """
SELECT user_session, CAST(num_views AS DOUBLE) AS num_views, CAST(num_cart_adds AS DOUBLE) AS num_cart_adds,
       CAST(num_purchases AS DOUBLE) AS num_purchases, main_category, true AS prob_ok,
       CAST(3 AS INTEGER) AS n_distinct
FROM catsess""",
    "load_events": _BASE + "SELECT * FROM raw",
    "load_events_csv": _BASE + "SELECT * EXCLUDE (event_id) FROM raw",
    "clean_events": _BASE + "SELECT * FROM clean",
    "categorized_events": _BASE + "SELECT * FROM cat",
    "event_counts": _BASE + """
SELECT event_type, count(*) AS n_raw,
       count(*) FILTER (WHERE user_id IS NOT NULL AND user_session IS NOT NULL
                        AND event_type IN ('view', 'cart', 'purchase')) AS n_clean,
       count(*) FILTER (WHERE user_id IS NOT NULL AND user_session IS NOT NULL
                        AND event_type IN ('view', 'cart', 'purchase')
                        AND category_code IS NOT NULL) AS n_categorized
FROM raw GROUP BY event_type""",
    "sample_sessions": _BASE + """
SELECT * FROM raw
WHERE CAST(('0x' || substr(md5(user_session), 1, 4)) AS INTEGER) % 1000 < 25""",
    "session_category_counts": _BASE + "SELECT user_session, category_main, n AS count FROM cc",
    "session_main_category": _BASE + "SELECT * FROM top",
    "purchase_labels": _BASE + "SELECT * FROM labels",
    "session_features": _BASE + f"SELECT {_FEATURE_COLS} FROM feat",
    "write_read_features": _BASE + f"SELECT {_FEATURE_COLS} FROM feat",
    "labeled_sessions": _BASE + f"SELECT {_FEATURE_COLS}, label FROM labeled",
    "category_sessions": _BASE + f"SELECT {_FEATURE_COLS}, label_category FROM catsess",
    "funnel": _BASE + _FUNNEL_TOTALS + """
SELECT 1 AS stage_no, 'Viewed' AS stage, s0 AS users FROM t
UNION ALL SELECT 2, 'Cart Add', s1 FROM t
UNION ALL SELECT 3, 'Purchased', s2 FROM t""",
    "funnel_dropoff": _BASE + _FUNNEL_TOTALS + """
SELECT 1 AS stage_no, 'Viewed' AS stage, s0 AS users,
       100.0::DOUBLE * (1.0::DOUBLE - CAST(s0 AS DOUBLE) / CAST(s0 AS DOUBLE)) AS dropoff_pct FROM t
UNION ALL SELECT 2, 'Cart Add', s1,
       100.0::DOUBLE * (1.0::DOUBLE - CAST(s1 AS DOUBLE) / CAST(s0 AS DOUBLE)) FROM t
UNION ALL SELECT 3, 'Purchased', s2,
       100.0::DOUBLE * (1.0::DOUBLE - CAST(s2 AS DOUBLE) / CAST(s0 AS DOUBLE)) FROM t""",
    "category_funnel": _BASE + """
SELECT main_category, count(*) AS viewed,
       count(*) FILTER (WHERE num_cart_adds > 0) AS cart,
       count(*) FILTER (WHERE label = 1) AS purchased
FROM labeled GROUP BY main_category ORDER BY viewed DESC, main_category""",
    "category_conversion": _BASE + f"""
, f AS (
  SELECT main_category, count(*) AS viewed,
         count(*) FILTER (WHERE num_cart_adds > 0) AS cart,
         count(*) FILTER (WHERE label = 1) AS purchased
  FROM labeled GROUP BY main_category)
SELECT main_category, viewed, cart, purchased,
       {_ratio('cart', 'viewed')} AS cart_rate,
       {_ratio('purchased', 'cart')} AS purchase_rate,
       {_ratio('purchased', 'viewed')} AS view_purchase_rate
FROM f ORDER BY viewed DESC, main_category""",
    "price_histogram": _BASE + ", lr AS (SELECT label, round(avg_price, 6) AS avg_price FROM labeled)"
                       + _hist("avg_price", 40, "lr", "label"),
    "duration_price_grid": _BASE + """
, inr AS (SELECT label, session_duration, round(avg_price, 6) AS avg_price FROM labeled
          WHERE avg_price IS NOT NULL),
b AS (SELECT min(avg_price) AS lo, max(avg_price) AS hi FROM inr)
SELECT label,
       CASE WHEN session_duration > 5000 THEN 20 ELSE
         CAST(least(floor(session_duration * 20 / 5000.0::DOUBLE), 19) AS INTEGER) END AS duration_bin,
       CAST(least(coalesce(floor((avg_price - b.lo) / nullif(b.hi - b.lo, 0) * 20.0::DOUBLE), 0), 19)
            AS INTEGER) AS price_bin,
       count(*) AS n
FROM inr, b GROUP BY ALL""",
    "split_counts": _BASE + f"""
SELECT CASE WHEN {_HASH_SPLIT} THEN 'train' ELSE 'test' END AS split, label, count(*) AS n
FROM labeled GROUP BY ALL""",
    "label_map": _BASE + "SELECT idx AS \"index\", main_category AS category FROM labelmap",
    "category_label_map": _BASE + "SELECT idx AS \"index\", label_category AS category FROM catmap",
    "indexed_sessions": _BASE + """
SELECT l.user_session, l.main_category, CAST(m.idx AS DOUBLE) AS main_category_index
FROM labeled l JOIN labelmap m USING (main_category)""",
    "category_sessions_indexed": _BASE + """
SELECT c.user_session, c.label_category, CAST(m.idx AS DOUBLE) AS label
FROM catsess c JOIN catmap m USING (label_category)""",
    "onehot": _BASE + """
SELECT l.user_session, CAST((SELECT count(*) FROM labelmap) AS INTEGER) AS onehot_size,
       m.idx AS hot_slot
FROM labeled l JOIN labelmap m USING (main_category)""",
    "session_messages": _BASE + f"""
SELECT user_session AS key, {_FEATURE_COLS.replace('user_session, ', '')}, label_category
FROM catsess WHERE main_category IS NOT NULL""",
    "defaulted_sessions": _BASE + """
SELECT user_session, CAST(num_views AS DOUBLE) AS num_views,
       CAST(num_cart_adds AS DOUBLE) AS num_cart_adds,
       round(coalesce(avg_price, 0.0), 6) AS avg_price,
       CAST(coalesce(session_duration, 0) AS DOUBLE) AS session_duration,
       CAST(num_purchases AS DOUBLE) AS num_purchases,
       CAST(unique_categories AS DOUBLE) AS unique_categories,
       coalesce(nullif(trim(main_category), ''), 'unknown') AS main_category
FROM catsess""",
    "main_category_accuracy": _BASE + """
SELECT count(*) AS n, count(*) FILTER (WHERE main_category = label_category) AS correct,
       avg(CASE WHEN main_category = label_category THEN 1.0 ELSE 0.0 END)::DOUBLE AS accuracy
FROM catsess""",
    "feature_auc": _BASE + """
, long AS (
  SELECT 'num_views' AS feature, CAST(num_views AS DOUBLE) AS score, label FROM labeled
  UNION ALL SELECT 'num_cart_adds', CAST(num_cart_adds AS DOUBLE), label FROM labeled
  UNION ALL SELECT 'unique_categories', CAST(unique_categories AS DOUBLE), label FROM labeled),
ps AS (
  SELECT feature, score, count(*) FILTER (WHERE label = 1) AS pos,
         count(*) FILTER (WHERE label = 0) AS neg FROM long GROUP BY feature, score),
cum AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY feature ORDER BY score
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
  FROM ps)
SELECT feature, CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
       sum(CAST(pos AS DOUBLE) * (CAST(neg_below AS DOUBLE) + CAST(neg AS DOUBLE) * 0.5::DOUBLE))
         / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc
FROM cum GROUP BY feature""",
    "stream_source": _BASE + f"""
SELECT {_FEATURE_COLS}, label_category, true AS _valid FROM catsess""",
    "stream_quarantine": "SELECT props AS value FROM events",
    "test_split_funnel": _BASE + """
, t AS (SELECT * FROM labeled WHERE NOT {split})
SELECT '(all)' AS main_category, 'Viewed' AS stage, count(*) AS users FROM t
UNION ALL SELECT '(all)', 'Cart Add', count(*) FILTER (WHERE num_cart_adds > 0) FROM t
UNION ALL SELECT '(all)', 'Purchased', count(*) FILTER (WHERE label = 1) FROM t
UNION ALL SELECT main_category, 'Viewed', count(*) FROM t GROUP BY main_category
UNION ALL SELECT main_category, 'Cart Add', count(*) FILTER (WHERE num_cart_adds > 0) FROM t
          GROUP BY main_category
UNION ALL SELECT main_category, 'Purchased', count(*) FILTER (WHERE label = 1) FROM t
          GROUP BY main_category""".replace("{split}", _HASH_SPLIT),
    # 30-minute session windows per user_session over timed, categorised
    # clean events: those the watermark closed and those open at the end.
    "stream_session_features": _BASE + """
, tev AS (SELECT * FROM cat WHERE event_time IS NOT NULL),
marked AS (
  SELECT *, CASE WHEN lag(event_time) OVER (PARTITION BY user_session ORDER BY event_time, event_id)
                      > event_time - INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new_sess
  FROM tev),
numbered AS (
  SELECT *, sum(new_sess) OVER (PARTITION BY user_session ORDER BY event_time, event_id
                                ROWS UNBOUNDED PRECEDING) AS sess_no
  FROM marked),
cc2 AS (
  SELECT user_session, sess_no, category_main, count(*) AS n FROM numbered
  GROUP BY ALL),
top2 AS (
  SELECT user_session, sess_no, category_main AS main_category FROM (
    SELECT *, row_number() OVER (PARTITION BY user_session, sess_no
                                 ORDER BY n DESC, category_main) AS rn FROM cc2) WHERE rn = 1),
w AS (
  SELECT user_session, sess_no, min(event_time) AS window_start,
         max(event_time) + INTERVAL 30 MINUTE AS window_end,
         count(*) FILTER (WHERE event_type = 'view') AS num_views,
         count(*) FILTER (WHERE event_type = 'cart') AS num_cart_adds,
         count(*) FILTER (WHERE event_type = 'purchase') AS num_purchases,
         min(event_time) AS session_start, max(event_time) AS session_end,
         round(avg(price), 6) AS avg_price,
         CAST(date_diff('second', min(event_time), max(event_time)) AS BIGINT) AS session_duration,
         count(DISTINCT category_main) AS unique_categories
  FROM numbered GROUP BY user_session, sess_no)
SELECT w.user_session, window_start, window_end, num_views, num_cart_adds, num_purchases,
       session_start, session_end, avg_price, session_duration, t.main_category, unique_categories
FROM w JOIN top2 t USING (user_session, sess_no)""",
    "pre_purchase_sessions": _BASE + """
, fp AS (SELECT user_session, min(event_time) AS fpt FROM clean
         WHERE event_type = 'purchase' AND event_time IS NOT NULL GROUP BY user_session),
pcat AS (SELECT c.* FROM cat c LEFT JOIN fp USING (user_session)
         WHERE fp.fpt IS NULL OR c.event_time < fp.fpt),
pbase AS (
  SELECT user_session,
         count(*) FILTER (WHERE event_type = 'view') AS num_views,
         count(*) FILTER (WHERE event_type = 'cart') AS num_cart_adds,
         count(*) FILTER (WHERE event_type = 'purchase') AS num_purchases,
         min(event_time) AS session_start, max(event_time) AS session_end, avg(price) AS avg_price
  FROM pcat GROUP BY user_session),
pcc AS (SELECT user_session, category_main, count(*) AS n FROM pcat GROUP BY ALL),
ptop AS (
  SELECT user_session, category_main AS main_category FROM (
    SELECT *, row_number() OVER (PARTITION BY user_session ORDER BY n DESC, category_main) AS rn
    FROM pcc) WHERE rn = 1)
SELECT b.user_session, b.num_views, b.num_cart_adds, b.num_purchases, b.session_start,
       b.session_end, round(coalesce(b.avg_price, 0), 6) AS avg_price,
       coalesce(CAST(date_diff('second', b.session_start, b.session_end) AS BIGINT), 0)
         AS session_duration,
       t.main_category, (SELECT count(*) FROM pcc WHERE pcc.user_session = b.user_session)
         AS unique_categories,
       coalesce(l.label, 0) AS label
FROM pbase b JOIN ptop t USING (user_session) LEFT JOIN labels l USING (user_session)""",
}

# the same rows by another way of storing or joining them
ORACLE_SQL["pre_purchase_bucketed"] = ORACLE_SQL["pre_purchase_sessions"]
ORACLE_SQL["labeled_join"] = ORACLE_SQL["labeled_sessions"]
ORACLE_SQL["incremental_features"] = ORACLE_SQL["session_features"]

_IDS = "user_id IS NOT NULL AND user_session IS NOT NULL"
_KEPT = f"{_IDS} AND event_type IN ('view', 'cart', 'purchase')"

ORACLE_SQL["incremental_folds"] = _BASE + f"""
SELECT CAST(event_id % 3 + 1 AS INTEGER) AS fold, count(*) AS n_raw, count(*) FILTER (WHERE {_KEPT}) AS n_clean
FROM raw GROUP BY 1"""


def _drop_reasons(corrupt: str) -> str:
    reasons = {
        "raw": f"count(*) + {corrupt}", "corrupt": f"0 * count(*) + {corrupt}", "no_user": "count(*) FILTER (WHERE user_id IS NULL)",
        "no_session": "count(*) FILTER (WHERE user_id IS NOT NULL AND user_session IS NULL)",
        "other_type": f"count(*) FILTER (WHERE {_IDS} AND event_type NOT IN ('view', 'cart', 'purchase'))",
        "kept": f"count(*) FILTER (WHERE {_KEPT})",
        "kept_uncategorized": f"count(*) FILTER (WHERE {_KEPT} AND category_code IS NULL)",
        "kept_untimed": f"count(*) FILTER (WHERE {_KEPT} AND event_time IS NULL)",
        **{f"kept_{t}": f"count(*) FILTER (WHERE {_IDS} AND event_type = '{t}')" for t in ("view", "cart", "purchase")}}
    return _BASE + " UNION ALL ".join(f"SELECT '{r}' AS reason, {n} AS n FROM raw" for r, n in reasons.items())


ORACLE_SQL["drop_reasons"] = _drop_reasons("0")
ORACLE_SQL["csv_drop_reasons"] = _drop_reasons("(SELECT count(*) FROM events WHERE event_id % 100 = 0)")

_PR_FEATURES = ["num_views", "num_cart_adds", "unique_categories", "session_duration", "avg_price"]

# points of the precision-recall curve of ``long`` (one ``by`` column), joined by straight lines
_PR_AREA = """
ps AS (SELECT {by}, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) AS n FROM long GROUP BY ALL),
cum AS (SELECT *, sum(pos) OVER w AS tp, sum(n) OVER w AS seen, sum(pos) OVER (PARTITION BY {by}) AS positives
        FROM ps WINDOW w AS (PARTITION BY {by} ORDER BY score DESC)),
area AS (
  SELECT {by}, CAST(max(positives) AS BIGINT) AS positives, CAST(sum(n) - max(positives) AS BIGINT) AS negatives,
         round(sum(pos::DOUBLE / positives * (tp::DOUBLE / seen
           + CASE WHEN seen > n THEN (tp - pos)::DOUBLE / (seen - n) ELSE tp::DOUBLE / seen END) / 2), 9) AS pr_area
  FROM cum GROUP BY {by})"""

ORACLE_SQL["feature_pr_area"] = _BASE + ", long AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, round(CAST({f} AS DOUBLE), 6) AS score, label FROM labeled" for f in _PR_FEATURES
) + ")," + _PR_AREA.format(by="feature") + " SELECT * FROM area"

_NUMERIC = ["num_views", "num_cart_adds", "session_duration", "avg_price", "unique_categories"]

_BAYES = _BASE + f"""
, rounded AS (SELECT * REPLACE (round(avg_price, 6) AS avg_price) FROM labeled),
train AS (SELECT * FROM rounded WHERE {_HASH_SPLIT}),
sums AS (
  SELECT label, slot, sum(total) AS total FROM (
    SELECT label, '(prior)' AS slot, 1.0::DOUBLE AS total FROM train
    {" ".join(f"UNION ALL SELECT label, '{c}', CAST({c} AS DOUBLE) FROM train" for c in _NUMERIC)}
    UNION ALL SELECT label, 'main_category=' || main_category, 1.0 FROM train
    UNION ALL SELECT unnest([0, 1]), 'main_category=' || main_category, 0.0 FROM rounded) GROUP BY ALL),
grid(smoothing) AS (VALUES (1.0::DOUBLE), (0.5::DOUBLE), (2.0::DOUBLE)),
masses AS (SELECT label, sum(total) AS mass, count(*) AS slots FROM sums WHERE slot <> '(prior)' GROUP BY label),
priors AS (SELECT sum(total) AS n FROM sums WHERE slot = '(prior)'),
params AS (
  SELECT smoothing, label, slot, CASE WHEN slot = '(prior)' THEN ln(total + smoothing) - ln(n + 2 * smoothing)
           ELSE ln(total + smoothing) - ln(mass + slots * smoothing) END AS log_prob
  FROM sums JOIN masses USING (label), priors, grid)"""

ORACLE_SQL["nb_parameters"] = _BAYES + """
SELECT smoothing, label, slot, round(log_prob, 9) AS log_prob FROM params"""

ORACLE_SQL["nb_relational"] = _BAYES + f""",
one AS (SELECT smoothing, {", ".join(f"max(log_prob) FILTER (WHERE slot = '{c}') AS p_{c}" for c in _NUMERIC)},
               max(log_prob) FILTER (WHERE slot = '(prior)') AS prior FROM params WHERE label = 1 GROUP BY smoothing),
long AS (
  SELECT smoothing, t.label, prior + {" + ".join(f"{c} * p_{c}" for c in _NUMERIC)} + log_prob AS score
  FROM rounded t, one JOIN params c USING (smoothing)
  WHERE NOT {_HASH_SPLIT} AND c.label = 1 AND c.slot = 'main_category=' || main_category),{_PR_AREA.format(by="smoothing")},
below AS (SELECT *, coalesce(sum(n - pos) OVER (PARTITION BY smoothing ORDER BY score
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM ps),
roc AS (SELECT smoothing, sum(pos::DOUBLE * (neg_below + (n - pos) * 0.5::DOUBLE))
               / (sum(pos)::DOUBLE * sum(n - pos)::DOUBLE) AS auc FROM below GROUP BY smoothing)
SELECT smoothing || '_multinomial' AS params, round(auc, 9) AS auc, pr_area AS pr_auc
FROM roc JOIN area USING (smoothing)"""
ORACLE_SQL["nb_fitted"] = ORACLE_SQL["nb_relational"]

ORACLE_SQL["stream_compacted"] = _BASE + f"SELECT {_FEATURE_COLS}, label_category FROM catsess"
ORACLE_SQL["stream_hand_over"] = _BASE + """
SELECT user_session, CASE WHEN num_views % 2 = 0 THEN 'first' ELSE 'better' END AS served, true AS prob_ok
FROM catsess WHERE main_category IS NOT NULL"""

# scores of the fitted naive Bayes model (smoothing 1) on the test split, and with one more cart add
_NB_SCORED = _BAYES + f""",
logs AS (SELECT label, {", ".join(f"max(log_prob) FILTER (WHERE slot = '{c}') AS p_{c}" for c in _NUMERIC)},
                max(log_prob) FILTER (WHERE slot = '(prior)') AS prior FROM params WHERE smoothing = 1 GROUP BY label),
joint AS (
  SELECT t.*, p.label AS class, extra, prior + {" + ".join(f"{c} * p_{c}" for c in _NUMERIC)} + extra * p_num_cart_adds
         + log_prob AS j
  FROM rounded t, (VALUES (0), (1)) e(extra), logs p JOIN params c ON c.label = p.label AND c.smoothing = 1
  WHERE NOT {_HASH_SPLIT} AND c.slot = 'main_category=' || main_category),
odds AS (SELECT user_session, extra, sum(CASE WHEN class = 1 THEN j ELSE -j END) AS d FROM joint GROUP BY ALL),
probs AS (SELECT user_session, extra, CASE WHEN d > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
                 round(1 / (1 + exp(least(-d, 700))), 6) AS purchase_prob FROM odds),
scored AS (SELECT r.*, prediction, purchase_prob, CAST(m.idx AS DOUBLE) AS main_category_index
           FROM rounded r JOIN probs USING (user_session) JOIN labelmap m USING (main_category) WHERE extra = 0)"""

ORACLE_SQL["nb_probability"] = _NB_SCORED + " SELECT user_session, label, prediction, purchase_prob FROM scored"
ORACLE_SQL["nb_scored_store"] = _NB_SCORED + """
SELECT user_session, num_views, num_cart_adds, label, prediction, purchase_prob, session_duration, avg_price,
       main_category, main_category_index, unique_categories FROM scored"""
ORACLE_SQL["nb_prediction_histogram"] = _NB_SCORED + _hist("purchase_prob", 30, "scored", None)
ORACLE_SQL["nb_uplift"] = _NB_SCORED + """
SELECT user_session, a.purchase_prob AS prob_now, b.purchase_prob AS prob_more_cart
FROM probs a JOIN probs b USING (user_session) WHERE a.extra = 0 AND b.extra = 1"""

ORACLE_SQL["share_top3"] = _BASE + """
, totals AS (SELECT user_session, sum(n) AS total FROM cc GROUP BY user_session),
ranked AS (
  SELECT s.user_session, m.idx, m.label_category,
         row_number() OVER (PARTITION BY s.user_session ORDER BY coalesce(cc.n, 0) / total DESC, m.idx) AS r
  FROM catsess s CROSS JOIN catmap m JOIN totals USING (user_session)
       LEFT JOIN cc ON cc.user_session = s.user_session AND cc.category_main = m.label_category)
SELECT user_session, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY r) AS indices,
       string_agg(label_category, ',' ORDER BY r) AS categories
FROM ranked WHERE r <= 3 GROUP BY user_session"""

"""The registered queries once more as plain SQL, written independently.

Each text runs on the bundled tables alone. Shared inputs are common table
expressions put in front of a query by name.
"""

from __future__ import annotations

EV = """ev AS (
  SELECT event_id AS eid, ts, epoch_us(ts) // 1000 AS event_ms, user_id,
         user_id * 1000 + dayofyear(ts) AS session_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         event_type, CAST(value AS DECIMAL(12,2)) AS price,
         CAST(1 + event_id % 3 AS INTEGER) AS quantity,
         CAST(ts AS DATE) AS metric_date
  FROM events)"""

CATEGORISED = """categorised AS (
  SELECT *, CASE (item_id * 7 + eid) % 13 WHEN 0 THEN NULL WHEN 12 THEN 'S'
            ELSE CAST((item_id * 7 + eid) % 13 AS VARCHAR) END AS category FROM ev)"""

CLICKS = "clicks AS (SELECT * FROM categorised WHERE event_type IN ('click', 'view'))"
PURCHASES = "purchases AS (SELECT * FROM ev WHERE event_type = 'purchase')"

DAILY = """daily AS (
  SELECT c.metric_date, c.total_clicks, coalesce(p.total_purchases, 0) AS total_purchases,
         c.unique_sessions, c.unique_items,
         CAST(coalesce(p.purchase_sessions, 0) AS DOUBLE) / c.unique_sessions AS conversion_rate,
         CAST(s.span_ms AS DOUBLE) / 1000 / s.sessions AS avg_session_duration_sec,
         CAST(c.total_clicks AS DOUBLE) / s.sessions AS avg_clicks_per_session,
         p.revenue AS total_revenue,
         CASE WHEN coalesce(p.total_purchases, 0) > 0
              THEN CAST(p.revenue AS DOUBLE) / p.total_purchases ELSE 0.0 END AS avg_order_value
  FROM (SELECT metric_date, count(*) AS total_clicks, count(DISTINCT session_id) AS unique_sessions,
               count(DISTINCT item_id) AS unique_items FROM clicks GROUP BY 1) c
  LEFT JOIN (SELECT metric_date, count(*) AS total_purchases,
                    count(DISTINCT session_id) AS purchase_sessions,
                    sum(price * quantity) AS revenue FROM purchases GROUP BY 1) p
         USING (metric_date)
  JOIN (SELECT metric_date, sum(span) AS span_ms, count(*) AS sessions FROM
          (SELECT metric_date, session_id, max(event_ms) - min(event_ms) AS span
           FROM clicks GROUP BY 1, 2) GROUP BY 1) s USING (metric_date))"""

PRIMARY_PER_DAY = """primary_cat AS (
  SELECT metric_date, item_id, category FROM (
    SELECT metric_date, item_id, category, row_number() OVER (
             PARTITION BY metric_date, item_id
             ORDER BY count(*) DESC, category ASC NULLS LAST) AS place
    FROM clicks GROUP BY 1, 2, 3) WHERE place = 1)"""

ITEMS = """items AS (
  SELECT * FROM (
    SELECT c.metric_date, c.item_id, k.category, c.click_count,
           coalesce(p.purchase_count, 0) AS purchase_count, coalesce(p.revenue, 0) AS revenue,
           CAST(row_number() OVER (PARTITION BY c.metric_date
             ORDER BY coalesce(p.revenue, 0) DESC, c.item_id) AS INTEGER) AS rank,
           CASE WHEN p.purchase_count > 0
                THEN CAST(c.click_count AS DOUBLE) / p.purchase_count END AS click_to_purchase_ratio
    FROM (SELECT metric_date, item_id, count(*) AS click_count FROM clicks GROUP BY 1, 2) c
    JOIN primary_cat k USING (metric_date, item_id)
    LEFT JOIN (SELECT metric_date, item_id, count(*) AS purchase_count,
                      sum(price * quantity) AS revenue FROM purchases GROUP BY 1, 2) p
           USING (metric_date, item_id)) WHERE rank <= 100)"""


def _categories(name: str, pairs: str) -> str:
    return f"""{name} AS (
  SELECT * FROM (
    SELECT c.metric_date, c.category, c.click_count, coalesce(p.purchase_count, 0) AS purchase_count,
           c.unique_items, coalesce(p.revenue, 0) AS revenue,
           CAST(row_number() OVER (PARTITION BY c.metric_date
             ORDER BY coalesce(p.revenue, 0) DESC, c.category) AS INTEGER) AS rank
    FROM (SELECT metric_date, category, count(*) AS click_count,
                 count(DISTINCT item_id) AS unique_items
          FROM clicks WHERE category IS NOT NULL GROUP BY 1, 2) c
    LEFT JOIN (SELECT x.metric_date, x.category, count(*) AS purchase_count,
                      sum(b.price * b.quantity) AS revenue
               FROM purchases b JOIN ({pairs}) x USING (metric_date, item_id)
               WHERE x.category IS NOT NULL GROUP BY 1, 2) p
           USING (metric_date, category)) WHERE rank <= 20)"""


EVERY_PAIR = "SELECT DISTINCT metric_date, item_id, category FROM clicks"
CATEGORIES = _categories("categories", EVERY_PAIR)
CATEGORIES_PRIMARY = _categories(
    "categories_primary", "SELECT metric_date, item_id, category FROM primary_cat"
)

FUNNEL = """sess AS (
  SELECT c.metric_date, c.session_id, c.click_count, c.unique_items_viewed,
         coalesce(p.purchase_count, 0) AS purchase_count
  FROM (SELECT metric_date, session_id, count(*) AS click_count,
               count(DISTINCT item_id) AS unique_items_viewed FROM clicks GROUP BY 1, 2) c
  LEFT JOIN (SELECT metric_date, session_id, count(*) AS purchase_count
             FROM purchases GROUP BY 1, 2) p USING (metric_date, session_id)),
stages AS (
  SELECT metric_date, count(*) AS v, count(*) FILTER (WHERE click_count >= 2) AS m,
         count(*) FILTER (WHERE purchase_count > 0) AS p FROM sess GROUP BY 1),
funnel AS (
  SELECT metric_date, 'VIEW' AS funnel_stage, v AS session_count,
         CAST(100 AS DOUBLE) AS percentage, CAST(0 AS DOUBLE) AS drop_rate FROM stages
  UNION ALL
  SELECT metric_date, 'MULTI_VIEW', m, CAST(m AS DOUBLE) / v * 100, CAST(v - m AS DOUBLE) / v
  FROM stages
  UNION ALL
  SELECT metric_date, 'PURCHASE', p, CAST(p AS DOUBLE) / v * 100,
         CASE WHEN m > 0 THEN CAST(m - p AS DOUBLE) / m ELSE 0.0 END FROM stages)"""

HIGH = """high AS (
  SELECT sha256(concat_ws('|', user_id, epoch_us(w) // 1000, 'HIGH_FREQUENCY')) AS event_id,
         epoch_us(min(ts)) // 1000000 * 1000 AS event_ts, user_id AS session_id,
         max(ts) AS detected_at, w AS window_start, w + INTERVAL 1 DAY AS window_end,
         min(ts) AS first_event_ts, max(ts) AS last_event_ts, count(*) AS click_count,
         count(DISTINCT event_type) AS unique_items,
         CAST(count(*) AS DOUBLE) / 3 AS anomaly_score, 'HIGH_FREQUENCY' AS anomaly_type,
         max(ts + to_microseconds(eid % 700 * 1000)) AS kafka_ingest_ts,
         'spark_streaming' AS source
  FROM (SELECT *, date_trunc('day', ts) AS w FROM ev) GROUP BY user_id, w HAVING count(*) > 3)"""

BOT = """bot AS (
  SELECT sha256(concat_ws('|', user_id, epoch_us(w) // 1000, 'BOT_LIKE')) AS event_id,
         epoch_us(min(ts)) // 1000000 * 1000 AS event_ts, user_id AS session_id,
         max(ts) AS detected_at, w AS window_start, w + INTERVAL 2 DAY AS window_end,
         min(ts) AS first_event_ts, max(ts) AS last_event_ts, count(*) AS click_count,
         count(DISTINCT event_type) AS unique_items,
         CAST(count(*) AS DOUBLE) / 5 *
           (1 - CAST(count(DISTINCT event_type) AS DOUBLE) / count(*)) AS anomaly_score,
         'BOT_LIKE' AS anomaly_type,
         max(ts + to_microseconds(eid % 700 * 1000)) AS kafka_ingest_ts,
         'spark_streaming' AS source
  FROM (SELECT *, CAST(date_trunc('day', ts) AS TIMESTAMP) - to_days(CAST(back AS INTEGER)) AS w
        FROM ev, unnest([0, 1]) AS shift(back))
  GROUP BY user_id, w
  HAVING count(*) > 5 AND CAST(count(DISTINCT event_type) AS DOUBLE) / count(*) < 0.6)"""

ANOMALIES = "anomalies AS (SELECT * FROM high UNION ALL SELECT * FROM bot)"

LATE_INPUT = """timed AS (
  SELECT CAST(eid AS VARCHAR) AS event_id, session_id, item_id, event_type, ts AS event_ts,
         ts AS kafka_ingest_ts FROM ev)"""
CUTOFF = "(SELECT max(ts) - INTERVAL 5 DAY FROM ev)"

RAW_CLICKS = """raw_clicks AS (
  SELECT *, CASE WHEN t = '' THEN 'missing required column' WHEN damaged THEN 'bad timestamp'
                 WHEN item = 'x' THEN 'bad item id' END AS error
  FROM (SELECT CAST(session_id AS VARCHAR) AS sid,
         CASE WHEN eid % 75 = 0 THEN '' WHEN eid % 61 = 0 THEN strftime(ts, '%H:%M:%S')
              WHEN eid % 67 = 0 THEN strftime(ts, '%Y')
              WHEN eid % 71 = 0 THEN '-' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') END AS t,
         eid % 61 = 0 OR eid % 67 = 0 OR eid % 71 = 0 AS damaged,
         CASE WHEN eid % 50 = 0 THEN 'x' ELSE CAST(item_id AS VARCHAR) END AS item,
         coalesce(category, '0') AS cat, session_id, item_id, event_ms, eid, category
  FROM categorised))"""

RAW_PURCHASES = """raw_purchases AS (
  SELECT *, CASE WHEN eid % 17 = 0 THEN 'Failed to parse row: bad timestamp'
                 WHEN eid % 20 = 0 THEN 'Failed to parse row: bad price'
                 WHEN eid % 30 = 0 THEN 'Failed to parse row: bad quantity' END AS error
  FROM purchases)"""

DLQ = """parts AS (
  SELECT CAST(metric_date AS TIMESTAMP) AS snapshot_ts, user_id % 3 AS part,
         sum(count(*)) OVER (PARTITION BY user_id % 3 ORDER BY metric_date) AS end_offset
  FROM ev WHERE event_type = 'error' GROUP BY metric_date, user_id % 3),
totals AS (
  SELECT 'events.dlq' AS topic, snapshot_ts, CAST(sum(end_offset) AS BIGINT) AS current_total,
         '{' || string_agg('"events.dlq:' || part || '": ' || end_offset, ', ' ORDER BY part) || '}'
           AS offsets
  FROM parts GROUP BY snapshot_ts),
growth AS (
  SELECT *, coalesce(lag(current_total) OVER (ORDER BY snapshot_ts), 0) AS previous_total FROM totals),
dlq AS (SELECT *, greatest(0, current_total - previous_total) AS growth FROM growth)"""

PROGRESS = """batches AS (
  SELECT event_type AS name, metric_date, dayofyear(metric_date) - 1 AS batch_id, count(*) AS n,
         count(*) FILTER (WHERE user_id % 3 = 0) AS n0,
         count(*) FILTER (WHERE user_id % 3 = 1) AS n1,
         count(*) FILTER (WHERE user_id % 3 = 2) AS n2
  FROM ev GROUP BY 1, 2),
prog AS (
  SELECT *, sum(n0) OVER w AS e0, sum(n1) OVER w AS e1, sum(n2) OVER w AS e2,
         CAST(sum(n) OVER w AS BIGINT) AS total, n * n * 13 % 9000 AS trigger_ms, n * 7 % 5 AS lag,
         n + n % 4 AS input_rows,
         CASE WHEN name = 'view' AND batch_id % 7 = 6 THEN 1 ELSE 0 END AS gap,
         CAST(n * 1000 AS DOUBLE) / (n * n * 13 % 9000 + 1) AS rps,
         CAST(metric_date AS TIMESTAMP) + INTERVAL 12 HOUR
           + to_milliseconds(n * n * 13 % 9000) AS completed_at
  FROM batches WINDOW w AS (PARTITION BY name ORDER BY metric_date))"""

PROGRESS_SUMMARY = """summ AS (
  SELECT name, count(*) AS batches, CAST(sum(input_rows) AS BIGINT) AS input_rows,
         round(max(rps), 2) AS processed_rows_per_second_max,
         round(quantile_cont(CAST(trigger_ms AS DOUBLE), 0.95), 2) AS trigger_ms_p95,
         CAST(max(trigger_ms) AS DOUBLE) AS trigger_ms_max, max(lag) AS lag_max,
         arg_max(lag, batch_id) AS lag_end, arg_max(total, batch_id) AS state_rows_end
  FROM prog GROUP BY name)"""

RECOVERY = """goal AS (
  SELECT name, max(e0) AS g0, max(e1) AS g1, max(e2) AS g2 FROM prog WHERE batch_id <= 20 GROUP BY 1),
seen AS (
  SELECT p.*, e0 >= g0 AND e1 >= g1 AND e2 >= g2 AND lag = 0 AS caught_up
  FROM prog p JOIN goal USING (name)),
recovery AS (
  SELECT name,
         min(completed_at) FILTER (
           WHERE completed_at > TIMESTAMP '2024-01-15 06:00:00' AND input_rows > 0)
           AS first_batch_after_fault_at,
         min(completed_at) FILTER (WHERE caught_up) AS final_offsets_reached_at,
         arg_min(lag, completed_at) FILTER (WHERE caught_up) AS final_lag
  FROM seen GROUP BY name)"""

# Which inputs each named expression itself needs, in order.
_NEEDS = {
    "ev": (EV, []),
    "categorised": (CATEGORISED, ["ev"]),
    "clicks": (CLICKS, ["categorised"]),
    "purchases": (PURCHASES, ["ev"]),
    "daily": (DAILY, ["clicks", "purchases"]),
    "primary_cat": (PRIMARY_PER_DAY, ["clicks"]),
    "items": (ITEMS, ["primary_cat", "purchases"]),
    "categories": (CATEGORIES, ["clicks", "purchases"]),
    "categories_primary": (CATEGORIES_PRIMARY, ["primary_cat", "purchases"]),
    "funnel": (FUNNEL, ["clicks", "purchases"]),
    "high": (HIGH, ["ev"]),
    "bot": (BOT, ["ev"]),
    "anomalies": (ANOMALIES, ["high", "bot"]),
    "timed": (LATE_INPUT, ["ev"]),
    "raw_clicks": (RAW_CLICKS, ["categorised"]),
    "raw_purchases": (RAW_PURCHASES, ["purchases"]),
    "dlq": (DLQ, ["ev"]),
    "prog": (PROGRESS, ["ev"]),
    "summ": (PROGRESS_SUMMARY, ["prog"]),
    "recovery": (RECOVERY, ["prog"]),
}


def _sql(body: str, *needs: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS[name][1]:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    return f"WITH {', '.join(_NEEDS[n][0] for n in ordered)}\n{body}"


def _mean(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(28,9))) AS DOUBLE) / nullif(count({column}), 0)"


def _round(expression: str, digits: int) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def _percent(column: str) -> str:
    """A share in percent with two digits, exact on the decimal image."""
    return f"CAST(round(CAST({column} AS DECIMAL(28,10)) * 100, 2) AS DOUBLE)"


DAILY_ROUNDED = f"""metric_date, total_clicks, total_purchases, unique_sessions, unique_items,
  {_round('conversion_rate', 4)} AS conversion_rate,
  {_round('avg_session_duration_sec', 2)} AS avg_session_duration_sec,
  {_round('avg_clicks_per_session', 2)} AS avg_clicks_per_session,
  CAST(total_revenue AS DOUBLE) AS total_revenue,
  {_round('avg_order_value', 2)} AS avg_order_value"""

ANOMALY_FIELDS = """event_id, session_id, detected_at, window_start, window_end, click_count,
  unique_items, anomaly_score, anomaly_type"""

TRENDING = """SELECT item_id, category, CAST(sum(click_count) AS BIGINT) AS total_clicks,
  CAST(sum(purchase_count) AS BIGINT) AS total_purchases,
  CAST(sum(revenue) AS DOUBLE) AS total_revenue,
  CAST((sum(rank) * 20 + count(*)) // (2 * count(*)) AS DOUBLE) / 10 AS avg_rank
FROM items WHERE metric_date >= DATE '2024-01-24' GROUP BY item_id, category
ORDER BY sum(revenue) DESC, item_id, category NULLS LAST LIMIT """

LAKE = """SELECT session_id, ts AS event_ts, item_id, category, 'click' AS event_type,
  sha256(concat_ws('|', session_id, item_id, event_ms, 'click')) AS event_id, 'lake' AS source,
  CAST(ts AS DATE) AS dt, CAST(hour(ts) AS INTEGER) AS hour FROM clicks"""

LATE_JSON = f"""SELECT event_id AS key,
  '{{"event_id":"' || event_id || '","session_id":' || session_id || ',"item_id":' || item_id
  || ',"event_type":"' || event_type || '","event_ts":"' || strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%gZ')
  || '","kafka_ingest_ts":"' || strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%gZ')
  || '","reason":"too_late"}}' AS value
FROM timed WHERE event_ts < {CUTOFF}"""

DEAD_LETTERS = """SELECT sid AS key,
  '{"producer":"click-loader","source_topic":"clicks","stage":"parse","error":"Failed to parse row: '
  || error
  || '","timestamp":"' || strftime((SELECT max(ts) FROM ev), '%Y-%m-%dT%H:%M:%S.%f+00:00')
  || '","original_data":{"Session ID":"' || sid || '","Timestamp":"' || t || '","Item ID":"' || item
  || '","Category":"' || cat || '"},"event":null}' AS value
FROM raw_clicks WHERE error IS NOT NULL"""

PURCHASE_ID = """sha256(concat_ws('|', session_id, item_id, event_ms, quantity,
  regexp_replace(CAST(price AS VARCHAR), '(\\.\\d)0$', '\\1'), 'purchase'))"""


def _check(
    table: str, kind: str, measure: str, expected: float, sign: str = "<=", bad: str = "FAIL"
) -> str:
    source = {
        "anomaly_sessions": "anomalies",
        "daily_metrics": "daily",
        "session_funnel": "funnel",
        "popular_items": "items",
    }.get(table, table)
    return f"""SELECT DATE '2024-01-31' AS check_date, '{kind}' AS check_type, '{table}' AS table_name,
  CASE WHEN v {sign} {expected:g} THEN 'PASS' ELSE '{bad}' END AS check_result,
  CAST({expected:g} AS DOUBLE) AS expected_value, v AS actual_value,
  '{kind} {sign} {expected:g}: ' || lower(CASE WHEN v {sign} {expected:g} THEN 'PASS' ELSE '{bad}' END) AS message
FROM (SELECT coalesce(CAST({measure} AS DOUBLE), 0) AS v FROM {source})"""


def _null_share(column: str) -> str:
    return (
        f"CAST(count(*) FILTER (WHERE {column} IS NULL) AS DOUBLE) / greatest(count(*), 1)"
    )


def _violations(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def _copies(*columns: str) -> str:
    key = columns[0] if len(columns) == 1 else f"({', '.join(columns)})"
    return f"count(*) - count(DISTINCT {key})"


QUALITY = "\nUNION ALL\n".join(
    [
        _check("anomaly_sessions", "row_count", "count(*)", 1, ">="),
        _check("anomaly_sessions", "null_rate:event_id", _null_share("event_id"), 0),
        _check("anomaly_sessions", "null_rate:session_id", _null_share("session_id"), 0),
        _check("anomaly_sessions", "duplicate:event_id", _copies("event_id"), 0),
        _check(
            "anomaly_sessions",
            "domain:anomaly_type",
            _violations("anomaly_type NOT IN ('HIGH_FREQUENCY', 'BOT_LIKE', 'SPAM', 'OTHER')"),
            0,
        ),
        _check("anomaly_sessions", "domain:click_count", _violations("click_count <= 0"), 0),
        _check("anomaly_sessions", "domain:unique_items", _violations("unique_items < 0"), 0),
        _check("anomaly_sessions", "domain:anomaly_score", _violations("anomaly_score < 0"), 0),
        _check("daily_metrics", "row_count", "count(*)", 1, ">="),
        _check("daily_metrics", "duplicate:metric_date", _copies("metric_date"), 0),
        *[
            _check("daily_metrics", f"domain:{c}", _violations(f"{c} < 0"), 0)
            for c in ("total_clicks", "total_purchases", "unique_sessions", "unique_items")
        ],
        _check(
            "daily_metrics",
            "domain:conversion_rate",
            _violations("conversion_rate < 0 OR conversion_rate > 1"),
            0,
            bad="WARNING",
        ),
        *[
            _check("daily_metrics", f"domain:{c}", _violations(f"{c} < 0"), 0)
            for c in ("avg_session_duration_sec", "avg_clicks_per_session", "total_revenue")
        ],
        _check(
            "daily_metrics", "null_rate:total_revenue", _null_share("total_revenue"), 0,
            bad="WARNING",
        ),
        _check("session_funnel", "row_count", "count(*)", 1, ">="),
        _check(
            "session_funnel",
            "duplicate:metric_date,funnel_stage",
            _copies("metric_date", "funnel_stage"),
            0,
        ),
        _check(
            "session_funnel",
            "domain:funnel_stage",
            _violations("funnel_stage NOT IN ('VIEW', 'MULTI_VIEW', 'ADD_TO_CART', 'PURCHASE')"),
            0,
        ),
        _check("session_funnel", "domain:session_count", _violations("session_count < 0"), 0),
        _check(
            "session_funnel",
            "domain:percentage",
            _violations("percentage < 0 OR percentage > 100"),
            0,
        ),
        _check(
            "session_funnel",
            "domain:drop_rate",
            _violations("drop_rate < 0 OR drop_rate > 1"),
            0,
            bad="WARNING",
        ),
        _check("popular_items", "row_count", "count(*)", 1, ">="),
        _check("popular_items", "duplicate:metric_date,item_id", _copies("metric_date", "item_id"), 0),
        *[
            _check("popular_items", f"domain:{c}", _violations(f"{c} < 0"), 0)
            for c in ("click_count", "purchase_count", "revenue")
        ],
        _check("popular_items", "domain:rank", _violations("rank <= 0"), 0),
        _check("popular_items", "null_rate:category", _null_share("category"), 0.5, bad="WARNING"),
        _check("events", "schema_drift", "0", 0).replace(
            "FROM events)", "FROM events LIMIT 1)"
        ),
        _check("events", "duplicate:event_id", _copies("event_id"), 0),
        _check("clicks", "null_rate:category", _null_share("category"), 0.05, bad="WARNING"),
    ]
)

CAPACITY = """, expected(name) AS (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('absent')),
figures AS (
  SELECT e.name, CAST(coalesce(s.batches, 0) AS DOUBLE) AS batches,
         CAST(s.lag_end AS DOUBLE) AS lag_end, s.trigger_ms_p95
  FROM expected e LEFT JOIN summ s USING (name))
SELECT name, 'progress' AS rule, batches AS actual, CAST(1 AS DOUBLE) AS allowed,
       batches >= 1 AS passed FROM figures
UNION ALL SELECT name, 'lag', lag_end, 0, lag_end <= 0 FROM figures
UNION ALL SELECT name, 'trigger_p95', trigger_ms_p95, 5000, trigger_ms_p95 <= 5000
FROM figures WHERE name <> 'view'"""

SUMMARY_FLAGS = """SELECT session_id, CAST(min(ts) AS DATE) AS metric_date,
  make_timestamp(min(event_ms) * 1000) AS first_event_ts,
  make_timestamp(max(event_ms) * 1000) AS last_event_ts,
  CAST((max(event_ms) - min(event_ms)) // 1000 AS INTEGER) AS duration_sec,
  count(*) FILTER (WHERE event_type <> 'purchase') AS click_count,
  count(*) FILTER (WHERE event_type = 'purchase') AS purchase_count,
  count(DISTINCT item_id) FILTER (WHERE event_type <> 'purchase') AS unique_items_viewed,
  count(DISTINCT item_id) FILTER (WHERE event_type = 'purchase') AS unique_items_purchased,
  CAST(coalesce(sum(price * quantity) FILTER (WHERE event_type = 'purchase'), 0) AS DOUBLE)
    AS total_spent,
  count(*) FILTER (WHERE event_type = 'purchase') > 0 AS is_converted,
  session_id IN (SELECT session_id FROM ev GROUP BY session_id, CAST(ts AS DATE)
                 HAVING count(*) > 3) AS is_anomaly,
  coalesce(array_to_string(list_sort(list(DISTINCT category) FILTER (
    WHERE event_type <> 'purchase' AND category IS NOT NULL)), ','), '') AS categories_viewed
FROM categorised WHERE event_type IN ('click', 'view', 'purchase') GROUP BY session_id"""

RANGE_DISTINCT = """SELECT c.week, c.clicks, c.sessions, c.items, b.total_purchases, b.total_revenue,
  true AS sessions_near, true AS items_near
FROM (SELECT CAST(date_trunc('week', metric_date) AS DATE) AS week, count(*) AS clicks,
             count(DISTINCT session_id) AS sessions, count(DISTINCT item_id) AS items
      FROM clicks GROUP BY GROUPING SETS ((1), ())) c
JOIN (SELECT CAST(date_trunc('week', metric_date) AS DATE) AS week, count(*) AS total_purchases,
             CAST(sum(price * quantity) AS DOUBLE) AS total_revenue
      FROM purchases GROUP BY GROUPING SETS ((1), ())) b ON c.week IS NOT DISTINCT FROM b.week"""

SESSION_DAYS = """, days AS (
  SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM categorised
  WHERE event_type IN ('click', 'view', 'purchase')),
marked AS (
  SELECT *, CASE WHEN day - lag(day) OVER w > 1 OR lag(day) OVER w IS NULL THEN day END AS begins
  FROM days WINDOW w AS (PARTITION BY user_id ORDER BY day)),
placed AS (
  SELECT user_id, day, max(begins) OVER (PARTITION BY user_id ORDER BY day) AS first_day FROM marked)
SELECT c.user_id AS session_id, first_day AS metric_date,
  make_timestamp(min(event_ms) * 1000) AS first_event_ts,
  make_timestamp(max(event_ms) * 1000) AS last_event_ts,
  CAST((max(event_ms) - min(event_ms)) // 1000 AS INTEGER) AS duration_sec,
  count(*) FILTER (WHERE event_type <> 'purchase') AS click_count,
  count(*) FILTER (WHERE event_type = 'purchase') AS purchase_count,
  count(DISTINCT item_id) FILTER (WHERE event_type <> 'purchase') AS unique_items_viewed,
  count(DISTINCT item_id) FILTER (WHERE event_type = 'purchase') AS unique_items_purchased,
  CAST(coalesce(sum(price * quantity) FILTER (WHERE event_type = 'purchase'), 0) AS DOUBLE)
    AS total_spent,
  count(*) FILTER (WHERE event_type = 'purchase') > 0 AS is_converted,
  coalesce(array_to_string(list_sort(list(DISTINCT category) FILTER (
    WHERE event_type <> 'purchase' AND category IS NOT NULL)), ','), '') AS categories_viewed
FROM categorised c JOIN placed p ON c.user_id = p.user_id AND CAST(c.ts AS DATE) = p.day
WHERE event_type IN ('click', 'view', 'purchase') GROUP BY 1, 2"""

SLO_BODY = """, stamped AS (
  SELECT *, epoch_us(ts) AS k0, epoch_us(ts) + eid % 700 * 1000 AS k,
         epoch_us(ts) + (eid % 700 + eid % 1100) * 1000 AS s,
         epoch_us(ts) + (eid % 700 + eid % 1100 + eid % 300) * 1000 AS w FROM ev),
lat AS (
  SELECT CAST(k - event_ms * 1000 AS DOUBLE) / 1000 AS a, CAST(s - k AS DOUBLE) / 1000 AS b,
         CAST(w - s AS DOUBLE) / 1000 AS c, CAST(w - event_ms * 1000 AS DOUBLE) / 1000 AS e
  FROM stamped WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 744 HOUR)
SELECT count(*) AS samples, quantile_cont(a, 0.5) AS p50_produce_to_kafka_ms,
  quantile_cont(b, 0.5) AS p50_kafka_to_spark_ms, quantile_cont(c, 0.5) AS p50_spark_to_db_ms,
  quantile_cont(e, 0.5) AS p50_e2e_ms, quantile_cont(e, 0.95) AS p95_e2e_ms,
  quantile_cont(e, 0.99) AS p99_e2e_ms FROM lat"""

ALERTS = """, alerts AS (
  SELECT sha256(concat_ws('|', severity, topic, offsets)) AS alert_hash,
         snapshot_ts AS time_bucket, severity, topic AS topic_name, offsets AS partition_offsets,
         printf('%s: %d more dead letters (%s)', topic, growth, lower(severity)) AS message,
         snapshot_ts AS notified_at
  FROM (SELECT *, CASE WHEN growth >= 60 THEN 'CRITICAL' WHEN growth >= 3 THEN 'WARNING'
                       ELSE 'NONE' END AS severity FROM dlq) WHERE severity <> 'NONE'),
known AS (
  SELECT sha256(concat_ws('|', severity, topic, offsets)) AS alert_hash, snapshot_ts AS time_bucket
  FROM (SELECT *, CASE WHEN growth >= 60 THEN 'CRITICAL' WHEN growth >= 3 THEN 'WARNING'
                       ELSE 'NONE' END AS severity FROM dlq)
  WHERE severity <> 'NONE' AND snapshot_ts < TIMESTAMP '2024-01-11')
SELECT a.* FROM alerts a WHERE NOT EXISTS (
  SELECT 1 FROM known k WHERE k.alert_hash = a.alert_hash AND k.time_bucket = a.time_bucket)"""

RUNS = """, days AS (
  SELECT metric_date AS d, count(*) AS n, CAST(metric_date AS TIMESTAMP) + INTERVAL 18 HOUR AS t,
         metric_date < DATE '2024-01-28' AS closed, day(metric_date) % 7 = 0 AS failed
  FROM ev GROUP BY 1)
SELECT strftime(d, '%Y%m%d') AS run_id, 'daily' AS pipeline_name, d AS run_date, t AS start_time,
  CASE WHEN closed THEN t + INTERVAL 10 MINUTE END AS end_time,
  CASE WHEN NOT closed THEN 'RUNNING' WHEN failed THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN closed AND NOT failed THEN n END AS records_processed,
  CASE WHEN closed AND failed THEN 'no click data' END AS error_message,
  CASE WHEN closed THEN t + INTERVAL 10 MINUTE ELSE t END AS recorded_at FROM days"""

CONTINUITY = """, chained AS (
  SELECT *, lag(e0) OVER w AS p0, lag(e1) OVER w AS p1, lag(e2) OVER w AS p2,
         row_number() OVER w AS place, e0 - n0 + gap AS s0, e1 - n1 + gap AS s1, e2 - n2 + gap AS s2
  FROM prog WINDOW w AS (PARTITION BY name ORDER BY batch_id))
SELECT name, count(*) AS batches_observed, 'run-' || name AS run_ids,
  CAST(sum(input_rows) AS BIGINT) AS input_rows_total,
  CAST(arg_max(e0 + e1 + e2, batch_id) - arg_min(s0 + s1 + s2, batch_id) AS BIGINT)
    AS logical_offset_span,
  CAST(sum(input_rows) - arg_max(e0 + e1 + e2, batch_id) + arg_min(s0 + s1 + s2, batch_id) AS BIGINT)
    AS input_rows_retry_overcount,
  bool_and(place = 1 OR (p0 = s0 AND p1 = s1 AND p2 = s2)) AS offsets_contiguous,
  max(lag) AS lag_max
FROM chained GROUP BY name"""

ORACLE: dict[str, str] = {
    "daily_metrics": _sql(
        "SELECT * REPLACE (CAST(total_revenue AS DOUBLE) AS total_revenue) FROM daily", "daily"
    ),
    "click_totals": _sql(
        """SELECT metric_date, count(*) AS total_clicks, count(DISTINCT session_id) AS unique_sessions,
  count(DISTINCT item_id) AS unique_items FROM clicks GROUP BY 1""",
        "clicks",
    ),
    "purchase_totals": _sql(
        """SELECT metric_date, count(*) AS total_purchases,
  count(DISTINCT session_id) AS purchase_sessions,
  CAST(sum(price * quantity) AS DOUBLE) AS total_revenue FROM purchases GROUP BY 1""",
        "purchases",
    ),
    "session_stats": _sql(
        """SELECT metric_date, session_id, count(*) AS clicks_per_session,
  CAST(max(event_ms) - min(event_ms) AS DOUBLE) / 1000 AS duration_sec FROM clicks GROUP BY 1, 2""",
        "clicks",
    ),
    "session_averages": _sql(
        "SELECT metric_date, avg_clicks_per_session, avg_session_duration_sec FROM daily", "daily"
    ),
    "file_totals": _sql(
        """SELECT count(*) AS events, CAST(sum(price * quantity) AS DOUBLE) AS total_revenue,
  min(ts) AS first_event_ts, max(ts) AS last_event_ts FROM purchases""",
        "purchases",
    ),
    "clicks_per_item": _sql(
        "SELECT metric_date, item_id, count(*) AS click_count FROM clicks GROUP BY 1, 2", "clicks"
    ),
    "purchases_per_item": _sql(
        """SELECT metric_date, item_id, count(*) AS purchase_count,
  CAST(sum(price * quantity) AS DOUBLE) AS revenue FROM purchases GROUP BY 1, 2""",
        "purchases",
    ),
    "item_primary_category": _sql(
        """SELECT item_id, category, n AS category_clicks FROM (
  SELECT item_id, category, count(*) AS n, row_number() OVER (
    PARTITION BY item_id ORDER BY count(*) DESC, category ASC NULLS LAST) AS place
  FROM clicks GROUP BY 1, 2) WHERE place = 1""",
        "clicks",
    ),
    "popular_items": _sql(
        "SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM items", "items"
    ),
    "category_clicks": _sql(
        """SELECT metric_date, category, count(*) AS click_count,
  count(DISTINCT item_id) AS unique_items
FROM clicks WHERE category IS NOT NULL GROUP BY 1, 2""",
        "clicks",
    ),
    "category_purchases": _sql(
        f"""SELECT x.metric_date, x.category, count(*) AS purchase_count,
  CAST(sum(b.price * b.quantity) AS DOUBLE) AS revenue
FROM purchases b JOIN ({EVERY_PAIR}) x USING (metric_date, item_id)
WHERE x.category IS NOT NULL GROUP BY 1, 2""",
        "clicks",
        "purchases",
    ),
    "popular_categories": _sql(
        "SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM categories", "categories"
    ),
    "popular_categories_primary": _sql(
        "SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM categories_primary",
        "categories_primary",
    ),
    "funnel_sessions": _sql(
        "SELECT *, purchase_count > 0 AS has_purchase FROM sess", "funnel"
    ),
    "session_funnel": _sql("SELECT * FROM funnel", "funnel"),
    "session_summary": _sql(SUMMARY_FLAGS, "categorised"),
    "session_days": _sql(SESSION_DAYS, "categorised"),
    "incremental_daily": _sql(
        """SELECT * EXCLUDE (avg_session_duration_sec)
  REPLACE (CAST(total_revenue AS DOUBLE) AS total_revenue) FROM daily""",
        "daily",
    ),
    "incremental_items": _sql(
        "SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM items", "items"
    ),
    "range_distinct": _sql(RANGE_DISTINCT, "clicks", "purchases"),
    "detect_high_frequency": _sql("SELECT * FROM high", "high"),
    "detect_bot_like": _sql("SELECT * FROM bot", "bot"),
    "stream_high_frequency": _sql("SELECT * FROM high", "high"),
    "stream_bot_like": _sql("SELECT * FROM bot", "bot"),
    "stream_detection_job": _sql("SELECT * FROM anomalies", "anomalies"),
    "stream_dedup": _sql(
        """SELECT CAST(eid AS VARCHAR) AS event_id, user_id AS session_id, event_type AS item_id,
  ts AS event_ts, ts + to_microseconds(eid % 700 * 1000) AS kafka_ingest_ts FROM ev""",
        "ev",
    ),
    "stream_late_events": _sql(LATE_JSON, "timed"),
    "stream_lake": _sql(LAKE, "clicks"),
    "late_events": _sql(f"SELECT * FROM timed WHERE event_ts < {CUTOFF}", "timed"),
    "on_time_events": _sql(f"SELECT * FROM timed WHERE event_ts >= {CUTOFF}", "timed"),
    "late_payload": _sql(LATE_JSON, "timed"),
    "repaired_events": _sql(
        """SELECT eid, session_id, make_timestamp(event_ms * 1000) AS event_ts, item_id, event_type,
  CASE WHEN eid % 3 = 1 THEN CAST(eid AS VARCHAR)
       ELSE sha256(concat_ws('|', session_id, item_id, event_ms, event_type)) END AS event_id,
  CASE WHEN eid % 3 = 1 THEN make_timestamp((event_ms + 5) * 1000)
       ELSE ts + INTERVAL 2 SECOND END AS ingest_ts,
  ts + INTERVAL 2 SECOND AS kafka_ingest_ts FROM ev""",
        "ev",
    ),
    "event_ids": _sql(
        "SELECT eid, sha256(concat_ws('|', session_id, item_id, event_ms, 'click')) AS event_id FROM clicks",
        "clicks",
    ),
    "purchase_event_ids": _sql(
        f"SELECT eid, {PURCHASE_ID} AS event_id FROM purchases", "purchases"
    ),
    "valid_events": _sql(
        """SELECT session_id, make_timestamp(event_ms * 1000) AS event_ts, item_id, category,
  'click' AS event_type, sha256(concat_ws('|', session_id, item_id, event_ms, 'click')) AS event_id,
  'producer_clicks' AS source FROM raw_clicks WHERE error IS NULL""",
        "raw_clicks",
    ),
    "dead_letters": _sql(DEAD_LETTERS, "raw_clicks"),
    "valid_purchases": _sql(
        f"""SELECT session_id, make_timestamp(event_ms * 1000) AS event_ts, item_id,
  CAST(price AS DOUBLE) AS price, quantity, 'purchase' AS event_type, {PURCHASE_ID} AS event_id,
  'producer_purchases' AS source FROM raw_purchases WHERE error IS NULL""",
        "raw_purchases",
    ),
    "rejected_purchases": _sql(
        "SELECT error, count(*) AS rows FROM raw_purchases WHERE error IS NOT NULL GROUP BY 1",
        "raw_purchases",
    ),
    "category_normalised": _sql(
        "SELECT eid, CASE WHEN eid % 4 <> 0 THEN category END AS category FROM categorised",
        "categorised",
    ),
    "one_day": _sql(
        """SELECT eid, ts AS event_ts, session_id, item_id, event_type FROM ev
WHERE metric_date = DATE '2024-01-15'""",
        "ev",
    ),
    "rebased_events": _sql(
        "SELECT eid, TIMESTAMP '2030-06-01' + (ts - date_trunc('day', ts)) AS event_ts FROM ev", "ev"
    ),
    "shifted_events": _sql(
        """SELECT eid, make_timestamp(epoch_us(TIMESTAMP '2030-06-01 10:00:00') + epoch_us(ts)
  - (SELECT min(epoch_us(ts)) FROM ev)) AS event_ts FROM ev""",
        "ev",
    ),
    "sorted_events": _sql("SELECT ts AS event_ts, eid, session_id FROM ev ORDER BY ts, eid", "ev"),
    "lake_roundtrip": _sql(LAKE, "clicks"),
    "lake_day": _sql(f"SELECT * FROM ({LAKE}) WHERE dt = DATE '2024-01-15'", "clicks"),
    "stream_anomaly_table": _sql(
        f"""SELECT {ANOMALY_FIELDS} FROM anomalies WHERE anomaly_type = 'BOT_LIKE' AND anomaly_score >= 0.5
ORDER BY detected_at DESC, event_id LIMIT 100""",
        "anomalies",
    ),
    "routed_events": _sql(
        f"""SELECT CASE WHEN eid % 40 = 0 THEN 'undecodable' WHEN eid % 30 = 0 THEN 'no_event_time'
  WHEN ts < {CUTOFF} THEN 'late' ELSE 'on_time' END AS route, count(*) AS rows
FROM ev GROUP BY 1""",
        "ev",
    ),
    "replace_date_roundtrip": _sql(
        """SELECT metric_date, CASE WHEN metric_date = DATE '2024-01-15' THEN total_clicks + 1000
  ELSE total_clicks END AS total_clicks, CAST(total_revenue AS DOUBLE) AS total_revenue
FROM daily WHERE metric_date <> DATE '2024-01-20'""",
        "daily",
    ),
    "upsert_roundtrip": _sql(
        """SELECT session_id, window_start, anomaly_type,
  CASE WHEN anomaly_type = 'HIGH_FREQUENCY' AND click_count > 4 THEN click_count * 10
       ELSE click_count END AS click_count, CAST(window_start AS DATE) AS window_date
FROM anomalies UNION ALL SELECT NULL, NULL, NULL, 2, NULL""",
        "anomalies",
    ),
    "recent_anomalies": _sql(
        f"""SELECT {ANOMALY_FIELDS} FROM anomalies WHERE anomaly_type = 'BOT_LIKE' AND anomaly_score >= 0.5
ORDER BY detected_at DESC, event_id LIMIT 100""",
        "anomalies",
    ),
    "anomaly_types": _sql(
        f"""SELECT anomaly_type, count(*) AS count, {_mean('anomaly_score')} AS avg_score,
  max(detected_at) AS last_detected FROM anomalies GROUP BY 1""",
        "anomalies",
    ),
    "anomaly_timeline": _sql(
        f"""SELECT CAST(date_trunc('hour', detected_at) AS TIMESTAMP) AS hour, count(*) AS anomaly_count,
  count(DISTINCT session_id) AS unique_sessions, {_mean('anomaly_score')} AS avg_score
FROM anomalies WHERE detected_at >= TIMESTAMP '2024-01-31' - INTERVAL 168 HOUR GROUP BY 1""",
        "anomalies",
    ),
    "anomalies_for_session": _sql(
        f"SELECT {ANOMALY_FIELDS} FROM anomalies WHERE session_id = 7", "anomalies"
    ),
    "daily_range": _sql(
        f"""SELECT {DAILY_ROUNDED} FROM daily
WHERE metric_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""",
        "daily",
    ),
    "daily_for_date": _sql(
        f"SELECT {DAILY_ROUNDED} FROM daily WHERE metric_date = DATE '2024-01-15'", "daily"
    ),
    "funnel_for_date": _sql(
        f"""SELECT funnel_stage, session_count, {_round('percentage', 2)} AS percentage,
  {_round('drop_rate', 4)} AS drop_rate FROM funnel WHERE metric_date = DATE '2024-01-15'""",
        "funnel",
    ),
    "summary": _sql(
        f"""SELECT CAST(count(*) AS INTEGER) AS days_processed,
  CAST(sum(total_clicks) AS BIGINT) AS total_clicks,
  CAST(sum(total_purchases) AS BIGINT) AS total_purchases,
  CAST(sum(unique_sessions) AS BIGINT) AS total_sessions,
  {_round(_mean('conversion_rate'), 4)} AS avg_conversion_rate,
  CAST(round(sum(total_revenue), 0) AS BIGINT) AS total_revenue,
  {_round(_mean('avg_clicks_per_session'), 2)} AS avg_clicks_per_session
FROM daily WHERE metric_date >= DATE '2024-01-24'""",
        "daily",
    ),
    "popular_for_date": _sql(
        f"""SELECT item_id, category, click_count, purchase_count, CAST(revenue AS DOUBLE) AS revenue,
  rank, {_round('click_to_purchase_ratio', 2)} AS click_to_purchase_ratio
FROM items WHERE metric_date = DATE '2024-01-15' AND rank <= 50""",
        "items",
    ),
    "categories_for_date": _sql(
        """SELECT category, click_count, purchase_count, unique_items,
  CAST(revenue AS DOUBLE) AS revenue, rank
FROM categories WHERE metric_date = DATE '2024-01-15'""",
        "categories",
    ),
    "trending_items": _sql(TRENDING + "20", "items"),
    "view_recent_anomalies": _sql(
        f"""SELECT {ANOMALY_FIELDS}, CAST((2 * (epoch_us(last_event_ts) - epoch_us(first_event_ts)) + 600000)
  // 1200000 AS DOUBLE) / 100 AS window_duration_minutes
FROM anomalies WHERE detected_at >= TIMESTAMP '2024-01-29 23:00:00'""",
        "anomalies",
    ),
    "view_daily_summary": _sql(
        f"""SELECT metric_date, total_clicks, total_purchases, unique_sessions,
  {_percent('conversion_rate')} AS conversion_rate_pct,
  {_round('avg_clicks_per_session', 2)} AS avg_clicks_per_session,
  {_round('avg_session_duration_sec / 60', 2)} AS avg_session_duration_minutes,
  CAST(total_revenue AS DOUBLE) AS total_revenue,
  CASE WHEN total_purchases > 0
       THEN {_round('CAST(total_revenue AS DOUBLE) / total_purchases', 2)} ELSE 0.0 END
    AS avg_order_value
FROM daily WHERE metric_date >= DATE '2024-01-01'""",
        "daily",
    ),
    "view_top_items": _sql(TRENDING + "50", "items"),
    "view_latest_funnel": _sql(
        f"""SELECT funnel_stage, session_count, {_round('percentage', 2)} AS percentage,
  {_percent('drop_rate')} AS drop_rate_pct
FROM funnel WHERE metric_date = (SELECT max(metric_date) FROM funnel)""",
        "funnel",
    ),
    "system_stats": _sql(
        """SELECT (SELECT count(*) FROM anomalies) AS total_anomalies,
  (SELECT count(*) FROM daily) AS days_processed, (SELECT count(*) FROM items) AS total_popular_items,
  (SELECT max(detected_at) FROM anomalies) AS last_anomaly_detected,
  (SELECT max(metric_date) FROM daily) AS last_metrics_date""",
        "anomalies",
        "daily",
        "items",
    ),
    "system_health": _sql(
        """SELECT 'anomaly_sessions' AS table_name, count(*) AS row_count, max(detected_at) AS last_update
FROM anomalies
UNION ALL SELECT 'daily_metrics', count(*), CAST(max(metric_date) AS TIMESTAMP) FROM daily
UNION ALL SELECT 'popular_items', count(*), CAST(max(metric_date) AS TIMESTAMP) FROM items""",
        "anomalies",
        "daily",
        "items",
    ),
    "row_counts_for_date": _sql(
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS count FROM {source} "
            "WHERE metric_date = DATE '2024-01-15'"
            for name, source in [
                ("daily_metrics", "daily"),
                ("popular_items", "items"),
                ("popular_categories", "categories"),
                ("session_funnel", "funnel"),
            ]
        ),
        "daily",
        "items",
        "categories",
        "funnel",
    ),
    "duplicate_keys": _sql(
        """SELECT session_id, item_id, count(*) AS copies FROM clicks
GROUP BY 1, 2 HAVING count(*) > 1""",
        "clicks",
    ),
    "kpi_anomalies": _sql(
        f"""SELECT count(*) AS total, {_round(_mean('anomaly_score'), 2)} AS avg_score,
  max(click_count) AS max_clicks FROM anomalies""",
        "anomalies",
    ),
    "kpi_daily": _sql(
        f"""SELECT CAST(sum(total_clicks) AS BIGINT) AS total_clicks,
  CAST(sum(total_purchases) AS BIGINT) AS total_purchases,
  {_round(_mean('conversion_rate'), 4)} AS avg_conversion,
  CAST(sum(total_revenue) AS DOUBLE) AS total_revenue FROM daily""",
        "daily",
    ),
    "score_quartiles": _sql(
        """SELECT min(anomaly_score) AS lowest, quantile_cont(anomaly_score, 0.25) AS q1,
  quantile_cont(anomaly_score, 0.5) AS median, quantile_cont(anomaly_score, 0.75) AS q3,
  max(anomaly_score) AS highest FROM anomalies""",
        "anomalies",
    ),
    "dlq_growth": _sql(
        "SELECT topic, snapshot_ts, current_total, offsets, previous_total, growth FROM dlq", "dlq"
    ),
    "alert_history": _sql(ALERTS, "dlq").replace("\n, alerts", ", alerts"),
    "retention": _sql(
        """SELECT event_id, session_id, CAST(window_start AS DATE) AS window_date FROM high
WHERE window_start >= TIMESTAMP '2024-01-21'""",
        "high",
    ),
    "expired_partitions": _sql(
        """SELECT CAST(window_start AS DATE) AS window_date, count(*) AS dropped_rows FROM high
WHERE window_start < TIMESTAMP '2024-01-21' GROUP BY 1""",
        "high",
    ),
    "run_history": _sql(RUNS, "ev"),
    "quality_checks": _sql(QUALITY, "anomalies", "daily", "funnel", "items"),
    "slo_latency": _sql(SLO_BODY, "ev"),
    "progress_summary": _sql("SELECT * FROM summ", "summ"),
    "offset_continuity": _sql(CONTINUITY, "prog"),
    "query_recovery": _sql("SELECT * FROM recovery", "recovery"),
    "recovery_time": _sql(
        """SELECT count(final_offsets_reached_at) AS queries_recovered,
  CASE WHEN count(final_offsets_reached_at) = count(*) THEN max(final_offsets_reached_at) END
    AS all_recovered_at,
  CASE WHEN count(final_offsets_reached_at) = count(*)
       THEN CAST(epoch_us(max(final_offsets_reached_at))
            - epoch_us(TIMESTAMP '2024-01-15 06:00:00') AS DOUBLE) / 1000000 END AS recovery_seconds
FROM recovery""",
        "recovery",
    ),
    "capacity_checks": _sql(CAPACITY, "summ"),
}

# The same rows another way.
ORACLE |= {
    "csv_clicks": ORACLE["valid_events"],
    "csv_purchases": ORACLE["valid_purchases"],
    "stream_resume": ORACLE["stream_dedup"],
    "stream_append": ORACLE["stream_dedup"],
    "stream_state": _sql(
        """SELECT CAST(0 AS BIGINT) AS operator_id, 'dedupeWithinWatermark' AS operator_name,
  8 AS partitions, count(*) AS keys, true AS has_bytes
FROM ev WHERE ts > (SELECT max(ts) FROM ev) - INTERVAL 2 DAY""",
        "ev",
    ),
    "slo_report": _sql(SLO_BODY.replace("SELECT count(*) AS samples", "SELECT 744 AS window_hours, count(*) AS samples"), "ev"),
    "stream_latency": "SELECT count(*) AS rows, count(*) AS samples, "
    + ", ".join(
        f"true AS p{p}_{stage}_ms"
        for stage in ("produce_to_kafka", "kafka_to_spark", "spark_to_db", "e2e")
        for p in (50, 95, 99)
    )
    + " FROM events",
    "stream_trending": _sql(
        """SELECT *, CAST(0 AS BIGINT) AS most_error FROM (
  SELECT metric_date AS bucket_date, item_id, count(*) AS clicks,
         row_number() OVER (PARTITION BY metric_date ORDER BY count(*) DESC, item_id) AS rank,
         CAST(sum(count(*)) OVER (PARTITION BY metric_date) AS BIGINT) AS group_clicks
  FROM clicks WHERE item_id IS NOT NULL GROUP BY 1, 2) WHERE rank <= 10""",
        "clicks",
    ),
    "stream_trending_range": _sql(
        """SELECT item_id, count(*) AS clicks, row_number() OVER (ORDER BY count(*) DESC, item_id) AS rank,
  CAST(sum(count(*)) OVER () AS BIGINT) AS group_clicks, CAST(0 AS BIGINT) AS most_error
FROM clicks WHERE item_id IS NOT NULL AND ts >= TIMESTAMP '2024-01-24'
GROUP BY 1 ORDER BY rank LIMIT 20""",
        "clicks",
    ),
    "sql_recent_anomalies": ORACLE["view_recent_anomalies"],
    "sql_daily_summary": ORACLE["view_daily_summary"],
    "sql_top_items": ORACLE["view_top_items"],
    "sql_latest_funnel": ORACLE["view_latest_funnel"],
}

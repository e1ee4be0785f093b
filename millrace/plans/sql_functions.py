"""The dashboard views as SQL table functions with the time as an argument.

    register(spark, {"daily_metrics": ..., ...})
    spark.sql("SELECT * FROM daily_summary(DATE'2026-01-12', 30)")

They give the rows of the DataFrame forms in serving.py, for users who have SQL
only. A function is expanded into the calling query, so its filters reach the scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def _rounded(expression: str, digits: int) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


#: Table, arguments, result columns and body of each function.
FUNCTIONS: dict[str, tuple[str, str, str, str]] = {
    "recent_anomaly_sessions": (
        "anomaly_sessions",
        "as_of TIMESTAMP, hours INT DEFAULT 24",
        "event_id STRING, session_id BIGINT, detected_at TIMESTAMP, window_start TIMESTAMP, "
        "window_end TIMESTAMP, click_count BIGINT, unique_items BIGINT, anomaly_score DOUBLE, "
        "anomaly_type STRING, window_duration_minutes DOUBLE",
        """SELECT event_id, session_id, detected_at, window_start, window_end, click_count,
  unique_items, anomaly_score, anomaly_type,
  CAST(round(CAST(unix_micros(last_event_ts) - unix_micros(first_event_ts) AS DECIMAL(18,0))
    / 60000000, 2) AS DOUBLE)
FROM {table} WHERE detected_at >= as_of - make_dt_interval(0, hours)""",
    ),
    "daily_summary": (
        "daily_metrics",
        "as_of DATE, days INT DEFAULT 30",
        "metric_date DATE, total_clicks BIGINT, total_purchases BIGINT, unique_sessions BIGINT, "
        "conversion_rate_pct DOUBLE, avg_clicks_per_session DOUBLE, "
        "avg_session_duration_minutes DOUBLE, total_revenue DECIMAL(15,2), avg_order_value DOUBLE",
        f"""SELECT metric_date, total_clicks, total_purchases, unique_sessions,
  CAST(round(CAST(conversion_rate AS DECIMAL(28,10)) * 100, 2) AS DOUBLE),
  {_rounded("avg_clicks_per_session", 2)},
  {_rounded("avg_session_duration_sec / 60.0D", 2)},
  total_revenue,
  CASE WHEN total_purchases > 0
       THEN {_rounded("CAST(total_revenue AS DOUBLE) / total_purchases", 2)} ELSE 0.0D END
FROM {{table}} WHERE metric_date >= date_sub(as_of, days)""",
    ),
    "top_items": (
        "popular_items",
        "as_of DATE, days INT DEFAULT 7, places INT DEFAULT 50",
        "item_id BIGINT, category STRING, total_clicks BIGINT, total_purchases BIGINT, "
        "total_revenue DECIMAL(25,2), avg_rank DOUBLE",
        """SELECT item_id, category, total_clicks, total_purchases, total_revenue, avg_rank FROM (
  SELECT *, row_number() OVER (ORDER BY total_revenue DESC, item_id, category NULLS LAST) AS place
  FROM (SELECT item_id, category, sum(click_count) AS total_clicks,
               sum(purchase_count) AS total_purchases, sum(revenue) AS total_revenue,
               CAST(round(CAST(sum(rank) AS DECIMAL(18,0)) / CAST(count(*) AS DECIMAL(18,0)), 1)
                    AS DOUBLE) AS avg_rank
        FROM {table} WHERE metric_date >= date_sub(as_of, days) GROUP BY item_id, category))
WHERE place <= places""",
    ),
    "latest_funnel": (
        "session_funnel",
        "",
        "funnel_stage STRING, session_count BIGINT, percentage DOUBLE, drop_rate_pct DOUBLE",
        f"""SELECT funnel_stage, session_count, {_rounded("percentage", 2)},
  CAST(round(CAST(drop_rate AS DECIMAL(28,10)) * 100, 2) AS DOUBLE)
FROM {{table}} WHERE metric_date = (SELECT max(metric_date) FROM {{table}})""",
    ),
}


def register(spark: SparkSession, tables: Mapping[str, DataFrame]) -> list[str]:
    """Create the functions whose table is given, for this session; their names.

    The tables become temporary views of the same name with ``millrace_`` before it.
    """
    made = []
    for name, (table, arguments, columns, body) in FUNCTIONS.items():
        if table in tables:
            view = f"millrace_{table}"
            tables[table].createOrReplaceTempView(view)
            spark.sql(
                f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) "
                f"RETURNS TABLE ({columns}) RETURN {body.format(table=view)}"
            )
            made.append(name)
    return made

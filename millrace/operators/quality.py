"""Data-quality checks: one aggregation per table, one row per rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas as S
from millrace.functions import times


@dataclass(frozen=True)
class Rule:
    """``measure`` aggregates the table; the check holds when it compares well.

    ``at_most`` checks measure <= expected, otherwise measure >= expected.
    ``on_failure`` is FAIL or WARNING.
    """

    check_type: str
    measure: Column
    expected: float
    at_most: bool = True
    on_failure: str = "FAIL"


def min_rows(n: int = 1) -> Rule:
    return Rule("row_count", F.count(F.lit(1)), float(n), at_most=False)


def null_rate(column: str, limit: float = 0.0, on_failure: str = "FAIL") -> Rule:
    share = F.count_if(F.col(column).isNull()).cast("double") / F.greatest(
        F.count(F.lit(1)), F.lit(1)
    )
    return Rule(f"null_rate:{column}", share, limit, on_failure=on_failure)


def no_duplicates(*columns: str) -> Rule:
    """Rows beyond the first of each key (rows with a null key part do not count)."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    extra = F.count_if(complete) - F.count_distinct(*[F.col(c) for c in columns])
    return Rule(f"duplicate:{','.join(columns)}", extra.cast("double"), 0.0)


def domain(name: str, violation: Column, on_failure: str = "FAIL") -> Rule:
    return Rule(f"domain:{name}", F.count_if(violation).cast("double"), 0.0, on_failure=on_failure)


def schema_drift(df: DataFrame, expected: T.StructType) -> Rule:
    """Columns missing, added or of another type; known without reading any row."""
    want = {f.name: f.dataType for f in expected.fields}
    have = {f.name: f.dataType for f in df.schema.fields}
    drifted = [n for n in sorted(want.keys() | have.keys()) if want.get(n) != have.get(n)]
    return Rule("schema_drift", F.max(F.lit(float(len(drifted)))), 0.0)


def quality_checks(
    df: DataFrame, table: str, rules: Sequence[Rule], check_date: object
) -> DataFrame:
    """One row per rule. All measures come from a single pass over the table."""
    measured = df.agg(
        *[F.coalesce(r.measure.cast("double"), F.lit(0.0)).alias(f"m{i}") for i, r in enumerate(rules)]
    )

    def row(i: int, rule: Rule) -> Column:
        actual = F.col(f"m{i}")
        holds = actual <= rule.expected if rule.at_most else actual >= rule.expected
        result = F.when(holds, "PASS").otherwise(rule.on_failure)
        sign = "<=" if rule.at_most else ">="
        message = F.concat(
            F.lit(f"{rule.check_type} {sign} {rule.expected:g}: "), F.lower(result)
        )
        return F.struct(
            F.lit(rule.check_type).alias("check_type"),
            F.lit(table).alias("table_name"),
            result.alias("check_result"),
            F.lit(rule.expected).alias("expected_value"),
            actual.alias("actual_value"),
            message.alias("message"),
        )

    rows = F.inline(F.array(*[row(i, r) for i, r in enumerate(rules)]))
    return measured.select(times.as_column(check_date).cast("date").alias("check_date"), rows)


def _outside(column: str, allowed: Sequence[str]) -> Column:
    return ~F.col(column).isin(*allowed)


def _below(column: str, limit: float = 0) -> Column:
    return F.col(column) < limit


def _not_share(column: str, top: float) -> Column:
    return (F.col(column) < 0) | (F.col(column) > top)


def anomaly_rules() -> list[Rule]:
    return [
        min_rows(),
        null_rate("event_id"),
        null_rate("session_id"),
        no_duplicates("event_id"),
        domain("anomaly_type", _outside("anomaly_type", S.ANOMALY_TYPES)),
        domain("click_count", F.col("click_count") <= 0),
        domain("unique_items", _below("unique_items")),
        domain("anomaly_score", _below("anomaly_score")),
    ]


def daily_rules() -> list[Rule]:
    """Conversion above one is possible (buyers without clicks) and only a warning."""
    return [
        min_rows(),
        no_duplicates("metric_date"),
        *[
            domain(c, _below(c))
            for c in ("total_clicks", "total_purchases", "unique_sessions", "unique_items")
        ],
        domain("conversion_rate", _not_share("conversion_rate", 1), "WARNING"),
        domain("avg_session_duration_sec", _below("avg_session_duration_sec")),
        domain("avg_clicks_per_session", _below("avg_clicks_per_session")),
        domain("total_revenue", _below("total_revenue")),
        null_rate("total_revenue", 0.0, "WARNING"),
    ]


def funnel_rules() -> list[Rule]:
    """A negative drop rate is possible (single-click buyers) and only a warning."""
    return [
        min_rows(),
        no_duplicates("metric_date", "funnel_stage"),
        domain("funnel_stage", _outside("funnel_stage", S.FUNNEL_STAGES)),
        domain("session_count", _below("session_count")),
        domain("percentage", _not_share("percentage", 100)),
        domain("drop_rate", _not_share("drop_rate", 1), "WARNING"),
    ]


def item_rules() -> list[Rule]:
    return [
        min_rows(),
        no_duplicates("metric_date", "item_id"),
        domain("click_count", _below("click_count")),
        domain("purchase_count", _below("purchase_count")),
        domain("revenue", _below("revenue")),
        domain("rank", F.col("rank") <= 0),
        null_rate("category", 0.5, "WARNING"),
    ]

"""Audit of a day's bars before publishing: counts, rejection rate, quality gate, session length."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..plans.rules import BAR_RULES, rule

FAIL_PCT, WARN_PCT = 1.0, 0.5


def daily_counts(bars: DataFrame, rules: Mapping[str, str] = BAR_RULES, strict: bool = False) -> DataFrame:
    """(audit_date, total_count, rejected_count, rejected_<rule>): a row counts under the first rule it breaks."""
    counts, earlier = [], None
    for name, text in rules.items():
        broken = ~rule(text, strict)
        mine = broken if earlier is None else F.coalesce(~earlier, F.lit(True)) & broken
        counts.append(F.count_if(mine).alias(f"rejected_{name}"))
        earlier = broken if earlier is None else earlier | broken
    return bars.groupBy(F.col("date").alias("audit_date")).agg(F.count(F.lit(1)).alias("total_count"), F.count_if(earlier).alias("rejected_count"), *counts)


def session_bars(bars: DataFrame) -> DataFrame:
    """(audit_date, session_bars): bars of the symbol that has most on a date."""
    each = bars.groupBy(F.col("date").alias("audit_date"), "symbol").agg(F.count(F.lit(1)).alias("bars"))
    return each.groupBy("audit_date").agg(F.max("bars").alias("session_bars"))


def gate(counts: DataFrame, fail_pct: float = FAIL_PCT, warn_pct: float = WARN_PCT) -> DataFrame:
    """Adds valid_count, rejection_rate_pct, quality_gate_passed (below fail_pct), quality_gate_warning."""
    rate = F.when(F.col("total_count") > 0, F.col("rejected_count") * 100.0 / F.col("total_count")).otherwise(0.0)
    return (
        counts.withColumn("valid_count", F.col("total_count") - F.col("rejected_count"))
        .withColumn("rejection_rate_pct", rate.cast("double"))
        .withColumn("quality_gate_passed", F.col("rejection_rate_pct") < fail_pct)
        .withColumn("quality_gate_warning", F.col("rejection_rate_pct") >= warn_pct)
    )


def audit_log(bars: DataFrame, recent: DataFrame | None = None, rules: Mapping[str, str] = BAR_RULES, strict: bool = False) -> DataFrame:
    """The audit of each date of bars; session length only for dates of recent, null for others."""
    log = gate(daily_counts(bars, rules, strict))
    sessions = session_bars(bars if recent is None else recent)
    return log.join(sessions, "audit_date", "left")

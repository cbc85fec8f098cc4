"""Validation rules and declarative expectations.

Rules follow three-valued logic: a null price makes a rule null, and such a row is neither kept nor
quarantined, though an audit counts it as valid.  ``strict`` counts null as a violation everywhere.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

BAR_RULES: dict[str, str] = {
    "price_positive": "open > 0 AND high > 0 AND low > 0 AND close > 0",
    "ohlc_logic": "low <= high AND open BETWEEN low AND high AND close BETWEEN low AND high",
    "volume": "volume >= 0",
}
NEWS_RULES: dict[str, str] = {
    "title": "title IS NOT NULL AND length(trim(title)) > 0",
    "url": "article_url IS NOT NULL AND article_url RLIKE '^https?://[^ ]+$'",
    "timestamp_order": "try_to_timestamp(published_utc) IS NOT NULL AND try_to_timestamp(published_utc) <= ingestion_timestamp",
}


def rule(text: str, strict: bool = False) -> Column:
    out = F.expr(f"({text})")
    return F.coalesce(out, F.lit(False)) if strict else out


def all_valid(rules: Mapping[str, str], strict: bool = False) -> Column:
    return rule(" AND ".join(f"({r})" for r in rules.values()), strict)


def rejection_reason(rules: Mapping[str, str], strict: bool = False) -> Column:
    """invalid_<name> of the first rule that is false, in the order of the rules."""
    out = F.lit("unknown")
    for name, text in reversed(rules.items()):
        out = F.when(~rule(text, strict), f"invalid_{name}").otherwise(out)
    return out


class ExpectationFailed(RuntimeError):
    """A table broke an expectation that must hold."""


@dataclass(frozen=True)
class Expectation:
    """A rule that rows must meet. kind: fail stops the update, drop leaves rows out, warn only counts.

    A rule that is null counts as broken unless null_passes.
    """

    name: str
    rule: str
    kind: str = "fail"
    null_passes: bool = False

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(f"({self.rule})"), F.lit(self.null_passes))


@dataclass
class Checked:
    """A DataFrame under expectations. Counts come with the action that computes it, in one pass."""

    table: str
    df: DataFrame
    expectations: tuple[Expectation, ...]
    observation: Observation

    def counts(self) -> list[dict]:
        """Passed and failed rows of each expectation, once df has been computed."""
        seen = self.observation.get
        rows = seen["rows"]
        return [{"dataset": self.table, "name": e.name, "kind": e.kind, "passed_records": rows - (seen[e.name] or 0), "failed_records": seen[e.name] or 0} for e in self.expectations]

    def verify(self) -> list[dict]:
        """Raises if a fail expectation was broken; call it before what was written is published."""
        found = self.counts()
        broken = [f"{x['name']} ({x['failed_records']} rows)" for x in found if x["kind"] == "fail" and x["failed_records"]]
        if broken:
            raise ExpectationFailed(f"{self.table}: {', '.join(broken)}")
        return found


def expect(df: DataFrame, table: str, *expectations: Expectation) -> Checked:
    seen = Observation(f"expect_{table}")
    broken = [F.sum(F.when(e.holds, 0).otherwise(1)).alias(e.name) for e in expectations]
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"), *broken)
    for e in expectations:
        if e.kind == "drop":
            out = out.where(e.holds)
    return Checked(table, out, expectations, seen)


def violations(df: DataFrame, *expectations: Expectation) -> DataFrame:
    """(name, kind, passed_records, failed_records) of each expectation, as a query of its own."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(F.when(e.holds, 0).otherwise(1)), F.lit(0)).alias(e.name) for e in expectations])
    each = F.array(*[F.struct(F.lit(e.name).alias("name"), F.lit(e.kind).alias("kind"), (F.col("rows") - F.col(e.name)).alias("passed_records"), F.col(e.name).alias("failed_records")) for e in expectations])
    return counts.select(F.explode(each).alias("e")).select("e.*")


BAR_EXPECTATIONS = (
    Expectation("valid_timestamps", "start_timestamp < end_timestamp"),
    Expectation("valid_start_timestamp", "start_timestamp > 0"),
    Expectation("required_fields", "symbol IS NOT NULL AND start_timestamp IS NOT NULL"),
    Expectation("known_ts_unit", "ts_unit = 'ms'"),
)
NEWS_EXPECTATIONS = (
    Expectation("valid_article_id", "article_id IS NOT NULL AND length(trim(article_id)) > 0"),
    Expectation("has_published_utc", "published_utc IS NOT NULL"),
)
DATE_EXPECTATIONS = (Expectation("valid_date", "date IS NOT NULL"),)
DAILY_EXPECTATIONS = (Expectation("valid_symbol", "symbol IS NOT NULL"), Expectation("valid_date", "date IS NOT NULL"))
MINUTE_EXPECTATIONS = (Expectation("valid_symbol", "symbol IS NOT NULL"), Expectation("valid_start", "start_timestamp IS NOT NULL"))
FACT_NEWS_EXPECTATIONS = (Expectation("valid_article_id", "article_id IS NOT NULL"), Expectation("has_symbol", "symbol IS NOT NULL", "drop"))
SPLIT_EXPECTATIONS = (
    Expectation("valid_symbol", "symbol IS NOT NULL"),
    Expectation("valid_execution_date", "execution_date IS NOT NULL"),
    Expectation("valid_factor", "historical_adjustment_factor > 0"),
)
TICKER_EXPECTATIONS = (
    Expectation("symbol_length", "length(symbol) BETWEEN 1 AND 8"),
    Expectation("has_exchange", "exchange IS NOT NULL", "warn"),
    Expectation("has_company_name", "company_name IS NOT NULL", "warn"),
    Expectation("has_is_active", "is_active IS NOT NULL", "warn"),
)
#: A move of two fifths or more in adjusted prices: most likely a split that nobody told of.
UNEXPLAINED_GAP = "adj_close IS NOT NULL AND prev_adj_close IS NOT NULL AND prev_adj_close > 0 AND abs(adj_close / prev_adj_close - 1) >= 0.40"
ADJUSTED_EXPECTATIONS = (*DAILY_EXPECTATIONS, Expectation("no_unexplained_gap", f"NOT ({UNEXPLAINED_GAP})", "warn"))

SESSION_BARS = 390
GATE_DAYS = 2


def audit_expectations(today: dt.date) -> tuple[Expectation, ...]:
    """The gate holds for recent days only, so an old bad day cannot block later updates."""
    old = f"audit_date < DATE '{today - dt.timedelta(days=GATE_DAYS)}'"
    return (
        Expectation("quality_gate", f"quality_gate_passed OR {old}"),
        Expectation("session_complete", f"session_bars IS NULL OR session_bars >= {SESSION_BARS // 2} OR {old}", "warn"),
    )


def event_log(counts: DataFrame) -> DataFrame:
    """(name, dataset, passed_records, failed_records) from log rows whose details hold expectations as
    JSON text under flow_progress.data_quality.expectations."""
    details = F.get_json_object("details", "$.flow_progress.data_quality.expectations")
    parsed = F.from_json(details, "array<struct<name: string, dataset: string, passed_records: long, failed_records: long>>")
    return counts.select(F.explode(parsed).alias("e")).select("e.*").groupBy("dataset", "name").agg(F.sum("passed_records").alias("passed_records"), F.sum("failed_records").alias("failed_records"))

"""Data-quality checks: not-null, accepted values, source freshness, column contracts.

All checks on one relation are fused into a single aggregate pass
(``count_if`` per check, partial aggregation on the map side), then turned
into one result row per check. Nothing is collected to the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ratebridge import schemas as S


@dataclass(frozen=True)
class Check:
    relation: str
    column: str
    kind: str  # "not_null" | "accepted_values"
    values: tuple[str, ...] = field(default=())

    def failing(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "accepted_values":
            # NULLs are not judged here (the not_null check covers them).
            return c.isNotNull() & ~c.isin(list(self.values))
        raise ValueError(f"unknown check kind {self.kind}")


def _nn(relation: str, *cols: str) -> list[Check]:
    return [Check(relation, c, "not_null") for c in cols]


def _av(relation: str, col: str, values: Sequence[str]) -> Check:
    return Check(relation, col, "accepted_values", tuple(values))


# Declared column tests of the models (24 not-null, 8 accepted-values).
DECLARED_CHECKS: list[Check] = [
    *_nn("stg_se_rates", "rate_date", "series_id", "category", "value"),
    _av("stg_se_rates", "series_id", S.SERIES_IDS),
    *_nn("stg_bank_listed_rates", "scrape_date", "bank", "period_label", "list_rate"),
    _av("stg_bank_listed_rates", "bank", S.REQUIRED_BANKS),
    *_nn("stg_scb_mortgage_rates", "period_month", "period_date", "loan_type", "period_label", "rate"),
    _av("stg_scb_mortgage_rates", "loan_type", [code for code, _ in S.SCB_LOAN_TYPES]),
    *_nn("int_latest_bank_listed_rates", "bank", "period_label", "listed_rate_freshness"),
    _av("int_latest_bank_listed_rates", "listed_rate_freshness", S.FRESHNESS_LEVELS),
    *_nn("int_latest_scb_mortgage_rates", "loan_type", "period_label", "scb_rate_freshness"),
    _av("int_latest_scb_mortgage_rates", "scb_rate_freshness", S.FRESHNESS_LEVELS),
    *_nn("rates_daily", "rate_date"),
    *_nn("bank_margin_analysis", "bank", "period_label"),
    _av("bank_margin_analysis", "listed_rate_freshness", S.FRESHNESS_LEVELS),
    *_nn("bank_vs_market_analysis", "bank", "period_label"),
    _av("bank_vs_market_analysis", "listed_rate_freshness", S.FRESHNESS_LEVELS),
    _av("bank_vs_market_analysis", "scb_rate_freshness", S.FRESHNESS_LEVELS),
]

RESULT_COLUMNS = ["relation", "column_name", "check_name", "failures", "status"]


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows of ``df`` that fail ``check`` (for inspection / quarantine)."""
    return df.where(check.failing())


def _counts(checks: Sequence[Check]) -> list[Column]:
    return [F.count_if(c.failing()).alias(f"c{i}") for i, c in enumerate(checks)]


class CountedWrites:
    """Counts failing rows while relations are written, so that no check reads a model again.

    ``counted`` attaches the checks of a relation to a frame; the first action on the
    frame, its write, fills them in. ``batches`` does the same for each micro-batch of a
    stream, and adds up. ``results`` has the rows of ``run_checks``; a relation that was
    never written is an error, a stream without batches has none failing.
    """

    def __init__(self, spark: SparkSession, checks: Sequence[Check]):
        self.spark, self.checks = spark, list(checks)
        self.seen: dict[str, list[Observation]] = {}

    def of(self, relation: str) -> list[Check]:
        return [c for c in self.checks if c.relation == relation]

    def counted(self, relation: str, df: DataFrame) -> DataFrame:
        if not self.of(relation):
            return df
        watch = Observation()
        self.seen.setdefault(relation, []).append(watch)
        return df.observe(watch, *_counts(self.of(relation)))

    def batches(self, relation: str, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        """A foreachBatch function that writes counted batches; ``write`` must read each batch as a whole."""
        self.seen.setdefault(relation, [])
        return lambda batch, number: write(self.counted(relation, batch), number)

    def results(self) -> DataFrame:
        rows = []
        for relation in dict.fromkeys(c.relation for c in self.checks):
            if relation not in self.seen:
                raise ValueError(f"{relation} was not written")
            found = [watch.get for watch in self.seen[relation]]
            for i, c in enumerate(self.of(relation)):
                failures = sum(f[f"c{i}"] for f in found)
                rows.append((c.relation, c.column, c.kind, failures, "fail" if failures else "pass"))
        return self.spark.createDataFrame(rows, "relation string, column_name string, check_name string, failures long, status string")


def run_checks(relations: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: (relation, column_name, check_name, failures, status)."""
    parts: list[DataFrame] = []
    for rel in dict.fromkeys(c.relation for c in checks):
        mine = [c for c in checks if c.relation == rel]
        counts = relations[rel].agg(*_counts(mine))
        rows = F.array(
            *[
                F.struct(
                    F.lit(c.relation).alias("relation"),
                    F.lit(c.column).alias("column_name"),
                    F.lit(c.kind).alias("check_name"),
                    F.col(f"c{i}").alias("failures"),
                )
                for i, c in enumerate(mine)
            ]
        )
        parts.append(counts.select(F.inline(rows)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")))


# ---- source freshness -------------------------------------------------------------


def loaded_at_epoch(source: str) -> Column:
    """Load time of a raw row in epoch seconds (time-zone independent).

    Rates are stamped by observation date (midnight UTC); the others carry an
    ISO-8601 timestamp with offset.
    """
    if source == "se_rates_raw":
        return F.unix_date(F.to_date("rate_date", "yyyy-MM-dd")).cast("bigint") * 86400
    return F.unix_seconds(F.to_timestamp("scraped_at"))


def source_freshness(
    sources: Mapping[str, DataFrame],
    as_of: dt.datetime,
    rules: Mapping[str, tuple[int, int]] = S.SOURCE_FRESHNESS,
) -> DataFrame:
    """Per source: newest load time, its age in hours at ``as_of`` (UTC) and a status:
    error when older than error_after days (or the source is empty), warn when
    older than warn_after days, else pass."""
    as_of_epoch = int(as_of.replace(tzinfo=dt.timezone.utc).timestamp())
    parts = []
    for name, df in sources.items():
        warn, error = rules[name]
        newest = df.agg(F.max(loaded_at_epoch(name)).alias("max_loaded_at_epoch"))
        age = (F.lit(as_of_epoch) - F.col("max_loaded_at_epoch")) / 3600.0
        parts.append(
            newest.select(
                F.lit(name).alias("source"),
                "max_loaded_at_epoch",
                age.alias("age_hours"),
                F.when(F.col("max_loaded_at_epoch").isNull() | (age > error * 24), F.lit("error"))
                .when(age > warn * 24, F.lit("warn"))
                .otherwise(F.lit("pass"))
                .alias("status"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- column contracts -------------------------------------------------------------

# Columns the marts declare (documented contract).
DECLARED_COLUMNS: dict[str, list[str]] = {
    "rates_daily": ["rate_date", "spread_2y", "spread_5y", "stibor_policy_spread_3m", "swestr_policy_spread_3m"],
    "bank_margin_analysis": [
        "bank", "period_label", "list_rate", "listed_rate_age_days", "listed_rate_freshness", "funding_model",
        "funding_weight_2y", "funding_weight_5y", "policy_anchor_component", "short_rate_spread_component",
        "risk_free_curve_component", "covered_bond_spread_component", "funding_cost", "gross_margin",
    ],
    "bank_vs_market_analysis": [
        "bank", "period_label", "scb_new_loan_rate", "listed_rate_age_days", "listed_rate_freshness",
        "scb_rate_age_days", "scb_rate_freshness", "effective_margin_new",
    ],
}


def missing_columns(relations: Mapping[str, DataFrame], declared: Mapping[str, list[str]] = DECLARED_COLUMNS) -> list[tuple[str, str]]:
    """(relation, column) pairs declared but absent; schema-only, no job runs."""
    return [(rel, c) for rel, cols in declared.items() if rel in relations for c in cols if c not in relations[rel].columns]


def column_contract(relations: Mapping[str, DataFrame], declared: Mapping[str, list[str]] = DECLARED_COLUMNS) -> DataFrame:
    """(relation, column_name, status, filled) for every declared column: ``present`` with the number of its
    non-null values, or ``missing`` (filled null). One pass over each relation; a relation not given is missing."""
    parts = []
    spark = next(iter(relations.values())).sparkSession
    for name, columns in declared.items():
        held = [c for c in columns if name in relations and c in relations[name].columns]
        gone = [(name, c, "missing", None) for c in columns if c not in held]
        if held:
            counts = relations[name].agg(*[F.count(c).alias(c) for c in held])
            rows = [F.struct(F.lit(name).alias("relation"), F.lit(c).alias("column_name"), F.lit("present").alias("status"), F.col(c).alias("filled")) for c in held]
            parts.append(counts.select(F.inline(F.array(*rows))))
        if gone:
            parts.append(spark.createDataFrame(gone, "relation string, column_name string, status string, filled long"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

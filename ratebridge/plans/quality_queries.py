"""Registered data-quality queries: the models' declared column tests and source freshness."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ratebridge.operators import quality as Q
from ratebridge.plans import oracle as O
from ratebridge.plans.build import build_counted, model_relations
from ratebridge.plans.registry import register
from ratebridge.sources import fixtures as FX
from ratebridge.sources.catalog import Namespace

FRESHNESS_AS_OF = dt.datetime(2001, 8, 2)


def _checks(kind: str) -> list[Q.Check]:
    return [c for c in Q.DECLARED_CHECKS if c.kind == kind]


def _failing_sql(c: Q.Check) -> str:
    if c.kind == "not_null":
        return f"{c.column} IS NULL"
    vals = ", ".join(O._q(v) for v in c.values)
    return f"{c.column} IS NOT NULL AND {c.column} NOT IN ({vals})"


def _checks_sql(*kinds: str) -> str:
    selects = [
        f"SELECT {O._q(c.relation)} AS relation, {O._q(c.column)} AS column_name, {O._q(c.kind)} AS check_name, "
        f"CAST(count(*) FILTER (WHERE {_failing_sql(c)}) AS BIGINT) AS failures FROM {c.relation}"
        for kind in kinds
        for c in _checks(kind)
    ]
    body = (
        "SELECT relation, column_name, check_name, failures, "
        "CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (\n"
        + "\nUNION ALL\n".join(selects)
        + "\n) checks"
    )
    return O.with_ctes(O.ALL_MODEL_BASES, body, extra=O.all_models_ctes())


def _run(spark, sf_dir, kind):
    rels = model_relations(FX.raw_sources(spark, sf_dir), O.AS_OF, reuse=True)
    return Q.run_checks(rels, _checks(kind))


@register("quality_not_null", _checks_sql("not_null"))
def q_quality_not_null(spark, sf_dir):
    return _run(spark, sf_dir, "not_null")


@register("quality_accepted_values", _checks_sql("accepted_values"))
def q_quality_accepted_values(spark, sf_dir):
    return _run(spark, sf_dir, "accepted_values")


_AS_OF_EPOCH = int(FRESHNESS_AS_OF.replace(tzinfo=dt.timezone.utc).timestamp())


def _freshness_sql(as_of_epoch: int = _AS_OF_EPOCH) -> str:
    loaded = {
        "se_rates_raw": "CAST(date_diff('day', DATE '1970-01-01', CAST(rate_date AS DATE)) AS BIGINT) * 86400",
        "bank_listed_rates_raw": "CAST(epoch(CAST(scraped_at AS TIMESTAMPTZ)) AS BIGINT)",
        "scb_mortgage_rates_raw": "CAST(epoch(CAST(scraped_at AS TIMESTAMPTZ)) AS BIGINT)",
    }
    parts = []
    for name, expr in loaded.items():
        warn, error = Q.S.SOURCE_FRESHNESS[name]
        age = f"(CAST({as_of_epoch} - mx AS DOUBLE) / 3600)"
        parts.append(
            f"SELECT {O._q(name)} AS source, mx AS max_loaded_at_epoch, {age} AS age_hours, "
            f"CASE WHEN mx IS NULL OR {age} > {error * 24} THEN 'error' WHEN {age} > {warn * 24} THEN 'warn' "
            f"ELSE 'pass' END AS status FROM (SELECT max({expr}) AS mx FROM {name}) m"
        )
    return O.with_ctes(list(O.RAW), "\nUNION ALL\n".join(parts))


@register("source_freshness", _freshness_sql())
def q_source_freshness(spark, sf_dir):
    return Q.source_freshness(FX.raw_sources(spark, sf_dir), FRESHNESS_AS_OF)


# --- checks that fail ---------------------------------------------------------------------

#: Faults put into the raw relations: column, condition and what it becomes, in SQL that both engines read.
FAULTS = {
    "se_rates_raw": [
        ("category", "substr(rate_date, 6, 2) = '03'", "NULL"),
        ("series_id", "substr(rate_date, 6, 2) = '05' AND series_id = 'SEGVB10YC'", "'UNLISTED'"),
    ],
    "bank_listed_rates_raw": [
        ("bank", "substr(scraped_at, 12, 2) = '07'", "'Other'"),
        ("period_label", "substr(scraped_at, 12, 2) = '11'", "NULL"),
    ],
    "scb_mortgage_rates_raw": [
        ("loan_type", "substr(period_month, 6, 2) = '04'", "'0300'"),
        ("period_label", "substr(period_month, 6, 2) = '07'", "NULL"),
    ],
}


def faulty_sources(spark, sf_dir):
    raw = FX.raw_sources(spark, sf_dir)
    return {name: df.withColumns({c: F.expr(f"CASE WHEN {when} THEN {then} ELSE {c} END") for c, when, then in FAULTS[name]}) for name, df in raw.items()}


def _with_faults(sql: str) -> str:
    """The oracle text with the raw relations read through their faults."""
    for name, faults in FAULTS.items():
        swapped = ", ".join(f"CASE WHEN {when} THEN {then} ELSE {c} END AS {c}" for c, when, then in faults)
        head = f"{name} AS ("
        at = sql.index(head)
        end = sql.index("\n)", at) + 2
        body = sql[at:end].replace(head, f"clean_{name} AS (")
        sql = f"{sql[:at]}{body},\n{name} AS (SELECT * REPLACE ({swapped}) FROM clean_{name}){sql[end:]}"
    return sql


_FAULTY_SQL = _with_faults(_checks_sql("not_null", "accepted_values"))


@register("quality_faults", _FAULTY_SQL)
def q_quality_faults(spark, sf_dir):
    """All declared checks on models over faulty sources: a pass over each model."""
    return Q.run_checks(model_relations(faulty_sources(spark, sf_dir), O.AS_OF), Q.DECLARED_CHECKS)


@register("quality_observed", _FAULTY_SQL)
def q_quality_observed(spark, sf_dir):
    """The same counts, taken while the models are written."""
    ns = Namespace(env="ci", run_id=uuid.uuid4().hex, base="observed")
    return build_counted(spark, faulty_sources(spark, sf_dir), ns, Q.DECLARED_CHECKS, O.AS_OF)[1]


#: Days on which the sources are fresh, late and too late, each at least once.
FRESHNESS_DAYS = [dt.datetime(2001, 8, 2), dt.datetime(2001, 9, 8), dt.datetime(2001, 11, 4), dt.datetime(2001, 12, 1)]


def _levels_sql() -> str:
    epoch = lambda day: int(day.replace(tzinfo=dt.timezone.utc).timestamp())
    days = [f"SELECT '{day:%Y-%m-%d}' AS as_of, * FROM ({_freshness_sql(epoch(day))})" for day in FRESHNESS_DAYS]
    return " UNION ALL ".join(days) + " UNION ALL SELECT 'never', 'se_rates_raw', NULL, NULL, 'error'"


@register("source_freshness_levels", _levels_sql())
def q_source_freshness_levels(spark, sf_dir):
    """Freshness of the sources on several days, and of a source that has no rows."""
    raw = FX.raw_sources(spark, sf_dir)
    out = Q.source_freshness({"se_rates_raw": raw["se_rates_raw"].where("false")}, FRESHNESS_AS_OF).withColumn("as_of", F.lit("never"))
    for day in FRESHNESS_DAYS:
        out = out.unionByName(Q.source_freshness(raw, day).withColumn("as_of", F.lit(f"{day:%Y-%m-%d}")))
    return out


#: Columns taken out of the marts before their contract is checked.
WITHHELD = {"bank_margin_analysis": ["funding_cost"], "bank_vs_market_analysis": ["scb_new_loan_rate", "effective_margin_new"]}


def _contract_sql() -> str:
    columns = [(r, c) for r, cs in Q.DECLARED_COLUMNS.items() for c in cs]
    selects = [
        f"SELECT '{r}' AS relation, '{c}' AS column_name, " + ("'missing' AS status, NULL AS filled" if c in WITHHELD.get(r, ()) else f"'present' AS status, count({c}) AS filled FROM {r}")
        for r, c in columns
    ]
    return O.with_ctes(O.ALL_MODEL_BASES, " UNION ALL ".join(selects), extra=O.all_models_ctes())


@register("column_contract", _contract_sql())
def q_column_contract(spark, sf_dir):
    """Declared columns of the marts, some withheld, and how often the others are filled."""
    rels = model_relations(FX.raw_sources(spark, sf_dir), O.AS_OF)
    return Q.column_contract({name: rels[name].drop(*WITHHELD.get(name, ())) for name in Q.DECLARED_COLUMNS})

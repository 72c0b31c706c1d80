"""Raw JSON Lines scans, period sinks, catalog and incremental helpers."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from ratebridge import schemas as S
from ratebridge.sources import catalog as CAT
from ratebridge.sources import raw as R
from ratebridge.sources import sinks as SK
from ratebridge.streaming import incremental as X


def write_lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(rows))


def test_nested_layout_needs_recursive_lookup(spark, tmp_dir):
    rec = {"rate_date": "2024-05-02", "series_id": "SECBREPOEFF", "series_name": "Policy rate",
           "category": "central_bank", "value": 3.75}
    write_lines(f"{tmp_dir}/se-rates/2024/05/02/rates.jsonl", [json.dumps(rec)])
    write_lines(f"{tmp_dir}/se-rates/2024/05/03/rates.jsonl", [json.dumps({**rec, "rate_date": "2024-05-03"})])
    df = R.read_source(spark, "se_rates_raw", f"{tmp_dir}/se-rates")
    assert df.count() == 2 and df.columns == S.SE_RATES_RAW.fieldNames()


def test_malformed_lines_fail_or_quarantine(spark, tmp_dir):
    good = json.dumps({"rate_date": "2024-05-02", "series_id": "X", "value": 1.5})
    write_lines(f"{tmp_dir}/l/2024/05/02/rates.jsonl", [good, '{"rate_date": "2024-05-02", "value": "3,5"}', "{oops"])
    with pytest.raises(Exception):
        R.read_source(spark, "se_rates_raw", f"{tmp_dir}/l").collect()
    ok, bad = R.quarantine(R.read_source(spark, "se_rates_raw", f"{tmp_dir}/l", mode="PERMISSIVE").cache())
    assert ok.count() == 1 and bad.count() == 2


def test_write_periods_replaces_only_touched_days(spark, tmp_dir):
    schema = "rate_date string, series_id string, value double"
    first = spark.createDataFrame([("2024-05-02", "A", 1.0), ("2024-05-03", "A", 2.0)], schema)
    SK.write_periods(first, f"{tmp_dir}/out", F.col("rate_date"))
    rerun = spark.createDataFrame([("2024-05-03", "A", 2.5), ("2024-05-03", "B", 9.0)], schema)
    SK.write_periods(rerun, f"{tmp_dir}/out", F.col("rate_date"), salt=2)
    back = R.read_raw(spark, f"{tmp_dir}/out", first.schema, layout="hive")
    got = sorted((r.rate_date, r.series_id, r.value) for r in back.collect())
    assert got == [("2024-05-02", "A", 1.0), ("2024-05-03", "A", 2.5), ("2024-05-03", "B", 9.0)]
    assert {"year", "month", "day"} <= set(back.columns)
    pruned = back.where(F.col("day") == "02")
    assert "PartitionFilters: [isnotnull(day" in pruned._jdf.queryExecution().executedPlan().toString()


def test_catalog_tables_views_and_docs(spark):
    ns = CAT.Namespace(env="ci", run_id="run-42")
    assert ns.database("marts") == "rates_ci_run_42_marts"
    ns.create(spark, layers=("marts",))
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    CAT.as_view(df, "tmp_view_k")
    assert spark.table("tmp_view_k").count() == 1
    t = CAT.as_table(df, ns, "marts", "demo")
    CAT.persist_docs(spark, ns.table("marts", "demo"), "Demo table", {"v": "A value's text"})
    assert t.count() == 1
    desc = {r[0]: r[2] for r in spark.sql(f"DESCRIBE TABLE {ns.table('marts', 'demo')}").collect()}
    assert desc["v"] == "A value's text"
    with pytest.raises(ValueError):
        CAT.Namespace(env="staging").database("x")


def test_ensure_raw_tables(spark, tmp_dir):
    rec = {"bank": "SBAB", "period_label": "3M", "period_years": 0.25, "list_rate": 4.0, "scraped_at": "2024-01-01T07:00:00+00:00"}
    write_lines(f"{tmp_dir}/bank/2024/01/01/rates.jsonl", [json.dumps(rec)])
    R.ensure_raw_tables(spark, "rates_raw_test", {"bank_listed_rates_raw": f"{tmp_dir}/bank"})
    R.ensure_raw_tables(spark, "rates_raw_test", {"bank_listed_rates_raw": f"{tmp_dir}/bank"})  # idempotent
    assert spark.table("rates_raw_test.bank_listed_rates_raw").count() == 1


def test_incremental_range(spark):
    stored = spark.createDataFrame([(dt.date(2024, 5, 2),), (dt.date(2024, 5, 7),)], "rate_date date")
    assert X.incremental_range(stored, "rate_date", "2020-01-01", "2024-05-10") == ("2024-05-07", "2024-05-10")
    assert X.incremental_range(None, "rate_date", "2020-01-01", "2024-05-10") == ("2020-01-01", "2024-05-10")
    assert X.incremental_range(stored, "rate_date", "2020-01-01", "2024-05-07") is None
    empty = stored.where("false")
    assert X.incremental_range(empty, "rate_date", "2024-04-30", dt.date(2024, 5, 10)) == ("2024-04-30", "2024-05-10")


def test_lookback_helpers(spark):
    from ratebridge.functions.dates import lookback_month, lookback_start

    r = spark.range(1).select(lookback_start("2024-01-30", 10).alias("d"), lookback_month("2024-02-15", 3).alias("m")).first()
    assert r.d == dt.date(2024, 1, 20) and r.m == "2023-11"
    with pytest.raises(ValueError):
        lookback_start("2024-01-30", 0)


def test_build_models_materialises_marts(spark):
    from ratebridge.plans.build import build_models
    from ratebridge.sources.fixtures import raw_sources

    ns = CAT.Namespace(env="dev", base="rb_test")
    out = build_models(spark, raw_sources(spark, "/root/testdata/sf0.001"), ns, as_of="2001-08-02")
    assert out["bank_vs_market_analysis"].count() == 42
    assert spark.table(ns.table("marts", "rates_daily")).count() == out["rates_daily"].count()
    assert spark.table("stg_se_rates").count() > 0
    comment = [r for r in spark.sql(f"DESCRIBE TABLE EXTENDED {ns.table('marts', 'bank_margin_analysis')}").collect()
               if r[0] == "Comment"]
    assert comment and "funding proxy" in comment[0][1]


def test_cluster_conf_sizes_partitions():
    from ratebridge.session import cluster_conf

    conf = cluster_conf(100 * 1024**4, executors=1000, cores_per_executor=8)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (256 << 20)
    small = cluster_conf(10 << 30, executors=100, cores_per_executor=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 1600   # two waves of 800 cores


def test_source_binding_reads_raw_table(spark, tmp_dir):
    rec = {"period_month": "2024-04", "loan_type": "0100", "period_code": "1.1.1", "period_label": "3M", "rate": 4.1}
    write_lines(f"{tmp_dir}/scb/2024/04/rates.jsonl", [json.dumps(rec)])
    ns = CAT.Namespace(env="dev", base="rb_src")
    R.ensure_raw_tables(spark, ns.database("raw"), {"scb_mortgage_rates_raw": f"{tmp_dir}/scb"})
    df = CAT.source(spark, ns, "scb_mortgage_rates_raw")
    assert [r.rate for r in df.collect()] == [4.1]


def test_display_orders(spark):
    from ratebridge.plans.marts import for_display

    df = spark.createDataFrame(
        [("Nordea", 5.0), ("SBAB", 0.25), ("Nordea", 0.25), ("SBAB", None)], "bank string, period_years double"
    )
    got = [(r.bank, r.period_years) for r in for_display(df, "bank_margin").collect()]
    assert got == [("Nordea", 0.25), ("Nordea", 5.0), ("SBAB", 0.25), ("SBAB", None)]


def test_newest_delivery_of_a_rate_wins(spark, tmp_path):
    from ratebridge.plans.stream_queries import staged_stream

    def deliver(load, at, *rates):
        rows = [("2024-01-02", series, "n", "c", value, at) for series, value in rates]
        frame = spark.createDataFrame(rows, "rate_date string, series_id string, series_name string, category string, value double, delivered_at string")
        frame.write.json(f"{tmp_path}/landing/load={load}")
        return {r["series_id"]: float(r["value"]) for r in staged_stream(spark, str(tmp_path), "newest_delivery").collect()}

    assert deliver(0, "2024-01-02 06:00:00", ("UP", 4.0), ("DOWN", 4.0), ("SAME", 1.0)) == {"UP": 4.0, "DOWN": 4.0, "SAME": 1.0}
    assert deliver(1, "2024-01-03 06:00:00", ("UP", 4.25), ("DOWN", 3.75)) == {"UP": 4.25, "DOWN": 3.75, "SAME": 1.0}
    # An older delivery that lands late replaces nothing.
    assert deliver(2, "2024-01-02 18:00:00", ("UP", 4.5), ("DOWN", 3.0), ("SAME", 1.5)) == {"UP": 4.25, "DOWN": 3.75, "SAME": 1.5}

"""Stored views per environment, landing folders by period, checks counted while writing, late first copies."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from ratebridge import schemas as S
from ratebridge.operators import quality as Q
from ratebridge.plans import quality_queries as QQ
from ratebridge.plans.environment import VIEWS, build_environment, create_views
from ratebridge.plans.build import build_counted, model_relations
from ratebridge.sources import raw as R
from ratebridge.sources.catalog import Namespace
from ratebridge.sources.published import PublishedTable
from ratebridge.sources.sinks import DAY, MONTH, nest_periods
from ratebridge.streaming import incremental as X
from ratebridge.testing import SF_SMALL


def land(spark, sf_dir, base):
    from ratebridge.sources.fixtures import raw_sources

    for name, rows in raw_sources(spark, sf_dir).items():
        rows.write.json(f"{base}/{name}")
    return {name: f"{base}/{name}" for name in S.RAW_SCHEMAS}


def test_views_are_the_models(spark, tmp_dir):
    places = land(spark, SF_SMALL, tmp_dir)
    ns = Namespace(env="dev", base=f"v{uuid.uuid4().hex[:8]}")
    out = build_environment(spark, ns, places, "2001-08-02")
    models = model_relations({n: R.read_source(spark, n, p) for n, p in places.items()}, "2001-08-02")
    assert set(out) == set(models)
    for name, model in models.items():
        stored = out[name].select(*model.columns)
        assert stored.exceptAll(model).isEmpty() and model.exceptAll(stored).isEmpty(), name


def test_environments_stay_apart_and_views_see_what_lands(spark, tmp_dir):
    record = {"period_month": "2024-04", "loan_type": "0100", "loan_type_name": "n", "period_code": "1.1.1", "period_label": "3M", "rate": 4.1, "scraped_at": "2024-05-01T00:00:00+00:00"}
    spaces = {}
    for env, rate in (("dev", 4.1), ("prod", 5.0)):
        ns = spaces[env] = Namespace(env=env, base=f"apart{uuid.uuid4().hex[:8]}")
        for name in S.RAW_SCHEMAS:
            os.makedirs(f"{tmp_dir}/{env}/{name}/2024/04")
        with open(f"{tmp_dir}/{env}/scb_mortgage_rates_raw/2024/04/rates.jsonl", "w") as f:
            f.write(json.dumps({**record, "rate": rate}) + "\n")
        ns.create(spark)
        R.ensure_raw_tables(spark, ns.database("raw"), {n: f"{tmp_dir}/{env}/{n}" for n in S.RAW_SCHEMAS})
        create_views(spark, ns, "2024-05-20")
    name = "int_latest_scb_mortgage_rates"
    read = lambda env: [(r.rate, r.scb_rate_age_days, r.scb_rate_freshness) for r in spark.table(spaces[env].table("intermediate", name)).collect()]
    assert read("dev") == [(4.1, 49, "aging")] and read("prod") == [(5.0, 49, "aging")]
    os.makedirs(f"{tmp_dir}/dev/scb_mortgage_rates_raw/2024/05")
    with open(f"{tmp_dir}/dev/scb_mortgage_rates_raw/2024/05/rates.jsonl", "w") as f:
        f.write(json.dumps({**record, "period_month": "2024-05", "rate": 3.9}) + "\n")
    spark.catalog.refreshTable(spaces["dev"].table("raw", "scb_mortgage_rates_raw"))
    assert read("dev") == [(3.9, 19, "fresh")] and read("prod") == [(5.0, 49, "aging")]
    stored = spark.sql(f"DESCRIBE TABLE EXTENDED {spaces['dev'].table('intermediate', name)}").collect()
    assert VIEWS[name].description in {r[1] for r in stored if r[0] == "Comment"}
    assert {r[0]: r[2] for r in stored}["scb_rate_age_days"] == "Days since the month began."


def test_ages_count_to_today_without_a_fixed_day(spark, tmp_dir):
    for name in S.RAW_SCHEMAS:
        os.makedirs(f"{tmp_dir}/{name}")
    ns = Namespace(env="dev", base=f"today{uuid.uuid4().hex[:8]}")
    ns.create(spark)
    R.ensure_raw_tables(spark, ns.database("raw"), {n: f"{tmp_dir}/{n}" for n in S.RAW_SCHEMAS})
    views = create_views(spark, ns)
    day = spark.sql("SELECT date_sub(current_date(), 2)").first()[0].isoformat()
    row = {"bank": "SBAB", "period_label": "3M", "period_years": 0.25, "list_rate": 4.0, "scraped_at": f"{day}T07:00:00+00:00", "source": "s"}
    with open(f"{tmp_dir}/bank_listed_rates_raw/x.jsonl", "w") as f:
        f.write(json.dumps(row) + "\n")
    spark.catalog.refreshTable(ns.table("raw", "bank_listed_rates_raw"))
    latest = spark.table(ns.table("intermediate", "int_latest_bank_listed_rates")).collect()
    assert [(r.listed_rate_age_days, r.listed_rate_freshness) for r in latest] == [(2, "aging")] and len(views) == 5


def test_period_folders():
    assert R.period_folders("2020-11-29", "2021-01-02") == ["2020/11/29", "2020/11/30", "2020/12", "2021/01/01", "2021/01/02"]
    assert R.period_folders("2019-01-01", "2020-12-31") == ["2019/*", "2020/*"]
    assert R.period_folders("2020-02", "2020-03", MONTH) == ["2020/02", "2020/03"]
    assert R.period_folders("2020-12-15", "2021-12-31", MONTH) == ["2020/12", "2021/*"]
    assert R.period_folders("2020-02-02", "2020-02-01") == []


def test_only_the_folders_of_a_range_are_read(spark, tmp_dir):
    days = ["2023-12-31", "2024-01-01", "2024-01-31", "2024-02-29", "2024-03-01", "2025-01-01"]
    rows = spark.createDataFrame([(d, "s", "n", "c", float(i)) for i, d in enumerate(days)], S.SE_RATES_RAW)
    nest_periods(rows, f"{tmp_dir}/rates", F.col("rate_date"))
    with open(f"{tmp_dir}/rates/2023/12/31/broken.json", "w") as f:
        f.write("not json\n")  # outside the range: never opened
    got = R.read_source(spark, "se_rates_raw", f"{tmp_dir}/rates", between=("2024-01-01", "2024-02-29"))
    folders = {"/".join(p.split("/")[-4:-1]) for p in got.inputFiles()}
    assert folders == {"2024/01/01", "2024/01/31", "2024/02/29"}
    assert sorted(r.rate_date for r in got.collect()) == days[1:4]
    assert R.read_source(spark, "se_rates_raw", f"{tmp_dir}/rates", between=("1999-01-01", "1999-12-31")).count() == 0
    with pytest.raises(ValueError, match="nested"):
        R.read_source(spark, "se_rates_raw", f"{tmp_dir}/rates", layout="hive", between=("2024-01-01", "2024-01-01"))


def test_nested_landing_replaces_whole_periods(spark, tmp_dir):
    path = f"{tmp_dir}/scb"
    frame = lambda *r: spark.createDataFrame([("2024-0%d" % m, "0100", "n", code, "3M", rate, "t") for m, code, rate in r], S.SCB_MORTGAGE_RATES_RAW)
    nest_periods(frame((1, "a", 1.0), (1, "b", 1.5), (2, "a", 2.0)), path, F.col("period_month"), MONTH)
    nest_periods(frame((1, "a", 9.0), (3, "a", 3.0)), path, F.col("period_month"), MONTH)
    rows = R.read_source(spark, "scb_mortgage_rates_raw", path).collect()
    assert sorted((r.period_month, r.period_code, r.rate) for r in rows) == [("2024-01", "a", 9.0), ("2024-02", "a", 2.0), ("2024-03", "a", 3.0)]
    assert sorted(os.listdir(f"{path}/2024")) == ["01", "02", "03"] and os.listdir(tmp_dir) == ["scb"] and DAY[2] == "day"


def test_counts_of_writes_are_those_of_a_pass(spark):
    raw = QQ.faulty_sources(spark, SF_SMALL)
    ns = Namespace(env="ci", run_id=uuid.uuid4().hex, base="counted")
    models, results = build_counted(spark, raw, ns, Q.DECLARED_CHECKS, "2001-08-02")
    expected = Q.run_checks(models, Q.DECLARED_CHECKS)
    assert sorted(results.collect()) == sorted(expected.collect())
    assert {r.status for r in results.collect()} == {"pass", "fail"}
    with pytest.raises(ValueError, match="was not written"):
        Q.CountedWrites(spark, Q.DECLARED_CHECKS).results()


def test_micro_batches_are_counted(spark, tmp_dir):
    checks = [Q.Check("t", "a", "not_null"), Q.Check("t", "b", "accepted_values", ("x", "y"))]
    counted = Q.CountedWrites(spark, checks)
    write = counted.batches("t", lambda batch, number: batch.write.mode("append").parquet(f"{tmp_dir}/out"))
    schema = "a int, b string"
    for number, rows in enumerate([[(1, "x"), (None, "z")], [(None, None), (2, "q")], [(3, "y")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(f"{tmp_dir}/in/load={number}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").json(f"{tmp_dir}/in")
        X.run_available(stream, f"{tmp_dir}/checkpoint", foreach_batch=write)
    assert [(r.column_name, r.failures, r.status) for r in counted.results().collect()] == [("a", 2, "fail"), ("b", 2, "fail")]
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 5


def test_late_first_copies_are_kept_and_counted(spark, tmp_dir):
    columns = "k INT, ts TIMESTAMP, v STRING, late BOOLEAN, day STRING"
    table = PublishedTable(spark, f"t_{uuid.uuid4().hex}", tmp_dir, columns, ("day",)).create()
    write = X.first_copies(table, ["k"], "ts", delay_days=3)

    def batch(*rows):
        frame = spark.createDataFrame([(k, f"2024-01-{d:02}", v) for k, d, v in rows], "k int, day string, v string")
        return frame.select("k", F.col("day").cast("timestamp").alias("ts"), "v", "day")

    batches = [batch((1, 10, "a"), (2, 11, "a"), (2, 11, "b")), batch((1, 10, "again"), (3, 2, "late"), (4, 9, "in time")),
               batch((3, 2, "again"), (5, 20, "new")), batch((6, 11, "late now"))]
    for number, rows in enumerate(batches):
        write(rows, number)
    write(batches[3], 3)  # replayed
    got = sorted((r.k, r.v, r.late) for r in table.read().collect())
    assert got == [(1, "a", False), (2, "a", False), (3, "late", True), (4, "in time", False), (5, "new", False), (6, "late now", True)]


def test_column_contract_names_what_is_missing(spark):
    frame = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    got = Q.column_contract({"t": frame}, {"t": ["a", "b", "c"], "u": ["d"]}).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([("t", "a", "present", 2), ("t", "b", "present", 1), ("t", "c", "missing", None), ("u", "d", "missing", None)], key=repr)


def test_white_space_is_trimmed(spark):
    from ratebridge.plans.staging import stage_rates

    rows = spark.createDataFrame([("2024-01-01", "\tA \n", "\u000b n\r", " c\f", 1.0)], S.SE_RATES_RAW)
    assert [tuple(r)[1:4] for r in stage_rates(rows).collect()] == [("A", "n", "c")]


def test_repeated_rates_are_aggregated_before_they_are_ranked(spark):
    """Rows alike but for the value are reduced as they are read, so that the ranking sorts few."""
    from ratebridge.plans.environment import VIEWS, view_sql
    from ratebridge.sources.catalog import Namespace

    sql = view_sql(Namespace(env="dev"), VIEWS["stg_se_rates"])
    assert "min(value) AS value" in sql and "GROUP BY rate_date, series_id, series_name, category" in sql

"""Malformed input stops a job instead of vanishing; scratch space must be shared."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ratebridge import schemas as S
from ratebridge import session
from ratebridge.operators.graph import reachable
from ratebridge.sources import payloads as P
from ratebridge.sources.raw import read_raw
from ratebridge.sources.sinks import write_periods
from ratebridge.streaming.incremental import landed_stream, run_available


def bodies(spark, key, body):
    return spark.createDataFrame([("s", "t", key, body)], P.BODY_SCHEMA)


def test_truncated_bodies_fail(spark):
    cut = json.dumps([{"date": "2024-01-02", "value": 4.0}])[:-4]
    with pytest.raises(Exception, match="MALFORMED"):
        P.extract_observations(bodies(spark, "SECBREPOEFF", cut)).collect()
    with pytest.raises(Exception, match="MALFORMED"):
        P.extract_offers_json(bodies(spark, "k", '{"listInterests": [{"period": "P_3_MONTHS"')).collect()


def test_explicit_null_value_stays_null(spark):
    body = json.dumps([{"date": "2024-01-02", "value": None, "rate": 9}, {"date": "2024-01-03", "rate": 9}])
    rows = P.extract_observations(bodies(spark, "SECBREPOEFF", body)).collect()
    assert sorted((r["rate_date"], r["value"]) for r in rows) == [("2024-01-02", None), ("2024-01-03", 9.0)]


def test_table_without_columns_fails(spark):
    body = json.dumps({"data": [{"key": ["a", "b", "c"], "values": ["1,5"]}]})
    with pytest.raises(Exception, match="unexpected statistical table shape"):
        P.extract_px_table(bodies(spark, "k", body)).collect()


def test_batch_and_stream_agree_on_a_bad_line(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.json", "w") as file:
        file.write('{"series_id": "x"}\n{"series_id": \n')
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILED_READ_FILE"):
        read_raw(spark, f"{tmp_dir}/in", S.SE_RATES_RAW).collect()
    stream = landed_stream(spark, f"{tmp_dir}/in", S.SE_RATES_RAW)
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILED_READ_FILE"):
        run_available(stream, f"{tmp_dir}/cp", f"{tmp_dir}/out")
    with pytest.raises(ValueError):
        read_raw(spark, f"{tmp_dir}/in", S.SE_RATES_RAW, mode="DROPMALFORMED")


def test_reachability_raises_when_rounds_run_out(spark):
    edges = spark.createDataFrame([("g", i, i + 1) for i in range(6)], "g string, src int, dst int")
    starts = spark.createDataFrame([("g", 0)], "g string, node int")
    with pytest.raises(RuntimeError):
        reachable(edges, starts, ["g"], max_rounds=2)
    assert reachable(edges, starts, ["g"], max_rounds=9).count() == 7


class Cluster:
    """Stands for a session on a cluster without a shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"


def test_scratch_must_be_shared_on_a_cluster(spark):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster)
    assert session.ensure_checkpoint_dir(spark)


def test_periods_are_rebalanced(spark, tmp_dir):
    rows = spark.range(3000).select(F.when(F.col("id") < 2900, "2024-01-01").otherwise("2024-01-02").alias("d"), F.col("id"))
    plan = rows.sparkSession.sql("SELECT /*+ REBALANCE(d) */ * FROM {rows}", rows=rows)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" in plan
    write_periods(rows, f"{tmp_dir}/p", F.col("d"), fmt="parquet")
    write_periods(rows.filter("id >= 2900 and id < 2950"), f"{tmp_dir}/p", F.col("d"), fmt="parquet")
    assert spark.read.parquet(f"{tmp_dir}/p").groupBy("d").count().orderBy("d").collect() == [("2024-01-01", 2900), ("2024-01-02", 50)]

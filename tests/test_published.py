"""Publishing by partition location: stops at every step, replays, refusals; the ledger of batches."""

import uuid
from functools import partial

import pytest
from pyspark.sql import functions as F

from ratebridge.operators.gates import GateError, require_members, require_rows
from ratebridge.sources import published as P
from ratebridge.sources.published import PublishedTable, batches
from ratebridge.streaming.ledger import Ledger, ingest_range

COLUMNS = "k INT, v STRING, at INT, day STRING"


class Stop(Exception):
    pass


@pytest.fixture()
def table(spark, tmp_dir):
    return PublishedTable(spark, f"t_{uuid.uuid4().hex}", tmp_dir, COLUMNS, ("day",)).create()


def rows(spark, *values):
    return spark.createDataFrame(list(values), COLUMNS)


def content(table):
    return sorted(map(tuple, table.read().collect()))


def merge(table, batch, number):
    return table.merge(batch, number, ["k"], [F.col("at").desc(), F.col("v").asc()])


FIRST = [(1, "a", 1, "d1"), (2, "a", 1, "d1"), (3, "a", 1, "d2"), (9, "a", 1, "d3")]
SECOND = [(1, "b", 2, "d1"), (1, "c", 2, "d1"), (3, "old", 0, "d2"), (4, "b", 2, "d4")]
MERGED = [(1, "b", 2, "d1"), (2, "a", 1, "d1"), (3, "a", 1, "d2"), (4, "b", 2, "d4"), (9, "a", 1, "d3")]


def test_merge_keeps_untouched_periods_and_rows(spark, table):
    assert merge(table, rows(spark, *FIRST), 0) and content(table) == sorted(FIRST)
    assert merge(table, rows(spark, *SECOND), 1) and content(table) == MERGED
    assert list(batches(table)) == ["batch=stream-0", "batch=stream-1"]
    assert not merge(table, rows(spark, (1, "z", 9, "d1")), 1) and content(table) == MERGED  # known by its id


@pytest.mark.parametrize("listed", [P.MOST_LISTED, 1])
@pytest.mark.parametrize("step", ["write", "note staged", "first partition", "new partitions", "note published"])
def test_a_stop_at_any_step_loses_and_doubles_nothing(spark, table, monkeypatch, step, listed):
    monkeypatch.setattr(P, "MOST_LISTED", listed)
    merge(table, rows(spark, *FIRST), 0)
    with monkeypatch.context() as stopping:
        note, sql, seen = PublishedTable._note, type(spark).sql, []

        def stop_at_note(self, name, writer, batch_id):
            if step == f"note {name}":
                raise Stop
            note(self, name, writer, batch_id)

        def stop_at_sql(self, text, *args, **kwargs):
            out = sql(self, text, *args, **kwargs)
            if (step == "first partition" and "SET LOCATION" in text) or (step == "new partitions" and "ADD IF NOT EXISTS" in text):
                seen.append(text)
                raise Stop
            return out

        def stop_at_write(frame, by):
            raise Stop

        stopping.setattr(PublishedTable, "_note", stop_at_note)
        stopping.setattr(type(spark), "sql", stop_at_sql)
        if step == "write":
            stopping.setattr(P, "rebalanced", stop_at_write)
        with pytest.raises(Stop):
            merge(table, rows(spark, *SECOND), 1)
    if step in ("write", "note staged"):
        assert content(table) == sorted(FIRST)  # nothing of the batch is seen
    assert len({r[0] for r in content(table)}) == len(content(table))
    assert merge(table, rows(spark, *SECOND), 1)
    assert content(table) == MERGED


def test_a_refused_batch_leaves_the_table_and_its_number(spark, table):
    audits = (partial(require_rows, what="batch"), partial(require_members, col="v", required=["x", "y"]))
    assert table.replace(rows(spark, (1, "x", 1, "d1"), (2, "y", 1, "d1"), (3, "x", 1, "d2")), 1, audits)
    before = content(table)
    with pytest.raises(GateError, match="missing required v values: y"):
        table.replace(rows(spark, (5, "x", 2, "d1")), 2, audits)
    with pytest.raises(GateError, match="no rows in batch"):
        table.replace(spark.createDataFrame([], COLUMNS), 2, audits)
    assert content(table) == before
    assert table.replace(rows(spark, (5, "x", 2, "d1"), (6, "y", 2, "d1")), 2, audits)
    assert content(table) == [(3, "x", 1, "d2"), (5, "x", 2, "d1"), (6, "y", 2, "d1")]  # d1 as a whole, d2 as it was


def test_periods_must_be_names(spark, table):
    with pytest.raises(ValueError, match="is not a period"):
        table.replace(rows(spark, (1, "x", 1, None)), 1)
    with pytest.raises(ValueError, match="is not a period"):
        table.replace(rows(spark, (1, "x", 1, "a/b")), 2)


def test_several_period_columns(spark, tmp_dir):
    table = PublishedTable(spark, f"t_{uuid.uuid4().hex}", tmp_dir, "k INT, y INT, m STRING", ("y", "m")).create()
    frame = lambda *r: spark.createDataFrame(list(r), "k INT, y INT, m STRING")
    merge_on = lambda f, n: table.merge(f, n, ["k"], [F.col("k").asc()])
    assert merge_on(frame((1, 2020, "01"), (2, 2021, "01")), 0) and merge_on(frame((3, 2020, "01"), (4, 2021, "02")), 1)
    assert content(table) == [(1, 2020, "01"), (2, 2021, "01"), (3, 2020, "01"), (4, 2021, "02")]


def test_the_mark_moves_past_complete_batches_only(spark, tmp_dir):
    ledger, published = Ledger(spark, f"{tmp_dir}/ledger"), []
    delivered = {}

    def fetch(start, end):
        return spark.createDataFrame([(m,) for m in delivered[(start, end)]], "m string")

    def run(day):
        return ingest_range(ledger, "s", "2024-01-01", day, fetch, lambda rows, n: published.append((n, rows.count())), ["x", "y"], "m")

    assert run("2024-01-01") is None and ledger.mark("s") is None
    delivered[("2024-01-01", "2024-01-05")] = ["x", "y", "y"]
    assert run("2024-01-05") == "complete" and ledger.mark("s") == "2024-01-05"
    delivered[("2024-01-05", "2024-01-06")] = ["x"]
    assert run("2024-01-06") == "incomplete" and ledger.mark("s") == "2024-01-05"
    delivered[("2024-01-05", "2024-01-07")] = []
    assert run("2024-01-07") == "empty" and ledger.mark("s") == "2024-01-05"
    delivered[("2024-01-05", "2024-01-08")] = ["y", "x"]
    assert run("2024-01-08") == "complete" and run("2024-01-08") is None
    assert published == [(1, 3), (2, 1), (4, 2)]
    assert [(r["batch"], r["status"], r["missing"]) for r in ledger.read().orderBy("batch").collect()] == [
        (1, "complete", []), (2, "incomplete", ["y"]), (3, "empty", ["x", "y"]), (4, "complete", [])]
    assert ledger.mark("other") is None
    ledger.note("s", 4, ("2024-01-05", "2024-01-08"), "complete")  # a replayed note
    assert ledger.read().count() == 4

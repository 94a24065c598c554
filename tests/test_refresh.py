"""One write for both layers, checks during it, and refreshes of touched periods."""

import os
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siftlake import entities
from siftlake.functions.parsing import timestamp
from siftlake.operators import validate as dq
from siftlake.plans import flow
from siftlake.sources.lake import Lake, shared_folder

from rows import frame

def by_day():
    return {"order_day": F.to_date(timestamp(F.col("order_date")))}


def files(folder):
    return {str(f.relative_to(folder)): f.stat().st_mtime_ns for f in Path(folder).rglob("*.parquet")}


def orders(n=40, **changes):
    return [{"order_id": f"O{i + 1:06d}", "order_date": f"2026-06-{i % 8 + 1:02d}", **changes} for i in range(n)]


def found(lake, entity="orders", period="order_day"):
    silver = lake.read("silver", entity).select("ingest_seq", period, F.lit(None).cast("string").alias("issue"))
    dq_rows = lake.read("dq", entity).select("ingest_seq", period, "_dq_issue")
    return Counter(tuple(r) for r in silver.union(dq_rows).collect())


def rebuilt(lake, period="order_day"):
    bronze = lake.read("bronze", "orders")
    labelled = dq.validate(bronze, entities.orders(), order_by="ingest_seq")
    return Counter(tuple(r) for r in labelled.select("ingest_seq", period, "_dq_issue").collect())


def input_records(spark, group):
    store = spark.sparkContext._jsc.sc().statusStore()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    stages = {s for j in jobs for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds}
    return sum(store.lastStageAttempt(s).inputRecords() for s in stages)


def test_layers_are_written_once(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write(frame(spark, "orders", orders() + [{"order_id": "O000001"}, {"order_id": None}, {"order_date": "no"}]), "bronze", "orders")
    folder = Path(shared_folder(spark).removeprefix("file://"))
    before = set(os.listdir(folder))
    spark.sparkContext.setJobGroup("one-write", "")
    result = flow.promote(lake, entities.orders(), order_by="ingest_seq", extra_columns=["ingest_seq"], partition=by_day(), amounts=["total_amount"])
    read = input_records(spark, "one-write")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert (result.total, result.valid) == (43, 40) and set(result.checks.values()) == {0}
    # Only key statistics are stored beside the layers, and the layers hold each row once.
    assert {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before} <= {"repeated-keys", "hot-keys"}
    whole = spark.read.parquet(str(tmp_path / "validated/orders"))
    assert whole.count() == 43 and {"layer", "order_day"} <= set(whole.columns)
    # The rows are read once to label and write them, and their keys once before; the few repeated keys besides.
    assert read <= 2 * 43 + 10


def test_layers_without_rows(spark, tmp_path):
    for name, rows, counts in (("good", [{}], (1, 0)), ("bad", [{"order_id": None}], (0, 1)), ("none", [], (0, 0))):
        for partition in ({}, by_day()):
            lake = Lake(spark, str(tmp_path / f"{name}{len(partition)}"))
            lake.write(frame(spark, "orders", rows), "bronze", "orders")
            flow.promote(lake, entities.orders(), order_by="ingest_seq", partition=partition)
            assert (lake.read("silver", "orders").count(), lake.read("dq", "orders").count()) == counts
            assert "_dq_issue" in lake.read("dq", "orders").columns and "_dq_issue" not in lake.read("silver", "orders").columns


def test_promoting_again_replaces_everything(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for rows in (orders(), [{"order_date": "2026-07-07"}]):
        lake.write(frame(spark, "orders", rows), "bronze", "orders")
        flow.promote(lake, entities.orders(), order_by="ingest_seq", partition=by_day())
    assert lake.read("silver", "orders").count() == 1 and lake.read("dq", "orders").count() == 0


def test_observed_violations(spark, tmp_path):
    """A rule set that checks nothing lets every fault through to silver, where the observations see it."""
    lake = Lake(spark, str(tmp_path))
    loose = dq.RuleSet("orders", "order_id", entities.orders().columns, (dq.Rule("never", F.lit(False)),), duplicates=None)
    rows = [{}, {"order_id": None}, {"total_amount": "-1"}, {"total_amount": None}, {"total_amount": "text"}]
    lake.write(frame(spark, "orders", rows), "bronze", "orders")
    checks = flow.promote(lake, loose, amounts=["total_amount"]).checks
    assert checks["silver_rows_without_key"] == 1 and checks["silver_negative_total_amount"] == 1
    assert checks["silver_null_total_amount"] == 1 and checks["unbalanced_rows"] == 0


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    flow.land(lake, entities.orders(), frame(spark, "orders", orders()), "2026-06-10", by_day())
    flow.promote(lake, entities.orders(), order_by="ingest_seq", extra_columns=["ingest_seq"], partition={"order_day": F.col("order_day")})
    return lake


def refreshed(lake, rows, date="2026-06-11"):
    changed = flow.land(lake, entities.orders(), rows, date, by_day())
    return flow.refresh(lake, entities.orders(), changed, "order_day", order_by="ingest_seq", extra_columns=["ingest_seq"])


def numbered(spark, rows, start):
    return frame(spark, "orders", rows).withColumn("ingest_seq", F.col("ingest_seq") + start)


def test_only_touched_days_are_written(spark, tmp_path, lake):
    before = files(tmp_path / "validated")
    result = refreshed(lake, numbered(spark, [{"order_id": "O000100", "order_date": "2026-06-03"}, {"order_id": "O000101", "order_date": "2026-06-30"}], 100))
    assert [str(d) for d in result.touched] == ["2026-06-03", "2026-06-30"] and result.total == 7
    after = files(tmp_path / "validated")
    kept = {f for f in before if "2026-06-03" not in f}
    assert {f: after.get(f) for f in kept} == {f: before[f] for f in kept}
    assert found(lake) == rebuilt(lake) and sum(found(lake).values()) == 42


def test_a_late_first_copy_changes_the_day_of_the_other(spark, lake):
    # O000005 is known from 2026-06-05 with number 4; the late record comes before it.
    result = refreshed(lake, numbered(spark, [{"order_id": "O000005", "order_date": "2026-06-20"}], -50))
    assert [str(d) for d in result.touched] == ["2026-06-05", "2026-06-20"]
    assert found(lake) == rebuilt(lake)
    assert {r.ingest_seq: r._dq_issue for r in lake.read("dq", "orders").collect()} == {4: "duplicate_order_record"}
    # Sent again without that record: both days return to what they were.
    refreshed(lake, numbered(spark, [{"order_id": "O000200", "order_date": "no date"}], 200))
    assert found(lake) == rebuilt(lake) and lake.read("dq", "orders").select("ingest_seq").collect() == [(200,)]
    # And again with nothing wrong: the quarantine is empty.
    refreshed(lake, numbered(spark, [{"order_id": "O000200"}], 200))
    assert found(lake) == rebuilt(lake) and lake.read("dq", "orders").count() == 0


def test_copies_outside_the_touched_days_count(spark, lake):
    """A touched day holds a key whose first copy lies in a day that is not touched."""
    refreshed(lake, numbered(spark, [{"order_id": "O000001", "order_date": "2026-06-02"}], 300))
    result = refreshed(lake, numbered(spark, [{"order_id": "O000400", "order_date": "2026-06-02"}], 400), "2026-06-12")
    assert [str(d) for d in result.touched] == ["2026-06-02"]
    assert found(lake) == rebuilt(lake) and lake.read("dq", "orders").select("ingest_seq").collect() == [(300,)]


def test_nothing_landed(spark, tmp_path, lake):
    before = files(tmp_path / "validated")
    result = refreshed(lake, frame(spark, "orders", []))
    assert result.touched == () and result.total == 0 and files(tmp_path / "validated") == before


@pytest.fixture
def shuffled_writes(monkeypatch):
    """Whether each write of layers shuffled their rows."""
    found, write = [], Lake.write_validated

    def noted(self, df, *args, **options):
        found.append("RebalancePartitions" in df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, df, *args, **options)

    monkeypatch.setattr(Lake, "write_validated", noted)
    return found


def test_rows_that_lie_in_their_periods_are_not_shuffled(spark, tmp_path, shuffled_writes):
    lake = Lake(spark, str(tmp_path))
    rows = orders() + [{"order_id": "O000001", "order_date": "2026-06-04"}, {"order_date": "no date"}]
    assert flow.land(lake, entities.orders(), frame(spark, "orders", rows), "2026-06-10", by_day(), changes=False) is None
    result = flow.promote(lake, entities.orders(), order_by="ingest_seq", extra_columns=["ingest_seq"], partition=("order_day",))
    assert (result.total, result.invalid, set(result.checks.values())) == (42, 2, {0}) and found(lake) == rebuilt(lake)
    refreshed(lake, numbered(spark, [{"order_id": "O000005", "order_date": f"2026-06-{d:02d}"} for d in range(1, 9)], -50))
    assert found(lake) == rebuilt(lake) and sum(found(lake).values()) == 50
    assert shuffled_writes == [False, False]


def test_periods_scattered_over_many_landing_days_are_gathered(spark, lake, shuffled_writes):
    for i in range(flow.NEAR_FOLDERS):
        rows = [{"order_id": f"O{500 + 10 * i + d:06d}", "order_date": f"2026-06-{d:02d}"} for d in range(1, 9)]
        refreshed(lake, numbered(spark, rows, 100 * (i + 1)), f"2026-06-{11 + i}")
    assert shuffled_writes == [False] * (flow.NEAR_FOLDERS - 1) + [True] and found(lake) == rebuilt(lake)


def test_many_touched_rows_are_judged_without_a_join_of_keys(spark, lake, monkeypatch):
    """Keys of bronze are aggregated once; those with no copy in a touched day are left out."""
    refreshed(lake, numbered(spark, [{"order_id": "O000001", "order_date": "2026-06-02"}, {"order_id": "O000003", "order_date": "2026-06-03"}], 300))
    monkeypatch.setattr(flow, "BROADCAST_KEYS", 0)
    joins, prepare = [], flow.prepare

    def noted(*args):
        joins.append("Join" in args[6]._jdf.queryExecution().optimizedPlan().toString())
        return prepare(*args)

    monkeypatch.setattr(flow, "prepare", noted)
    late = [{"order_id": "O000400", "order_date": "2026-06-02"}, {"order_id": "O000005", "order_date": None}]
    result = refreshed(lake, numbered(spark, late, -400), "2026-06-12")
    assert [str(d) for d in result.touched] == ["2026-06-02", "2026-06-05", "None"] and joins == [False]
    assert found(lake) == rebuilt(lake)
    assert sorted(r.ingest_seq for r in lake.read("dq", "orders").where("_dq_issue LIKE 'dup%'").collect()) == [4, 300, 301]

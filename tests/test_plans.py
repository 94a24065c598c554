"""Shape of the physical plans."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from siftlake.catalog import QUERIES, queries
from siftlake.operators import dedup, refs, report, skew, validate as dq
from siftlake.plans import marts

from rows import frame

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_pairing_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text


def test_no_window_holds_a_whole_key(spark):
    for name in ("orders_first_issue", "order_items_validate", "dedup_flag_later", "dedup_flag_all", "dedup_keep_first"):
        assert "Window" not in plan(entry.queries()[name](spark, FOLDER))


def test_lookup_reads_only_the_columns_it_needs(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").withColumn("cid", F.col("o_custkey").cast("string"))
    customers = spark.read.parquet(f"{FOLDER}/customer.parquet").withColumn("id", F.col("c_custkey").cast("string"))
    text = plan(refs.exists_flag(orders, customers, "cid", "id", spread_by=["o_orderkey"]).select("o_orderkey", "ref_exists"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
    assert "ReadSchema: struct<c_custkey:bigint>" in text
    assert "o_totalprice" not in text


def test_status_filter_reaches_the_scan(spark, tmp_path):
    for entity in ("orders", "order_items", "payments"):
        frame(spark, entity, [{}]).write.parquet(str(tmp_path / entity))
    t = [spark.read.parquet(str(tmp_path / e)) for e in ("orders", "order_items", "payments")]
    text = plan(marts.daily_sales(*t, item_ids_unique=True))
    assert "In(order_status, [Confirmed,Delivered,Shipped])" in text
    assert "EqualTo(payment_status,Success)" in text
    assert "shipping_city" not in text and "transaction_reference" not in text


@pytest.mark.parametrize("name", ["daily_sales", "mart_check"])
def test_lines_are_read_twice_and_never_expanded(spark, tmp_path, name):
    for entity in ("orders", "order_items", "payments"):
        frame(spark, entity, [{}]).write.parquet(str(tmp_path / entity))
    t = [spark.read.parquet(str(tmp_path / e)) for e in ("orders", "order_items", "payments")]
    mart = marts.daily_sales(*t, item_ids_unique=True, ordered=False)
    text = plan(mart if name == "daily_sales" else report.check_mart(mart, "sales_date", ["gross_sales"]))
    assert "Expand" not in text and len(re.findall(r"FileScan parquet [^\n]*item_total|FileScan parquet [^\n]*product_id", text)) <= 2


def test_duplicate_statistics_are_aggregated_once(spark):
    df = spark.read.parquet(f"{FOLDER}/orders.parquet")
    flagged = dedup.flag_later_copies(df, "o_custkey", "o_orderkey")
    # The statistics are stored once; the query itself reads them and aggregates nothing.
    assert "partial_min" not in plan(flagged)


def test_rows_without_hot_keys_are_shuffled_once(spark):
    """Also where the repeated keys are too many to broadcast."""
    df = spark.read.parquet(f"{FOLDER}/orders.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for flagged in (dedup.flag_later_copies(df, "o_custkey", "o_orderkey"), dedup.flag_all_copies(df, "o_custkey")):
            assert plan(flagged).count("SortMergeJoin") == 1
        hot = skew.hot_keys(df, F.col("o_custkey").cast("string"))
        joined = skew.spread_lookup(df.withColumn("key", F.col("o_custkey").cast("string")), df.select(F.lit("1").alias("ref")), "key", "ref", hot)
        assert plan(joined).count("SortMergeJoin") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_flag_of_all_copies_reads_only_the_columns_it_needs(spark):
    assert "l_extendedprice" not in plan(entry.queries()["dedup_flag_all"](spark, FOLDER))


@pytest.mark.parametrize("name", ["order_items_validate", "issues_from_bits", "dq_rule_counts_order_items"])
def test_rules_are_evaluated_before_rows_are_shuffled(spark, name):
    """So that bits or a label travel instead of every column the rules read."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(entry.queries()[name](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above, below = text.split("SortMergeJoin", 1)
    assert "RLIKE" not in above and "RLIKE" in below


@pytest.mark.parametrize("name, stored", [
    ("silver_recheck_inventory", {"silver-products": None, "silver-inventory": None}),
    ("mart_conservation", {"silver-order_items": {"order_id", "quantity", "item_total"}, "silver-payments": {"order_id", "payment_status", "amount"}}),
    ("daily_sales", {"silver-order_items": None}),
])
def test_silver_that_is_read_again_is_stored_once(spark, monkeypatch, name, stored):
    seen = []
    write = queries.materialize
    monkeypatch.setattr(queries, "materialize", lambda df, to: (seen.append((to, set(df.columns))), write(df, to))[1])
    entry.queries()[name](spark, FOLDER)
    assert len({to for to, _ in seen}) == len(seen)
    for to, columns in stored.items():
        assert dict(seen)[to] == columns or columns is None


def test_the_first_label_is_read_from_the_bits(spark):
    """One expression tells bits and label of a row, so that Spark evaluates the rules once."""
    c = F.col("a")
    rules = dq.RuleSet("t", "a", ("a",), (dq.Rule("small", c < 2), dq.Rule("odd", c % 2 == 1), dq.Rule("five", c == 5)), duplicates=None)
    prepared = dq.prepare(spark.range(7).select(F.col("id").alias("a")), rules)
    columns = prepared._jdf.queryExecution().analyzed().projectList()
    found = {columns.apply(i).name(): columns.apply(i).sql() for i in range(columns.size())}
    bits = found[dq.BROKEN].rsplit(" AS ", 1)[0]
    assert bits in found[dq.FIRST_BROKEN]
    rows = prepared.orderBy("a").collect()
    assert [r[dq.FIRST_BROKEN] for r in rows] == ["small", "small", None, "odd", None, "odd", None]
    assert [r[dq.BROKEN] for r in rows] == [1, 3, 0, 2, 0, 6, 0]

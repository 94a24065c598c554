"""Reports against hand-counted frames."""

from pyspark.sql import functions as F

from siftlake import entities
from siftlake.operators import report, validate as dq

from rows import frame

ROWS = [
    {"order_id": "O000001"},
    {"order_id": "O000001"},
    {"order_id": "O000002", "tax_amount": "x", "order_status": None},
    {"order_id": "O000003", "tax_amount": None},
]


def test_rule_counts_totals_and_distribution(spark):
    df, ruleset = frame(spark, "orders", ROWS), entities.orders()
    out = report.summary(df, ruleset, order_by="ingest_seq")
    counts = {r.label: r.violations for r in out["rule_counts"].collect()}
    assert {k: v for k, v in counts.items() if v} == {
        "duplicate_order_record": 1, "invalid_order_status": 1, "invalid_tax_amount": 2,
    }
    assert [r.rule_no for r in out["rule_counts"].orderBy("rule_no").collect()] == list(range(1, 18))
    assert tuple(out["totals"].first()) == (4, 1, 3)
    assert [tuple(r) for r in out["distribution"].collect()] == [
        ("duplicate_order_record", 1), ("invalid_order_status", 1), ("invalid_tax_amount", 1),
    ]


def test_counts_need_one_job_shuffle(spark):
    ruleset = entities.orders()
    prepared = dq.prepare(frame(spark, "orders", ROWS), ruleset, None, "ingest_seq")
    plan = report.rule_counts(prepared, ruleset)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1


def test_profiles_and_keys(spark):
    df = spark.createDataFrame([("a", 1, -1.0), ("a", None, 2.0), ("b", 3, -3.0), ("a", 4, None)], "k string, n int, x double")
    assert {r.column_name: r.null_count for r in report.null_profile(df).collect()} == {"k": 0, "n": 1, "x": 1}
    assert {r.column_name: r.negative_count for r in report.negative_profile(df, ["n", "x"]).collect()} == {"n": 0, "x": 2}
    assert [tuple(r) for r in report.repeated_keys(df, "k").collect()] == [("a", 3)]
    assert tuple(report.repeated_key_summary(df, "k").first()) == (1, 2)
    assert tuple(report.repeated_key_summary(df.where("k = 'b'"), "k").first()) == (0, 0)
    assert [tuple(r) for r in report.value_counts(df, "k").collect()] == [("a", 3), ("b", 1)]
    assert tuple(report.filter_counts(df, F.col("n") > 1).first()) == (2, 2)
    assert [r.n for r in report.preview(df.na.drop(), [F.desc("n")], 1).collect()] == [3]
    assert report.schema_report(df) == [("k", "string"), ("n", "int"), ("x", "double")]


def test_layer_and_mart_checks(spark):
    labelled = dq.validate(frame(spark, "orders", ROWS), entities.orders(), None, "ingest_seq")
    silver, quarantine = dq.split(labelled)
    good = {r.check: r.violations for r in report.check_layers(silver, quarantine).collect()}
    assert set(good.values()) == {0}
    bad = {r.check: r.violations for r in report.check_layers(labelled, silver).collect()}
    assert bad["issue_column_in_silver"] == 1 and bad["issue_column_missing_in_quarantine"] == 1
    unlabelled = report.check_layers(silver, labelled).where("check = 'quarantine_rows_without_issue'").first()
    assert unlabelled.violations == 1
    mart = spark.createDataFrame([("a", 1.0), ("a", -1.0), (None, 2.0)], "k string, x double")
    assert {r.check: r.violations for r in report.check_mart(mart, "k", ["x"]).collect()} == {
        "repeated_k": 1, "null_k": 1, "negative_x": 1,
    }

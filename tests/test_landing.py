"""Landing readers and repairs on files written by the test."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from siftlake.functions import normalize
from siftlake.operators import dedup, landing as ops, refs
from siftlake.sources import landing
from siftlake.sources.lake import Lake


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_csv_layout(spark, tmp_path):
    write(
        tmp_path / "customers/ingest_date=2026-05-01/part.csv",
        "customer_id,first_name,last_name,email,phone,city,state,signup_date,customer_segment\n"
        "CUST-0000001,Asha,Rao,,N/A,Pune,Kerala,2025-01-01,VIP\n"
        "CUST-0000001,Asha,Rao,,N/A,Pune,Kerala,2025-01-01,VIP\n",
    )
    write(
        tmp_path / "customers/ingest_date=2026-05-02/part.csv",
        "customer_id,first_name,last_name,email,phone,city,state,signup_date,customer_segment\n"
        "CUST-0000002,Ravi,Das,r@x.in,9876543210,Agra,Nowhere,2025-01-02,Regular\n"
        "CUST-0000003,Ravi\n",
    )
    df = landing.read_csv(spark, str(tmp_path / "customers"), landing.CUSTOMERS)
    assert [r._corrupt_record for r in df.collect() if r._corrupt_record] == ["CUST-0000003,Ravi"]
    df = df.where("_corrupt_record is null").drop("_corrupt_record").cache()
    assert df.count() == 3
    assert {str(r.landing_date) for r in df.collect()} == {"2026-05-01", "2026-05-02"}
    unique = dedup.drop_exact_copies(df)
    assert unique.count() == 2
    gaps = ops.contact_gaps(unique)
    assert [(r.customer_id, r.missing_email, r.missing_phone) for r in gaps.collect()] == [("CUST-0000001", True, True)]
    regions = {r.state: r.region for r in ops.add_region(unique).collect()}
    assert regions == {"Kerala": "South", "Nowhere": None}


def test_json_layout_late_records_and_drift(spark, tmp_path):
    old = {"order_id": "A", "customer_id": "1", "order_date": "2026-05-03", "order_status": "COMPLETED"}
    late = {"order_id": "B", "customer_id": "9", "order_date": "2026-05-01", "order_status": "COMPLETED"}
    new = {"order_id": "C", "customer_id": "1", "order_date": "2026-06-20", "discount_code": "SAVE10"}
    write(tmp_path / "orders/order_date=2026-05-03/a.json", json.dumps(old) + "\n" + json.dumps(late) + "\n")
    write(tmp_path / "orders/order_date=2026-06-20/a.json", json.dumps(new) + "\n")
    df = landing.read_json_lines(spark, str(tmp_path / "orders"), landing.ORDERS)
    rows = {r.order_id: r for r in df.collect()}
    assert rows["B"].order_date == "2026-05-01" and str(rows["B"].landing_date) == "2026-05-03"
    assert rows["A"].discount_code is None and rows["C"].discount_code == "SAVE10"
    found = ops.late_arrivals(df, ops.parse_record_date(F.col("order_date")), F.col("landing_date"))
    assert [(r.order_id, r.days_late) for r in found.collect()] == [("B", 2)]
    customers = spark.createDataFrame([("1",)], "customer_id string")
    assert [r.order_id for r in refs.orphans(df, customers, "customer_id", "customer_id").collect()] == ["B"]


def test_items_json(spark, tmp_path):
    items = [
        {"order_id": "A", "product_id": "P", "quantity": None, "unit_price": 2.5, "line_total": 5.0},
        {"order_id": "A", "product_id": "P", "quantity": -2, "unit_price": 2.5, "line_total": 5.0},
        {"order_id": "A", "product_id": "P", "quantity": 2, "unit_price": 2.5, "line_total": 5.0},
        {"order_id": "A", "product_id": "P", "quantity": "2", "unit_price": 2.5, "line_total": 7.5},
        {"order_id": "A", "product_id": "P", "quantity": "two", "unit_price": 2.5, "line_total": 7.5},
    ]
    write(tmp_path / "order_items/order_date=2026-05-03/a.json", "\n".join(map(json.dumps, items)) + '\n{"order_id": "A", "quan')
    df = landing.read_json_lines(spark, str(tmp_path / "order_items"), landing.ORDER_ITEMS)
    counts = {r.quantity_class: r["count"] for r in ops.quantity_triage(df).collect()}
    assert counts == {"missing": 2, "return": 1, "sale": 2, "malformed": 1}
    assert [r._corrupt_record for r in df.where("_corrupt_record is not null").collect()] == ['{"order_id": "A", "quan']
    wrong = ops.line_total_mismatches(df, "quantity", "unit_price", "line_total")
    assert sorted((r.quantity, float(r.computed_total)) for r in wrong.collect()) == [("-2", -5.0), ("2", 5.0)]


def test_drifting_parquet_and_union(spark, tmp_path):
    a = spark.createDataFrame([("A",)], "order_id string")
    b = spark.createDataFrame([("B", "SAVE10")], "order_id string, discount_code string")
    a.write.parquet(str(tmp_path / "t/day=1"))
    b.write.parquet(str(tmp_path / "t/day=2"))
    merged = landing.read_drifting_parquet(spark, str(tmp_path / "t"))
    explicit = landing.read_drifting_parquet(spark, str(tmp_path / "t"), b.schema)
    expected = {("A", None), ("B", "SAVE10")}
    for df in (merged, explicit, landing.union_drifting([a, b])):
        assert {(r.order_id, r.discount_code) for r in df.collect()} == expected


def test_prices_and_categories(spark):
    df = spark.createDataFrame(
        [("499", "", "Audio"), ("Rs.499.5", None, "Men"), ("₹ 12", "Home", "Decor"), ("free", " ", "Unknown"), (None, "X", None)],
        "unit_price string, category string, sub_category string",
    )
    got = [r.p for r in df.select(normalize.price(F.col("unit_price")).alias("p")).collect()]
    assert [None if p is None else float(p) for p in got] == [499.0, 499.5, 12.0, None, None]
    assert [r.category for r in ops.backfill_category(df).collect()] == ["Electronics", "Fashion", "Home", None, "X"]


def test_lake_layers(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.range(3)
    lake.write(df, "raw", "t")
    assert lake.copy("t").count() == 3
    assert lake.read("bronze", "t", df.schema).count() == 3
    assert set(lake.read_all("raw", ["t"])) == {"t"}
    with pytest.raises(ValueError):
        lake.copy("t", "raw", "raw")
    with pytest.raises(ValueError):
        lake.path("platinum", "t")
    with pytest.raises(AnalysisException):
        lake.read("gold", "t")
    lake.write(spark.range(4).withColumn("g", F.col("id") % 2), "dq", "t", partition_by=["g"])
    assert lake.read("dq", "t").where("g = 1").count() == 2

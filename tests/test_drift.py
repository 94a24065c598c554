"""Records with unknown fields, files of different types, bitmaps of ids, bucketed tables, bitmasks and cubes."""

import datetime as dt
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, TimestampNTZType

from siftlake import entities
from siftlake.operators import report, skew, uniques, validate as dq
from siftlake.plans import marts
from siftlake.sources import landing
from siftlake.sources.bucketed import bucket_count, write_bucketed

from rows import frame


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_records_keep_unknown_fields(spark, tmp_path):
    write(tmp_path / "in/order_date=2026-05-01/a.json", '{"id":1,"total":5}\n\n  \t\n{"id":"x","gift":{"note":"hi","n":[1,2]}}\nno json\n')
    write(tmp_path / "in/order_date=2026-06-01/b.json", '{"id":2,"id":3}\n[1]\n7\n{"id":4,"order_date":"2026-05-30","new":null}\n{}\n')
    rows = landing.read_json_records(spark, str(tmp_path / "in"))
    stored = str(tmp_path / "bronze")
    landing.extract(rows, {"id": ("$.id", "int")}).write.parquet(stored)
    later = landing.extract(spark.read.parquet(stored), {"note": ("$.gift.note", "string"), "second": ("$.gift.n[1]", "int"), "day": ("$.order_date", "date")})
    got = {(str(r.landing_date), r.id, r.note, r.second, r.day, r[landing.CORRUPT]) for r in later.collect()}
    assert got == {
        ("2026-05-01", 1, None, None, None, None), ("2026-05-01", None, "hi", 2, None, None), ("2026-05-01", None, None, None, None, "no json"),
        ("2026-06-01", None, None, None, None, '{"id":2,"id":3}'), ("2026-06-01", None, None, None, None, "[1]"), ("2026-06-01", None, None, None, None, "7"),
        ("2026-06-01", 4, None, None, dt.date(2026, 5, 30), None), ("2026-06-01", None, None, None, None, None),
    }
    fields = {(r.field, r.kind): r.records for r in landing.record_fields(later, ["id"]).collect()}
    assert fields == {("total", "BIGINT"): 1, ("gift", "OBJECT"): 1, ("order_date", "STRING"): 1, ("new", "VOID"): 1}
    assert {r.field for r in landing.record_fields(later).collect()} == {"id", "total", "gift", "order_date", "new"}


def test_types_that_drift(spark, tmp_path):
    root = tmp_path / "t"
    batches = [("1", "int"), ("1", "int"), ("4000000000", "bigint"), ("12", "string"), ("many", "string"), (None, "string"), ("7", "int"), ("2.50", "decimal(5,2)")]
    for i, (value, kind) in enumerate(batches):
        df = spark.range(1).select(F.lit(i).alias("batch"), F.lit(value).cast(kind).alias("n"))
        df = df.withColumn("late", F.lit("x")) if i > 3 else df
        df.write.parquet(str(root / f"day={i}"))
    files = spark.read.option("recursiveFileLookup", True).schema("batch int").parquet(str(root)).inputFiles()
    groups = landing.schema_groups(spark, files)
    assert sorted(f for _, part in groups for f in part) == sorted(files) and len(groups) < len(files)
    out = landing.read_drifting_types(spark, str(root))
    assert out.schema["n"].dataType == DecimalType(21, 2)
    got = {r.batch: (None if r.n is None else float(r.n), r.late, r[landing.UNREADABLE]) for r in out.collect()}
    assert got == {
        0: (1.0, None, None), 1: (1.0, None, None), 2: (4e9, None, None), 3: (12.0, None, None), 4: (None, "x", {"n": "many"}),
        5: (None, "x", None), 6: (7.0, "x", None), 7: (2.5, "x", None),
    }
    wanted = landing.read_drifting_types(spark, str(root), {"n": IntegerType()})
    assert {r.batch: r[landing.UNREADABLE] for r in wanted.collect()}[2] == {"n": "4000000000"}


@pytest.mark.parametrize("a, b, both", [
    (IntegerType(), LongType(), LongType()), (StringType(), IntegerType(), IntegerType()), (LongType(), DoubleType(), DoubleType()),
    (DateType(), TimestampNTZType(), TimestampNTZType()), (DateType(), LongType(), StringType()), (DecimalType(10, 2), DecimalType(12, 4), DecimalType(12, 4)),
    (DecimalType(10, 8), LongType(), DecimalType(27, 8)),
])
def test_widest_type(a, b, both):
    assert landing._wider(a, b) == both == landing._wider(b, a)


def test_uniques_equal_distinct_counts(spark):
    rows = [(dt.date(2026, 1, 1) + dt.timedelta(days=i % 40), (i * 7919) % 100_003 - 5 if i % 9 else None) for i in range(4000)]
    df = spark.createDataFrame([*rows, *rows[:500], (None, 3)], "day date, id int")
    bitmaps = uniques.daily_bitmaps(df, F.col("day"), F.col("id"))
    got = {(r.grain, r.period): r.uniques for r in uniques.uniques(bitmaps).collect()}
    want = {}
    for day, number in rows:
        if number is not None:
            for grain, first in (("day", day), ("week", day - dt.timedelta(days=day.weekday())), ("month", day.replace(day=1)), ("all", "all")):
                want.setdefault((grain, str(first)), set()).add(number)
    assert got == {k: len(v) for k, v in want.items()}
    months = uniques.merged(bitmaps, "month")
    assert months.select(F.sum(F.bitmap_count("bitmap"))).first()[0] == sum(n for (g, _), n in got.items() if g == "month")
    assert uniques.uniques(bitmaps.where("day is null")).collect() == []
    with pytest.raises(ValueError):
        uniques.period("year")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bucketed(spark, tables, buckets=8):
    return [write_bucketed(t, "t", "order_id", buckets) for t in tables]


@pytest.mark.parametrize("hot_rows", [5, 1_000_000])
def test_bucketed_mart(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    customers = frame(spark, "customers", [{"customer_id": f"C{i:06d}"} for i in range(4)])
    orders = frame(spark, "orders", [{"order_id": f"O{i:06d}", "customer_id": f"C{i % 3:06d}", "order_status": ("Shipped", "Cancelled")[i % 2]} for i in range(30)])
    items = frame(spark, "order_items", [{"order_item_id": f"I{i}", "order_id": f"O{i % 20 if i % 3 else 4:06d}"} for i in range(90)] + [{"order_id": None}])
    payments = frame(spark, "payments", [{"payment_id": f"T{i}", "order_id": f"O{i:06d}"} for i in range(25)])
    tables = bucketed(spark, (orders, items, payments))
    assert (tables[1].rest is not None) and tables[0].rest is None
    assert tables[1].rows.count() + tables[1].rest.count() == 91
    joined = marts.bucketed_orders_with_sums(*tables)
    assert "Exchange" not in plan(marts.orders_with_sums(tables[0].rows, marts.item_sums(tables[1].rows).hint("merge"), marts.payment_sums(tables[2].rows).hint("merge")))
    assert joined.count() == 30
    want = Counter(tuple(r) for r in marts.customer_360(customers, orders, items, payments).collect())
    assert Counter(tuple(r) for r in marts.customer_360_bucketed(customers, *tables).collect()) == want


def test_bucketed_tables_must_fit(spark):
    orders, items, payments = (frame(spark, e, [{}]) for e in ("orders", "order_items", "payments"))
    a, b, c = (*bucketed(spark, (orders, items)), *bucketed(spark, (payments,), 4))
    with pytest.raises(ValueError, match="buckets"):
        marts.bucketed_orders_with_sums(a, b, c)
    with pytest.raises(ValueError, match="known and unique"):
        marts.bucketed_orders_with_sums(write_bucketed(frame(spark, "orders", [{"order_id": None}]), "t", "order_id", 8), b, bucketed(spark, (payments,))[0])
    assert bucket_count(0) == 8 and bucket_count(2_000_000 * 8 + 1) == 9


def faulty(spark):
    changes = [{}, {"quantity": "0"}, {"quantity": "0", "tax_amount": "x"}, {"order_id": None, "tax_amount": "x"}, {"order_id": None}]
    return frame(spark, "order_items", [{**c, "order_item_id": f"I{i}"} for i, c in enumerate(changes * 3)] + [{}] * 2)


def test_bitmask_tells_what_the_labels_tell(spark):
    rules = entities.order_items()
    prepared = dq.prepare(faulty(spark), rules, order_by="ingest_seq")
    bits = dq.issue_bits(rules.rules)
    rows = prepared.select(
        bits.alias("bits"), dq.first_issue_of_bits(bits, rules.labels).alias("a"), dq.first_issue(rules.rules).alias("b"),
        dq.issues_of_bits(bits, rules.labels).alias("c"), dq.issue_array(rules.rules).alias("d"),
    ).collect()
    assert all(r.a == r.b and r.c == r.d and bin(r.bits).count("1") == len(r.c) for r in rows)
    pairs = Counter()
    only = Counter()
    for r in rows:
        for i, x in enumerate(r.d):
            for y in r.d[i:]:
                pairs[x, y] += 1
                only[x, y] += len(r.d) == len({x, y})
    found = report.cooccurrence(report.bit_patterns(prepared, rules), rules).collect()
    assert {(r.label, r.other_label): (r.rows, r.only_these) for r in found} == {k: (n, only[k]) for k, n in pairs.items()}
    with pytest.raises(ValueError):
        dq.issue_bits([dq.Rule("r", F.lit(True))] * 64)


def test_cube_totals(spark):
    rules = entities.orders()
    rows = [{"order_id": f"O{i:06d}", "order_date": ("2026-05-01", "2026-06-02", None)[i % 3], "tax_amount": ("1", "x")[i % 2]} for i in range(12)]
    labelled = dq.validate(frame(spark, "orders", rows), rules, order_by="ingest_seq")
    date = F.to_date(F.col("order_date").try_cast("date"))
    other = frame(spark, "sellers", [{}]).withColumn("_dq_issue", F.lit(None).cast("string"))
    cube = report.issue_cube({"orders": (labelled, date), "sellers": (other, F.col("joined_date").cast("date"))})
    got = Counter()
    for r in cube.collect():
        got[r.level, r.entity, r.month, r.label] += r.rows
    plain = [("orders", r.order_date[:7] if r.order_date else None, r._dq_issue or report.VALID_LABEL) for r in labelled.collect()]
    plain.append(("sellers", "2020-01", report.VALID_LABEL))
    want = Counter()
    for entity, month, label in plain:
        for level, row in (
            ("entity,month,label", (entity, month, label)), ("entity,month", (entity, month, None)), ("entity,label", (entity, None, label)),
            ("entity", (entity, None, None)), ("month", (None, month, None)), ("", (None, None, None)),
        ):
            want[level, *row] += 1
    assert got == want
    # One aggregation of the rows, the sets run over its result.
    text = plan(report.issue_cube({"orders": (labelled, date)}))
    assert len(re.findall(r"\bExpand\b", text.split("+- ")[-1])) == 0


def test_huge_numbers_never_abort(spark):
    huge = "9" * 19
    rows = [{"quantity": huge, "unit_price": huge}, {"quantity": "-" + huge, "unit_price": huge}, {"quantity": huge}, {"unit_price": huge}]
    df = frame(spark, "order_items", [{**r, "order_item_id": f"I{i}"} for i, r in enumerate(rows)])
    rules = entities.order_items()
    prepared = dq.prepare(df, rules, order_by="ingest_seq")
    found = {r.ingest_seq: set(r.issues) for r in prepared.select("ingest_seq", dq.issue_array(rules.rules).alias("issues")).collect()}
    assert found[0] == {"invalid_item_total"} and found[2] == found[3] == {"invalid_item_total"}
    assert found[1] == {"invalid_quantity", "discount_exceeds_gross_amount", "invalid_item_total"}
    from siftlake.operators.landing import line_total_mismatches

    wrong = line_total_mismatches(df, "quantity", "unit_price", "item_total")
    assert {r.ingest_seq: r.computed_total is None for r in wrong.collect()} == {0: True, 1: True, 2: False, 3: False}
    orders, payments = frame(spark, "orders", [{}]), frame(spark, "payments", [{}])
    day = marts.daily_sales(orders, df, payments).first()
    assert day.total_order_items == 4 and day.total_quantity is None

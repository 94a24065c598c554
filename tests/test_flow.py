"""Raw to gold in a lake on disk, and the marts against plain Python."""

import datetime as dt
from collections import defaultdict
from decimal import Decimal
from types import SimpleNamespace

import pytest

from siftlake import entities
from siftlake.plans import flow, marts
from siftlake.sources.lake import Lake, new_path

from rows import frame


def orders_rows():
    status = ["Delivered", "Confirmed", "Shipped", "Cancelled", "Returned", "Pending"]
    rows = []
    for i in range(24):
        hour = "23:00:00" if i % 2 else "01:00:00"
        rows.append({
            "order_id": f"O{i + 1:06d}", "customer_id": f"C{i % 5 + 1:06d}", "order_status": status[i % 6],
            "order_date": f"2026-07-{i % 9 + 1:02d} {hour}",
        })
    return rows + [{"order_id": "O000001"}, {"order_id": "O000099", "customer_id": "bad"}]


def item_rows():
    rows = []
    for i in range(60):
        q, price = i % 4 + 1, 10 + i % 7
        rows.append({
            "order_item_id": f"I{i}", "order_id": f"O{i % 26 + 1:06d}", "product_id": f"P{i % 6 + 1:06d}",
            "quantity": str(q), "unit_price": str(price), "discount_amount": "1", "tax_amount": "0.5",
            "item_total": str(Decimal(q * price) - Decimal("0.5")),
        })
    return rows + [{"order_item_id": "I0"}, {"order_item_id": "I99", "quantity": "0"}]


def payment_rows():
    rows = []
    for i in range(24):
        rows.append({
            "payment_id": f"T{i}", "order_id": f"O{i + 1:06d}", "payment_date": f"2026-07-{i % 9 + 2:02d}",
            "payment_status": "Success" if i % 4 else "Failed",
        })
    return rows + [{"payment_id": "T98", "order_id": "O000099"}, {"payment_id": "T99", "amount": "1"}]


def customer_rows():
    return [{"customer_id": f"C{i + 1:06d}"} for i in range(7)] + [{"customer_id": "C000001"}]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    raw = {"customers": customer_rows(), "orders": orders_rows(), "order_items": item_rows(), "payments": payment_rows()}
    for name, rows in raw.items():
        lake.write(frame(spark, name, rows), "raw", name)
        lake.copy(name)
    results = {}
    results["customers"] = flow.promote(lake, entities.customers(), order_by="ingest_seq")
    results["orders"] = flow.promote(lake, entities.orders(), order_by="ingest_seq")
    results["order_items"] = flow.promote(lake, entities.order_items(), order_by="ingest_seq")
    silver_orders = {"orders": lake.read("silver", "orders")}
    results["payments"] = flow.promote(lake, entities.payments(), silver_orders, "ingest_seq", unique_references=True)
    flow.build_marts(lake)
    return lake, results


def test_counts_agree_with_layers(lake):
    lake, results = lake
    for name, result in results.items():
        assert lake.read("bronze", name).count() == result.total
        assert lake.read("silver", name).count() == result.valid
        quarantine = lake.read("dq", name)
        assert quarantine.count() == result.invalid and quarantine.where("_dq_issue is null").count() == 0
        assert "_dq_issue" not in lake.read("silver", name).columns
    assert results["orders"].rule_counts["duplicate_order_record"] == 1
    assert results["orders"].rule_counts["invalid_customer_id"] == 1
    assert (results["orders"].total, results["orders"].invalid) == (26, 2)
    assert results["payments"].rule_counts["invalid_order_id"] == 1
    assert results["payments"].rule_counts["amount_mismatch_with_order"] == 1


def test_promote_all(spark, tmp_path):
    """Quarantined references do not count: payments of a bad order and stock of a bad product fall too."""
    lake = Lake(spark, str(tmp_path))
    raw = {
        "customers": [{}], "sellers": [{}, {"seller_id": "S00002", "seller_rating": 9.0}],
        "products": [{}, {"product_id": "P000002", "category": "Gadgets"}],
        "orders": [{}, {"order_id": "O000002", "tax_amount": "x"}],
        "order_items": [{}],
        "payments": [{}, {"payment_id": "T2", "order_id": "O000002"}],
        "inventory": [{}, {"inventory_id": "V2", "product_id": "P000002"}],
    }
    for name, rows in raw.items():
        lake.write(frame(spark, name, rows), "raw", name)
    results = flow.promote_all(lake, "2026-08-01", "ingest_seq")
    assert {n: (r.valid, r.invalid) for n, r in results.items()} == {
        "customers": (1, 0), "sellers": (1, 1), "products": (1, 1), "orders": (1, 1), "order_items": (1, 0),
        "payments": (1, 1), "inventory": (1, 1),
    }
    assert results["payments"].rule_counts["invalid_order_id"] == 1
    assert results["inventory"].rule_counts["invalid_product_id"] == 1
    flow.build_marts(lake)
    assert lake.read("gold", "customer_360").count() == 1 and lake.read("gold", "daily_sales").count() == 1


def test_promotion_needs_few_jobs(spark, lake):
    lake, _ = lake
    spark.sparkContext.setJobGroup("promotion", "")
    flow.promote(lake, entities.order_items(), order_by="ingest_seq")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("promotion")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # stages of one adaptive query are submitted as jobs of their own; per-rule counting would need 12 more
    assert len(jobs) <= 12


def test_intermediate_tables_go_to_the_shared_folder():
    def session(folder):
        context = SimpleNamespace(master="spark://cluster:1")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)

    one, other = (new_path(session("/shared/checkpoints"), "orders") for _ in range(2))
    assert one.startswith("/shared/checkpoints/orders-") and one != other
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        new_path(session(None), "orders")


def _silver():
    orders = {r["order_id"]: r for r in orders_rows()[:24]}
    items = [r for r in item_rows()[:60]]
    payments = [r for r in payment_rows()[:24]]
    return orders, items, payments


DONE = ("Confirmed", "Shipped", "Delivered")


def test_customer_360(lake):
    lake, _ = lake
    orders, items, payments = _silver()
    want = {}
    for i in range(7):
        customer = f"C{i + 1:06d}"
        mine = [o for o in orders.values() if o["customer_id"] == customer]
        done = [o for o in mine if o["order_status"] in DONE]
        ids = {o["order_id"] for o in done}
        lines = [x for x in items if x["order_id"] in ids]
        spend = sum((Decimal(x["item_total"]) for x in lines), Decimal(0))
        dates = sorted(dt.datetime.fromisoformat(o["order_date"]) for o in done)
        paid = sum(Decimal(100) for p in payments if p["payment_status"] == "Success" and p["order_id"] in {o["order_id"] for o in mine})
        want[customer] = (
            len(mine), len(done), sum(o["order_status"] == "Cancelled" for o in mine),
            sum(o["order_status"] == "Returned" for o in mine), sum(int(x["quantity"]) for x in lines), spend,
            dates[0] if dates else None, dates[-1] if dates else None, paid,
            (dates[-1] - dates[0]).days if dates else None, float(spend / len(done)) if done else 0.0,
        )
    rows = lake.read("gold", "customer_360").orderBy("customer_id").collect()
    assert [r.customer_id for r in rows] == sorted(want)
    for r in rows:
        got = (r.total_orders, r.completed_orders, r.cancelled_orders, r.returned_orders, r.total_items_purchased,
               r.total_spend, r.first_order_date, r.last_order_date, r.successful_payment_amount,
               r.customer_lifetime_days)
        assert got == want[r.customer_id][:-1], r.customer_id
        assert float(r.average_order_value) == pytest.approx(want[r.customer_id][-1], abs=0.0051)


def test_daily_sales(lake):
    lake, _ = lake
    orders, items, payments = _silver()
    days = defaultdict(list)
    for x in items:
        o = orders.get(x["order_id"])
        if o and o["order_status"] in DONE:
            days[o["order_date"][:10]].append((o, x))
    paid = defaultdict(Decimal)
    for p in payments:
        if p["payment_status"] == "Success":
            paid[p["payment_date"]] += 100
    rows = {str(r.sales_date): r for r in lake.read("gold", "daily_sales").collect()}
    assert set(rows) == set(days)
    for day, pairs in days.items():
        r = rows[day]
        n = len({o["order_id"] for o, _ in pairs})
        net = sum(Decimal(x["item_total"]) for _, x in pairs)
        assert (r.total_orders, r.total_order_items) == (n, len({x["order_item_id"] for _, x in pairs}))
        assert r.total_quantity == sum(int(x["quantity"]) for _, x in pairs)
        assert r.gross_sales == sum(int(x["quantity"]) * int(x["unit_price"]) for _, x in pairs)
        assert (r.discount_amount, r.tax_amount, r.net_sales) == (len(pairs), Decimal("0.5") * len(pairs), net)
        assert r.unique_customers == len({o["customer_id"] for o, _ in pairs})
        assert r.unique_products == len({x["product_id"] for _, x in pairs})
        assert r.successful_payment_amount == paid[day]
        assert float(r.average_order_value) == pytest.approx(float(net / n), abs=0.0051)


def test_marts_accept_unclean_input(spark):
    """Repeated line ids count once, orders without lines and days without sales stay out."""
    orders = frame(spark, "orders", [{}, {"order_id": "O000002", "order_status": "Pending"}, {"order_id": "O000003", "order_date": "bad"}])
    items = frame(spark, "order_items", [{}, {}, {"order_item_id": "I2", "item_total": None, "quantity": "x"},
                                         {"order_id": "O000002"}, {"order_id": "O000003"}, {"order_id": None}])
    payments = frame(spark, "payments", [{"payment_date": "2026-07-05"}])
    rows = marts.daily_sales(orders, items, payments).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (str(r.sales_date), r.total_orders, r.total_order_items, r.total_quantity) == ("2026-07-01", 1, 2, 4)
    assert (float(r.net_sales), float(r.successful_payment_amount)) == (190.0, 0.0)
    strict = marts.daily_sales(orders, items, payments, item_ids_unique=True).first()
    assert strict.total_order_items == 3


def test_sales_with_product_keeps_unknown_products(spark):
    orders = frame(spark, "orders", [{}])
    items = frame(spark, "order_items", [{}, {"order_item_id": "I2", "product_id": "P000777"}])
    products = frame(spark, "products", [{}, {"brand": "A"}])
    rich = marts.sales_with_product(marts.sales_lines(orders, items), products)
    got = sorted((r.product_id, r.category, r.brand) for r in rich.collect())
    assert got == [("P000001", "Fashion", "A"), ("P000777", None, None)]


def test_rule_set_parameters():
    default = {r.entity: r for r in flow.rule_sets("2026-08-01")}
    wide = {r.entity: r for r in flow.rule_sets("2026-08-01", orders={"max_customer": None}, products={})}
    assert list(default) == list(wide) and str(default["orders"].rules[3]) != str(wide["orders"].rules[3])
    with pytest.raises(ValueError):
        flow.rule_sets("2026-08-01", order={})

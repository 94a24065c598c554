"""Every rule of every entity fires alone, precedence holds, splits lose nothing."""

import pytest
from pyspark.sql import functions as F

from siftlake import entities
from siftlake.operators import report, validate as dq

from rows import VALID, frame

KEY = {
    "customers": "customer_id", "sellers": "seller_id", "products": "product_id", "orders": "order_id",
    "order_items": "order_item_id", "payments": "payment_id", "inventory": "inventory_id",
}

# label -> changes that break only that rule (each row gets its own id unless the change sets one)
BREAKS = {
    "customers": {
        "missing_customer_id": [{"customer_id": v} for v in (None, "", "  ", "\t", "\n")],
        "missing_first_name": [{"first_name": v} for v in (None, " ")],
        "missing_last_name": [{"last_name": v} for v in (None, "")],
        "invalid_gender": [{"gender": v} for v in (None, "", "male", " Male")],
        "invalid_date_of_birth": [{"date_of_birth": v} for v in (None, "", "30/10/2022", "2026-02-30", "2026-08", "2026")],
        "future_date_of_birth": [{"date_of_birth": v} for v in ("2026-08-02", "2026-08-01 10:00:00")],
        "invalid_email": [{"email": v} for v in (None, "", "a@b", "a b@c.d", "a@@b.c")],
        "invalid_phone": [{"phone": v} for v in (None, "5999999999", "987654321", "98765432101", "N/A", "9876543210\n")],
        "missing_city": [{"city": v} for v in (None, "\t ")],
        "missing_state": [{"state": v} for v in (None, "")],
        "invalid_country": [{"country": v} for v in (None, "india", "US", "")],
        "invalid_postal_code": [{"postal_code": v} for v in (None, "12345", "1234567", "12345a", "123456\n")],
        "invalid_registration_date": [{"registration_date": v} for v in (None, "01-01-2020")],
        "future_registration_date": [{"registration_date": "2026-08-02"}],
        "invalid_loyalty_tier": [{"loyalty_tier": v} for v in (None, "gold")],
        "invalid_customer_status": [{"customer_status": v} for v in (None, "Blocked")],
    },
    "sellers": {
        "missing_seller_id": [{"seller_id": v} for v in (None, " ")],
        "missing_seller_name": [{"seller_name": v} for v in (None, "")],
        "invalid_email": [{"email": "shop"}],
        "invalid_phone": [{"phone": "5999999999"}],
        "missing_city": [{"city": ""}],
        "missing_state": [{"state": None}],
        "invalid_country": [{"country": v} for v in (None, "Nepal")],
        "invalid_seller_rating": [{"seller_rating": v} for v in (None, 0.99, 5.01, float("nan"))],
        "invalid_seller_status": [{"seller_status": "Discontinued"}],
        "invalid_joined_date": [{"joined_date": "2020"}],
        "future_joined_date": [{"joined_date": "2026-08-02"}],
    },
    "products": {
        "missing_required_field_product_id": [{"product_id": v} for v in (None, "")],
        "invalid_seller_id": [{"seller_id": v} for v in (None, "S00000", "S01001", "s00001", "S0001", "SXXXXX")],
        "missing_product_name": [{"product_name": v} for v in (None, " ")],
        "invalid_category": [{"category": v} for v in (None, "Gadgets")],
        "invalid_subcategory": [{"subcategory": v} for v in (None, "Mobiles")],
        "invalid_unit_price": [{"unit_price": v} for v in (None, "0", "-1", "abc", "NaN", "Rs.499.0")],
        "invalid_cost_price": [{"cost_price": v} for v in (None, "0", "100", "101", "x")],
        "invalid_stock_quantity": [{"stock_quantity": v} for v in (None, "-1", "many")],
        "invalid_product_status": [{"product_status": v} for v in (None, "active")],
        "invalid_created_date": [{"created_date": v} for v in (None, "2020-13-01")],
        "future_created_date": [{"created_date": "2026-08-02"}],
    },
    "orders": {
        "missing_required_field_order_id": [{"order_id": v} for v in (None, " ")],
        "missing_customer_id": [{"customer_id": v} for v in (None, "")],
        "invalid_customer_id": [{"customer_id": v} for v in ("C000000", "C050001", "c000001", "C00001", "CXXXXXX")],
        "invalid_order_date": [{"order_date": v} for v in (None, "2026/07/01")],
        "future_order_date": [{"order_date": "2026-08-01 00:00:01"}],
        "invalid_order_status": [{"order_status": v} for v in (None, "delivered", " Shipped")],
        "invalid_payment_method": [{"payment_method": v} for v in (None, "Cheque")],
        "missing_shipping_city": [{"shipping_city": v} for v in (None, "\n")],
        "missing_shipping_state": [{"shipping_state": ""}],
        "invalid_shipping_postal_code": [{"shipping_postal_code": v} for v in (None, "1234")],
        "invalid_subtotal_amount": [{"subtotal_amount": v} for v in (None, "abc", "NaN")],
        "invalid_discount_amount": [{"discount_amount": v} for v in (None, "x")],
        "discount_exceeds_subtotal": [{"discount_amount": "100.01", "total_amount": "9.99"}],
        "invalid_shipping_fee": [{"shipping_fee": v} for v in (None, "free")],
        "invalid_tax_amount": [{"tax_amount": v} for v in (None, "none")],
        "invalid_total_amount": [{"total_amount": v} for v in (None, "-1", "100.01", "99.99", "x")],
    },
    "order_items": {
        "missing_order_item_id": [{"order_item_id": v} for v in (None, "")],
        "missing_order_id": [{"order_id": v} for v in (None, " ")],
        "invalid_order_id": [{"order_id": v} for v in ("O000000", "O050001", "X000001")],
        "missing_product_id": [{"product_id": None}],
        "invalid_product_id": [{"product_id": v} for v in ("P000000", "P010001", "P1")],
        "invalid_quantity": [{"quantity": v} for v in (None, "0", "-1", "1.5", "1.001", "abc")],
        "invalid_unit_price": [{"unit_price": v} for v in (None, "0", "NaN")],
        "invalid_discount_amount": [{"discount_amount": v} for v in (None, "-1")],
        "discount_exceeds_gross_amount": [{"discount_amount": "100.01", "item_total": "4.99"}],
        "invalid_tax_amount": [{"tax_amount": v} for v in (None, "-0.01")],
        "invalid_item_total": [{"item_total": v} for v in (None, "-1", "95.01")],
    },
    "payments": {
        "missing_payment_id": [{"payment_id": v} for v in (None, " ")],
        "missing_order_id": [{"order_id": v} for v in (None, "")],
        "invalid_order_id": [{"order_id": "O000009"}],
        "invalid_payment_date": [{"payment_date": v} for v in (None, "soon")],
        "future_payment_date": [{"payment_date": "2026-08-02"}],
        "payment_before_order_date": [{"payment_date": "2026-06-30"}],
        "invalid_payment_method": [{"payment_method": None}],
        "invalid_payment_status": [{"payment_status": v} for v in (None, "Done")],
        "invalid_transaction_reference": [{"transaction_reference": v} for v in ("TXN", "txn1", "TXN1x")],
        "invalid_amount": [{"amount": v} for v in (None, "0", "-5", "x")],
        "invalid_currency": [{"currency": v} for v in (None, "USD")],
        "invalid_payment_gateway": [{"payment_gateway": v} for v in (None, "Paytm")],
        "missing_transaction_reference": [
            {"transaction_reference": None}, {"payment_status": "Refunded", "transaction_reference": " "},
        ],
        "amount_mismatch_with_order": [{"amount": "100.01"}],
    },
    "inventory": {
        "missing_inventory_id": [{"inventory_id": v} for v in (None, " ")],
        "missing_product_id": [{"product_id": None}],
        "invalid_product_id": [{"product_id": "P000009"}],
        "invalid_warehouse_id": [{"warehouse_id": v} for v in (None, "W011", " W001")],
        "invalid_stock_quantity": [{"stock_quantity": v} for v in (None, "1.5", "x")],
        "invalid_reserved_quantity": [{"reserved_quantity": v} for v in (None, "-1", "0.5")],
        "reserved_exceeds_stock": [{"reserved_quantity": "11"}],
        "invalid_available_quantity": [{"available_quantity": v} for v in (None, "-1", "7.5")],
        "available_quantity_mismatch": [{"available_quantity": "7"}],
        "invalid_reorder_level": [{"reorder_level": v} for v in (None, "-1", "x")],
        "invalid_inventory_status": [{"inventory_status": v} for v in (None, "Gone", " In Stock")],
        "inventory_status_mismatch": [
            {"inventory_status": "Out of Stock"}, {"reorder_level": "8"},
            {"stock_quantity": "2", "available_quantity": "0"},
        ],
        "invalid_last_updated": [{"last_updated": None}],
        "future_last_updated": [{"last_updated": "2026-08-01 10:00:00"}],
    },
}

# values next to the bounds that stay valid
ACCEPTED = {
    "customers": [{"email": "a@b.c"}, {"phone": "6000000000"}, {"phone": " 9999999999 "}, {"postal_code": "000000"},
                  {"date_of_birth": "2026-08-01"}, {"registration_date": "2026-07-31 10:00:00"}, {"country": " India "}],
    "sellers": [{"seller_rating": 1.0}, {"joined_date": "2026-08-01"}],
    "products": [{"seller_id": "S01000"}, {"category": "Electronics", "subcategory": "Accessories"},
                 {"unit_price": "1e3"}, {"unit_price": " 120 "}, {"stock_quantity": "0"}, {"cost_price": "0.004", "unit_price": "0.005"}],
    "orders": [{"customer_id": "C050000"}, {"total_amount": "100.004"}, {"order_date": "2026-08-01"},
               {"discount_amount": "100.00", "total_amount": "10.00"}, {"order_date": "2026-07-01T10:00:00"}],
    "order_items": [{"quantity": "2.0"}, {"item_total": "95.004"}, {"product_id": "P010000"}],
    "payments": [{"payment_status": "Pending", "transaction_reference": None}, {"amount": "100.004"},
                 {"payment_date": "2026-07-01"}, {"transaction_reference": " TXN7 "}],
    "inventory": [{"inventory_status": "Overstocked"}, {"inventory_status": "Low Stock"}, {"reorder_level": "8", "inventory_status": "Low Stock"},
                  {"stock_quantity": "2", "available_quantity": "0", "inventory_status": "Out of Stock"}, {"last_updated": "2026-08-01"}],
}

BUILD = {
    "customers": entities.customers, "sellers": entities.sellers, "products": entities.products_strict,
    "orders": entities.orders, "order_items": entities.order_items, "payments": entities.payments,
    "inventory": entities.inventory,
}


def references(spark):
    return {"orders": frame(spark, "orders", [{}]), "products": frame(spark, "products", [{}])}


def with_ids(entity, changes):
    """Give every row its own key unless the change touches the key."""
    key = KEY[entity]
    return [{key: f"{VALID[entity][key]}-{i}", **c} for i, c in enumerate(changes)]


def label(spark, entity, changes, ruleset=None):
    ruleset = ruleset or BUILD[entity]()
    rows = dq.validate(frame(spark, entity, changes), ruleset, references(spark), "ingest_seq")
    return [r[dq.ISSUE] for r in rows.orderBy("ingest_seq").collect()]


@pytest.mark.parametrize("entity", list(BREAKS))
def test_each_rule_fires_alone(spark, entity):
    expected, changes = [], []
    for name, breaking in BREAKS[entity].items():
        for change in breaking:
            # blank keys are duplicates of each other, so every one of them comes in its own run below
            if KEY[entity] in change:
                continue
            expected.append(name)
            changes.append(change)
    accepted = ACCEPTED[entity]
    got = label(spark, entity, with_ids(entity, changes + accepted))
    assert list(zip(got[: len(changes)], changes)) == list(zip(expected, changes))
    assert got[len(changes):] == [None] * len(accepted), list(zip(got[len(changes):], accepted))


@pytest.mark.parametrize("entity", list(BREAKS))
def test_missing_keys(spark, entity):
    name = next(n for n in BREAKS[entity] if n.startswith("missing"))
    changes = BREAKS[entity][name]
    assert label(spark, entity, changes) == [name] * len(changes)


@pytest.mark.parametrize("entity", list(BREAKS))
def test_all_rules_are_covered(spark, entity):
    duplicate = {l for l in BUILD[entity]().labels if l.startswith("duplicate")}
    assert len(duplicate) == 1
    assert set(BREAKS[entity]) == set(BUILD[entity]().labels) - duplicate


def test_rule_totals(spark):
    assert sum(len(b().labels) for b in BUILD.values()) == 100


@pytest.mark.parametrize("entity", list(BREAKS))
def test_keep_first_and_precedence(spark, entity):
    """The first copy stays, later copies are duplicates; a broken first copy takes the entity out."""
    ruleset = BUILD[entity]()
    duplicate = next(l for l in ruleset.labels if l.startswith("duplicate"))
    name, changes = list(BREAKS[entity].items())[-1]
    got = label(spark, entity, [{}, {}, {}])
    assert got == [None, duplicate, duplicate]
    assert label(spark, entity, [changes[0], {}]) == [name, duplicate]


def test_first_of_two_issues_wins(spark):
    rows = [{"gender": "x", "phone": "1"}, {"phone": "1", "customer_status": None}]
    assert label(spark, "customers", with_ids("customers", rows)) == ["invalid_gender", "invalid_phone"]


def test_null_keys_option(spark):
    rows = [{"order_id": None}, {"order_id": None}]
    missing = "missing_required_field_order_id"
    assert label(spark, "orders", rows) == [missing, missing]
    got = label(spark, "orders", rows, entities.orders(null_keys="equal"))
    assert got == [missing, "duplicate_order_record"]


def test_flag_all_policy(spark):
    got = label(spark, "customers", [{}, {}, {"customer_id": "C000002"}], entities.customers(duplicates="all"))
    assert got == ["duplicate_customer_id", "duplicate_customer_id", None]


def test_multi_labels_products(spark):
    rows = [
        {"product_id": "A"},
        {"product_id": "A"},
        {"product_id": "B", "unit_price": "0", "cost_price": "5", "created_date": "2020-01-01 10:00:00"},
        {"product_id": "C", "cost_price": "100", "subcategory": "Mobiles", "seller_id": "S99999"},
        {"product_id": None, "category": " "},
        {"product_id": None},
        {"product_id": "D", "cost_price": "0", "created_date": "2026-08-01"},
        {"product_id": "E", "created_date": "2026-08-02"},
    ]
    assert label(spark, "products", rows, entities.products_multi()) == [
        "duplicate_product_id",
        "duplicate_product_id",
        "invalid_unit_price|invalid_cost_price|invalid_created_date",
        None,
        "missing_product_id|invalid_category",
        "missing_product_id",
        None,
        "future_created_date",
    ]


def test_inventory_variant_by_day_and_trimmed(spark):
    rows = [{"last_updated": "2026-08-01 10:00:00", "warehouse_id": " W001 ", "inventory_status": " In Stock "},
            {"inventory_id": " V1 "}]
    assert label(spark, "inventory", rows, entities.inventory(grain="date", trim=True)) == [None, "duplicate_inventory_record"]
    assert label(spark, "inventory", rows) == ["invalid_warehouse_id", None]


@pytest.mark.parametrize("entity", list(BREAKS))
def test_split_is_lossless_and_silver_is_clean(spark, entity):
    changes = [c for breaking in BREAKS[entity].values() for c in breaking] + [{}] + with_ids(entity, ACCEPTED[entity])
    df = frame(spark, entity, changes)
    ruleset = BUILD[entity]()
    labelled = dq.validate(df, ruleset, references(spark), "ingest_seq")
    silver, quarantine = dq.split(labelled)
    assert dq.ISSUE not in silver.columns and dq.ISSUE in quarantine.columns
    assert silver.count() + quarantine.count() == len(changes)
    assert silver.unionByName(quarantine.drop(dq.ISSUE)).exceptAll(df).count() == 0
    assert silver.count() >= len(ACCEPTED[entity])
    assert report.check_rules(silver, ruleset, references(spark), "ingest_seq").where("violations > 0").count() == 0
    assert silver.groupBy(KEY[entity]).count().where("count > 1").count() == 0
    # validating silver again, even with a stale label column, changes nothing
    again = dq.validate(silver.withColumn(dq.ISSUE, F.lit("old")), ruleset, references(spark), "ingest_seq")
    assert again.where(F.col(dq.ISSUE).isNotNull()).count() == 0


def test_validity_flag_agrees_with_label(spark):
    ruleset = entities.orders()
    changes = with_ids("orders", [c for b in BREAKS["orders"].values() for c in b] + [{}])
    rows = dq.prepare(frame(spark, "orders", changes), ruleset, None, "ingest_seq")
    flagged = rows.select(dq.is_valid(ruleset.rules).alias("ok"), dq.first_issue(ruleset.rules).isNull().alias("unlabelled"))
    assert flagged.where("ok is null or ok <> unlabelled").count() == 0


def test_without_arrival_order_exact_copies_are_resends(spark):
    rows = frame(spark, "orders", [{}, {}, {"order_id": "O000002"}]).drop("ingest_seq")
    labels = sorted(str(r._dq_issue) for r in dq.validate(rows, entities.orders()).collect())
    assert labels == ["None", "None", "duplicate_order_record"]


@pytest.mark.parametrize("value, parsed", [
    ("2026-01-01T10:00:00Z", "2026-01-01 10:00:00"), ("2026-01-01 10:00+05:30", "2026-01-01 04:30:00"),
    ("2026-01-01 10:00", "2026-01-01 10:00:00"), ("2026-01-01T10:00:00.1234567", "2026-01-01 10:00:00.123456"),
    ("2026-01-01", "2026-01-01 00:00:00"), ("2026-01", None), ("2026", None), ("2026-02-30", None),
])
def test_timestamp_forms(spark, value, parsed):
    from pyspark.sql import functions as F
    from siftlake.functions.parsing import timestamp

    row = spark.createDataFrame([(value,)], "v string").select(timestamp(F.col("v")).alias("t")).first()
    assert (None if row.t is None else str(row.t)) == parsed


def test_numbers_beyond_the_usual(spark):
    """Large and tiny amounts are judged as they are, and ids with outer spaces are not codes."""
    from siftlake.plans import marts

    changes = [
        {"quantity": "1000000000000", "item_total": "1"}, {"unit_price": "0.0000001"}, {"quantity": "1.0000001"},
        {"order_id": " O000001 "}, {"order_id": "O000001"},
    ]
    rows = frame(spark, "order_items", [{**c, "order_item_id": str(i)} for i, c in enumerate(changes)])
    got = [r._dq_issue for r in dq.validate(rows, entities.order_items(), None, "ingest_seq").orderBy("ingest_seq").collect()]
    # A discount of 10 exceeds a gross amount of next to nothing.
    assert got == ["invalid_item_total", "discount_exceeds_gross_amount", "invalid_quantity", "invalid_order_id", None]
    items = frame(spark, "order_items", [{"order_item_id": str(i), "item_total": "20000000000000000"} for i in range(3)])
    mart = marts.daily_sales(frame(spark, "orders", [{}]), items, frame(spark, "payments", [{}]), item_ids_unique=True)
    assert mart.first().net_sales == 60000000000000000

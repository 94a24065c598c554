"""SQL counterparts of the registered queries, written rule by rule and independent of the library."""

from .views import AS_OF, ORDER_BY, sql_view

NOW = f"TIMESTAMP '{AS_OF} 00:00:00'"


def blank(c: str) -> str:
    return f"({c} IS NULL OR regexp_full_match({c}, '\\s*'))"


def num(c: str) -> str:
    return f"TRY_CAST({c} AS DECIMAL(30,10))"


def ts(c: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({c}), '\\d{{4}}-\\d{{2}}-\\d{{2}}([ T]\\d{{2}}:\\d{{2}}:\\d{{2}})?') "
        f"THEN TRY_CAST(trim({c}) AS TIMESTAMP) END"
    )


def day_only(c: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({c}), '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST(trim({c}) AS DATE) END"


def outside(c: str, *values: str) -> str:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"({c} IS NULL OR {c} NOT IN ({listed}))"


def unlike(c: str, pattern: str) -> str:
    return f"({c} IS NULL OR NOT regexp_full_match(trim({c}), '{pattern}'))"


def no_code(c: str, prefix: str, digits: int, high: int | None = None, low: int | None = 1) -> str:
    number = f"CAST(substr({c}, {len(prefix) + 1}) AS BIGINT)"
    bounds = []
    if low is not None:
        bounds.append(f"{number} < {low}")
    if high is not None:
        bounds.append(f"{number} > {high}")
    rest = f" WHEN {' OR '.join(bounds)} THEN true" if bounds else ""
    return f"(CASE WHEN {c} IS NULL OR NOT regexp_full_match({c}, '{prefix}[0-9]{{{digits}}}') THEN true{rest} ELSE false END)"


def product(a: str, b: str) -> str:
    """Product of two parsed numbers, NULL for huge ones; the casts keep seven places and leave room for the product."""
    return f"TRY_CAST({a} AS DECIMAL(20,7)) * TRY_CAST({b} AS DECIMAL(18,7))"


def huge(a: str, b: str) -> str:
    return f"({a} IS NOT NULL AND {b} IS NOT NULL AND {product(a, b)} IS NULL)"


def ratio(amount: str, n: str) -> str:
    """amount / n rounded half-up to two places in whole numbers; the amount has at most six places."""
    return f"CAST((2 * CAST(CAST({amount} AS DECIMAL(28,6)) * 1000000 AS HUGEINT) + {n} * 10000) // (2 * {n} * 10000) AS DOUBLE) / 100"


EMAIL = "[^@\\s]+@[^@\\s]+\\.[^@\\s]+"
MOBILE = "[6-9][0-9]{9}"
POSTAL = "[0-9]{6}"
METHODS = ("UPI", "Credit Card", "Debit Card", "Net Banking", "Cash on Delivery", "Wallet")

PAIRS = """(VALUES
 ('Electronics','Mobiles'),('Electronics','Laptops'),('Electronics','Headphones'),('Electronics','Cameras'),
 ('Electronics','Smart Watches'),('Electronics','Accessories'),
 ('Fashion','Men''s Clothing'),('Fashion','Women''s Clothing'),('Fashion','Footwear'),('Fashion','Watches'),('Fashion','Accessories'),
 ('Home & Kitchen','Cookware'),('Home & Kitchen','Furniture'),('Home & Kitchen','Home Decor'),('Home & Kitchen','Storage'),
 ('Home & Kitchen','Kitchen Appliances'),
 ('Beauty & Personal Care','Skincare'),('Beauty & Personal Care','Haircare'),('Beauty & Personal Care','Makeup'),
 ('Beauty & Personal Care','Fragrances'),('Beauty & Personal Care','Personal Hygiene'),
 ('Grocery','Staples'),('Grocery','Snacks'),('Grocery','Beverages'),('Grocery','Dairy'),('Grocery','Personal Care'),
 ('Sports & Fitness','Fitness Equipment'),('Sports & Fitness','Sportswear'),('Sports & Fitness','Outdoor Gear'),('Sports & Fitness','Yoga'),
 ('Books','Fiction'),('Books','Non-Fiction'),('Books','Academic'),('Books','Children''s Books'),('Books','Comics'),
 ('Toys','Action Figures'),('Toys','Educational Toys'),('Toys','Board Games'),('Toys','Outdoor Toys'),('Toys','Puzzles'),
 ('Automotive','Car Accessories'),('Automotive','Bike Accessories'),('Automotive','Car Care'),('Automotive','Tools'),
 ('Health & Wellness','Supplements'),('Health & Wellness','Medical Devices'),('Health & Wellness','Ayurveda'),
 ('Health & Wellness','Personal Health')) AS pairs(category, subcategory)"""

CATEGORIES = (
    "Electronics", "Fashion", "Home & Kitchen", "Beauty & Personal Care", "Grocery", "Sports & Fitness", "Books",
    "Toys", "Automotive", "Health & Wellness",
)

# Parsed helper columns and ordered (label, condition) lists per rule set.
PARSED = {
    "customers": {"dob": ts("date_of_birth"), "reg": ts("registration_date")},
    "sellers": {"joined": ts("joined_date"), "rating": num("seller_rating")},
    "products": {
        "price": num("unit_price"), "cost": num("cost_price"), "stock": num("stock_quantity"),
        "created": ts("created_date"), "created_day": day_only("created_date"),
    },
    "orders": {
        "odate": ts("order_date"), "subtotal": num("subtotal_amount"), "discount": num("discount_amount"),
        "shipping": num("shipping_fee"), "tax": num("tax_amount"), "total": num("total_amount"),
    },
    "order_items": {
        "q": num("quantity"), "price": num("unit_price"), "discount": num("discount_amount"),
        "tax": num("tax_amount"), "total": num("item_total"),
    },
    "payments": {"paid": ts("payment_date"), "amt": num("amount")},
    "inventory": {
        "stock": num("stock_quantity"), "reserved": num("reserved_quantity"), "available": num("available_quantity"),
        "reorder": num("reorder_level"), "updated": ts("last_updated"),
    },
}

RULES = {
    "customers": [
        ("missing_customer_id", blank("customer_id")),
        ("duplicate_customer_id", "copy_no > 1"),
        ("missing_first_name", blank("first_name")),
        ("missing_last_name", blank("last_name")),
        ("invalid_gender", outside("gender", "Male", "Female", "Other")),
        ("invalid_date_of_birth", "dob IS NULL"),
        ("future_date_of_birth", f"dob > {NOW}"),
        ("invalid_email", unlike("email", EMAIL)),
        ("invalid_phone", unlike("phone", MOBILE)),
        ("missing_city", blank("city")),
        ("missing_state", blank("state")),
        ("invalid_country", "trim(country) IS DISTINCT FROM 'India'"),
        ("invalid_postal_code", unlike("postal_code", POSTAL)),
        ("invalid_registration_date", "reg IS NULL"),
        ("future_registration_date", f"reg > {NOW}"),
        ("invalid_loyalty_tier", outside("loyalty_tier", "Bronze", "Silver", "Gold")),
        ("invalid_customer_status", outside("customer_status", "Active", "Inactive")),
    ],
    "sellers": [
        ("missing_seller_id", blank("seller_id")),
        ("duplicate_seller_id", "copy_no > 1"),
        ("missing_seller_name", blank("seller_name")),
        ("invalid_email", unlike("email", EMAIL)),
        ("invalid_phone", unlike("phone", MOBILE)),
        ("missing_city", blank("city")),
        ("missing_state", blank("state")),
        ("invalid_country", "trim(country) IS DISTINCT FROM 'India'"),
        ("invalid_seller_rating", "rating IS NULL OR rating < 1 OR rating > 5"),
        ("invalid_seller_status", outside("seller_status", "Active", "Inactive")),
        ("invalid_joined_date", "joined IS NULL"),
        ("future_joined_date", f"joined > {NOW}"),
    ],
    "products": [
        ("duplicate_product_record", "copy_no > 1"),
        ("missing_required_field_product_id", blank("product_id")),
        ("invalid_seller_id", no_code("seller_id", "S", 5, 1000)),
        ("missing_product_name", blank("product_name")),
        ("invalid_category", outside("category", *CATEGORIES)),
        ("invalid_subcategory", "NOT listed"),
        ("invalid_unit_price", "price IS NULL OR price <= 0"),
        ("invalid_cost_price", "cost IS NULL OR cost <= 0 OR cost >= price"),
        ("invalid_stock_quantity", "stock IS NULL OR stock < 0"),
        ("invalid_product_status", outside("product_status", "Active", "Inactive", "Discontinued")),
        ("invalid_created_date", "created IS NULL"),
        ("future_created_date", f"created > {NOW}"),
    ],
    "products_multi": [
        ("missing_product_id", blank("product_id")),
        ("duplicate_product_id", "product_id IS NOT NULL AND copies > 1"),
        ("invalid_seller_id", unlike("seller_id", "S[0-9]{5}")),
        ("missing_product_name", blank("product_name")),
        ("invalid_category", blank("category")),
        ("invalid_subcategory", blank("subcategory")),
        ("invalid_unit_price", "price IS NULL OR price <= 0"),
        ("invalid_cost_price", "cost IS NULL OR cost < 0 OR cost > price"),
        ("invalid_stock_quantity", "stock IS NULL OR stock < 0"),
        ("invalid_product_status", outside("product_status", "Active", "Inactive", "Discontinued")),
        ("invalid_created_date", "created_day IS NULL"),
        ("future_created_date", f"created_day > DATE '{AS_OF}'"),
    ],
    "orders": [
        ("duplicate_order_record", "copy_no > 1"),
        ("missing_required_field_order_id", blank("order_id")),
        ("missing_customer_id", blank("customer_id")),
        ("invalid_customer_id", no_code("customer_id", "C", 9)),
        ("invalid_order_date", "odate IS NULL"),
        ("future_order_date", f"odate > {NOW}"),
        ("invalid_order_status", outside("order_status", "Pending", "Confirmed", "Shipped", "Delivered", "Cancelled", "Returned")),
        ("invalid_payment_method", outside("payment_method", *METHODS)),
        ("missing_shipping_city", blank("shipping_city")),
        ("missing_shipping_state", blank("shipping_state")),
        ("invalid_shipping_postal_code", unlike("shipping_postal_code", POSTAL)),
        ("invalid_subtotal_amount", "subtotal IS NULL OR subtotal <= 0"),
        ("invalid_discount_amount", "discount IS NULL OR discount < 0"),
        ("discount_exceeds_subtotal", "discount > subtotal"),
        ("invalid_shipping_fee", "shipping IS NULL OR shipping < 0"),
        ("invalid_tax_amount", "tax IS NULL OR tax < 0"),
        ("invalid_total_amount", "total IS NULL OR total < 0 OR round(total, 2) <> round(subtotal - discount + shipping + tax, 2)"),
    ],
    "order_items": [
        ("duplicate_order_item_record", "copy_no > 1"),
        ("missing_order_item_id", blank("order_item_id")),
        ("missing_order_id", blank("order_id")),
        ("invalid_order_id", no_code("order_id", "O", 9)),
        ("missing_product_id", blank("product_id")),
        ("invalid_product_id", no_code("product_id", "P", 9)),
        ("invalid_quantity", "q IS NULL OR q <= 0 OR q <> floor(q)"),
        ("invalid_unit_price", "price IS NULL OR price <= 0"),
        ("invalid_discount_amount", "discount IS NULL OR discount < 0"),
        ("discount_exceeds_gross_amount", f"discount > round({product('q', 'price')}, 2)"),
        ("invalid_tax_amount", "tax IS NULL OR tax < 0"),
        ("invalid_item_total", f"total IS NULL OR total < 0 OR round(total, 2) <> round({product('q', 'price')} - discount + tax, 2) "
         f"OR ({huge('q', 'price')} AND discount IS NOT NULL AND tax IS NOT NULL)"),
    ],
    "payments": [
        ("duplicate_payment_record", "copy_no > 1"),
        ("missing_payment_id", blank("payment_id")),
        ("missing_order_id", blank("order_id")),
        ("invalid_order_id", "ref_id IS NULL"),
        ("invalid_payment_date", "paid IS NULL"),
        ("future_payment_date", f"paid > {NOW}"),
        ("payment_before_order_date", "paid < ref_date"),
        ("invalid_payment_method", outside("payment_method", *METHODS)),
        ("invalid_payment_status", outside("payment_status", "Pending", "Success", "Failed", "Refunded", "Cancelled")),
        ("invalid_transaction_reference", f"NOT {blank('transaction_reference')} AND NOT regexp_full_match(trim(transaction_reference), 'TXN[0-9]+')"),
        ("invalid_amount", "amt IS NULL OR amt <= 0"),
        ("invalid_currency", outside("currency", "INR")),
        ("invalid_payment_gateway", outside("payment_gateway", "Razorpay", "PayU", "Cashfree", "Stripe")),
        ("missing_transaction_reference", f"payment_status IN ('Success', 'Refunded') AND {blank('transaction_reference')}"),
        ("amount_mismatch_with_order", "round(amt, 2) <> round(ref_total, 2)"),
    ],
    "inventory": [
        ("duplicate_inventory_record", "copy_no > 1"),
        ("missing_inventory_id", blank("inventory_id")),
        ("missing_product_id", blank("product_id")),
        ("invalid_product_id", "ref_id IS NULL"),
        ("invalid_warehouse_id", outside("warehouse_id", *[f"W{i:03d}" for i in range(1, 11)])),
        ("invalid_stock_quantity", "stock IS NULL OR stock < 0 OR stock <> floor(stock)"),
        ("invalid_reserved_quantity", "reserved IS NULL OR reserved < 0 OR reserved <> floor(reserved)"),
        ("reserved_exceeds_stock", "reserved > stock"),
        ("invalid_available_quantity", "available IS NULL OR available < 0 OR available <> floor(available)"),
        ("available_quantity_mismatch", "available <> stock - reserved"),
        ("invalid_reorder_level", "reorder IS NULL OR reorder < 0 OR reorder <> floor(reorder)"),
        ("invalid_inventory_status", outside("inventory_status", "In Stock", "Low Stock", "Out of Stock", "Overstocked")),
        (
            "inventory_status_mismatch",
            "coalesce(available = 0 AND inventory_status <> 'Out of Stock', false) "
            "OR coalesce(available > 0 AND available <= reorder AND inventory_status <> 'Low Stock', false) "
            "OR coalesce(available > reorder AND inventory_status = 'Out of Stock', false)",
        ),
        ("invalid_last_updated", "updated IS NULL"),
        ("future_last_updated", f"updated > {NOW}"),
    ],
}

RULES["orders_ranged"] = [
    (label, no_code("customer_id", "C", 9, 1000) if label == "invalid_customer_id" else cond) for label, cond in RULES["orders"]
]
RULES["inventory_by_day"] = [
    (
        label,
        {
            "invalid_warehouse_id": outside("trim(warehouse_id)", *[f"W{i:03d}" for i in range(1, 11)]),
            "invalid_inventory_status": outside("trim(inventory_status)", "In Stock", "Low Stock", "Out of Stock", "Overstocked"),
            "inventory_status_mismatch": cond.replace("inventory_status", "trim(inventory_status)"),
            "future_last_updated": f"CAST(updated AS DATE) > DATE '{AS_OF}'",
        }.get(label, cond),
    )
    for label, cond in RULES["inventory"]
]

KEYS = {
    "customers": "customer_id", "sellers": "seller_id", "products": "product_id", "orders": "order_id",
    "order_items": "order_item_id", "payments": "payment_id", "inventory": "inventory_id",
}


def _prepared(entity: str) -> list[str]:
    """CTEs up to ``<entity>_p``: the view with copy number, references and parsed columns."""
    key, order = KEYS[entity], ", ".join(ORDER_BY[entity])
    ctes = []
    join, extra = "", ""
    if entity == "payments":
        ctes += _labelled("orders")
        ctes.append(
            f"order_refs AS (SELECT order_id AS ref_id, {ts('order_date')} AS ref_date, {num('total_amount')} AS ref_total "
            "FROM orders_l WHERE _dq_issue IS NULL)"
        )
        join, extra = " LEFT JOIN order_refs ON v.order_id = ref_id", ", ref_id, ref_date, ref_total"
    elif entity == "inventory":
        ctes += _labelled("products")
        ctes.append("product_refs AS (SELECT product_id AS ref_id FROM products_l WHERE _dq_issue IS NULL)")
        join, extra = " LEFT JOIN product_refs ON v.product_id = ref_id", ", ref_id"
    elif entity == "products":
        ctes.append(f"pairs AS (SELECT * FROM {PAIRS})")
        join = " LEFT JOIN pairs ON v.category = pairs.category AND v.subcategory = pairs.subcategory"
        extra = ", pairs.category IS NOT NULL AS listed"
    parsed = "".join(f", {sql} AS {name}" for name, sql in PARSED[entity].items())
    ctes.append(f"{entity}_v AS ({sql_view(entity)})")
    ctes.append(
        f"{entity}_d AS (SELECT v.*{extra}, CASE WHEN v.{key} IS NOT NULL THEN row_number() OVER (PARTITION BY v.{key} ORDER BY {order}) END AS copy_no, "
        f"count(*) OVER (PARTITION BY v.{key}) AS copies FROM {entity}_v v{join})"
    )
    ctes.append(f"{entity}_p AS (SELECT *{parsed} FROM {entity}_d)")
    return ctes


def _labelled(entity: str, rules: str | None = None) -> list[str]:
    """CTEs up to ``<entity>_l``: every row with its first issue (or all of them)."""
    listed = RULES[rules or entity]
    if rules == "products_multi":
        parts = ", ".join(f"CASE WHEN {cond} THEN '{label}' END" for label, cond in listed)
        issue = f"nullif(concat_ws('|', {parts}), '')"
    else:
        issue = "CASE " + " ".join(f"WHEN {cond} THEN '{label}'" for label, cond in listed) + " END"
    return _prepared(entity) + [f"{entity}_l AS (SELECT *, {issue} AS _dq_issue FROM {entity}_p)"]


def _merge(*groups: list[str]) -> str:
    """One WITH clause; a CTE needed by several groups is written once."""
    seen = {}
    for group in groups:
        for cte in group:
            seen.setdefault(cte.split(" AS ", 1)[0], cte)
    return "WITH " + ",\n".join(seen.values()) + "\n"


def labels(entity: str, rules: str | None = None) -> str:
    columns = ", ".join([KEYS[entity], *ORDER_BY[entity], "_dq_issue"])
    return _merge(_labelled(entity, rules)) + f"SELECT {columns} FROM {entity}_l"


def layer(entity: str, columns, invalid: bool = False) -> str:
    listed = ", ".join([*columns, *ORDER_BY[entity]] + (["_dq_issue"] if invalid else []))
    where = "IS NOT NULL" if invalid else "IS NULL"
    return _merge(_labelled(entity)) + f"SELECT {listed} FROM {entity}_l WHERE _dq_issue {where}"


def orders_all_issues() -> str:
    parts = ", ".join(f"CASE WHEN {cond} THEN '{label}' END" for label, cond in RULES["orders"])
    count = " + ".join(f"CASE WHEN {cond} THEN 1 ELSE 0 END" for _, cond in RULES["orders"])
    return _merge(_prepared("orders")) + (
        f"SELECT ingest_seq, nullif(concat_ws('|', {parts}), '') AS _dq_issue, CAST({count} AS INTEGER) AS n_issues FROM orders_p"
    )


def orders_issue_array() -> str:
    branches = " UNION ALL ".join(
        f"SELECT ingest_seq, '{label}' AS issue FROM orders_p WHERE {cond}" for label, cond in RULES["orders"]
    )
    return _merge(_prepared("orders")) + branches


def rule_counts(entity: str) -> str:
    branches = " UNION ALL ".join(
        f"SELECT {i} AS rule_no, '{label}' AS label, count(*) FILTER (WHERE {cond}) AS violations FROM {entity}_p"
        for i, (label, cond) in enumerate(RULES[entity], start=1)
    )
    return _merge(_prepared(entity)) + branches


def distribution(entity: str) -> str:
    return _merge(_labelled(entity)) + (
        f"SELECT _dq_issue, count(*) AS count FROM {entity}_l WHERE _dq_issue IS NOT NULL GROUP BY _dq_issue"
    )


def totals(entity: str) -> str:
    return _merge(_labelled(entity)) + (
        "SELECT count(*) AS total_rows, count(*) FILTER (WHERE _dq_issue IS NULL) AS valid_rows, "
        f"count(*) FILTER (WHERE _dq_issue IS NOT NULL) AS invalid_rows FROM {entity}_l"
    )


def silver_check(entity: str) -> str:
    """Rules re-applied to silver and to the raw view: (layer, rule_no, label, violations)."""
    ctes = _labelled(entity)
    key, order = KEYS[entity], ", ".join(ORDER_BY[entity])
    parsed = ", ".join(f"{sql} AS {name}" for name, sql in PARSED[entity].items())
    names = ", ".join([*PARSED[entity], "copy_no", "copies", "_dq_issue"])
    ctes.append(
        f"again AS (SELECT *, {parsed}, CASE WHEN {key} IS NOT NULL THEN row_number() OVER (PARTITION BY {key} ORDER BY {order}) END AS copy_no "
        f"FROM (SELECT * EXCLUDE ({names}) FROM {entity}_l WHERE _dq_issue IS NULL))"
    )
    branches = [
        f"SELECT '{name}' AS layer, {i} AS rule_no, '{label}' AS label, count(*) FILTER (WHERE {cond}) AS violations FROM {source}"
        for name, source in (("raw", f"{entity}_p"), ("silver", "again"))
        for i, (label, cond) in enumerate(RULES[entity], start=1)
    ]
    return _merge(ctes) + " UNION ALL ".join(branches)


def _silver(*entities: str) -> str:
    groups = [_labelled(e) for e in entities]
    groups.append([f"{e}_s AS (SELECT * FROM {e}_l WHERE _dq_issue IS NULL)" for e in entities])
    return _merge(*groups)


DONE = "('Confirmed', 'Shipped', 'Delivered')"


def customer_360() -> str:
    return _silver("customers", "orders", "order_items", "payments") + f""",
o AS (SELECT order_id, customer_id, order_status, {ts('order_date')} AS odt FROM orders_s),
counts AS (SELECT customer_id, count(DISTINCT order_id) AS n,
    count(DISTINCT order_id) FILTER (WHERE order_status IN {DONE}) AS n_done,
    count(DISTINCT order_id) FILTER (WHERE order_status = 'Cancelled') AS n_cancelled,
    count(DISTINCT order_id) FILTER (WHERE order_status = 'Returned') AS n_returned,
    min(odt) FILTER (WHERE order_status IN {DONE}) AS first_dt, max(odt) FILTER (WHERE order_status IN {DONE}) AS last_dt
    FROM o GROUP BY customer_id),
spend AS (SELECT customer_id, sum({num('quantity')}) AS items, sum({num('item_total')}) AS spend
    FROM order_items_s JOIN o USING (order_id) WHERE o.order_status IN {DONE} GROUP BY customer_id),
paid AS (SELECT customer_id, sum({num('amount')}) AS paid FROM payments_s JOIN o USING (order_id)
    WHERE payment_status = 'Success' GROUP BY customer_id)
SELECT c.customer_id, first_name, last_name, city, state, country, loyalty_tier, customer_status,
    strftime({ts('registration_date')}, '%Y-%m-%d %H:%M:%S') AS registration_date,
    coalesce(n, 0) AS total_orders, coalesce(n_done, 0) AS completed_orders, coalesce(n_cancelled, 0) AS cancelled_orders,
    coalesce(n_returned, 0) AS returned_orders, CAST(coalesce(items, 0) AS BIGINT) AS total_items_purchased,
    CAST(round(coalesce(spend, 0), 2) AS DOUBLE) AS total_spend,
    strftime(first_dt, '%Y-%m-%d %H:%M:%S') AS first_order_date, strftime(last_dt, '%Y-%m-%d %H:%M:%S') AS last_order_date,
    CAST(round(coalesce(paid, 0), 2) AS DOUBLE) AS successful_payment_amount,
    CASE WHEN coalesce(n_done, 0) > 0 THEN {ratio('coalesce(spend, 0)', 'n_done')} ELSE 0.0 END AS average_order_value,
    datesub('day', first_dt, last_dt) AS customer_lifetime_days
FROM customers_s c LEFT JOIN counts USING (customer_id) LEFT JOIN spend USING (customer_id) LEFT JOIN paid USING (customer_id)"""


_SALES = f"""sales AS (SELECT i.order_id, i.order_item_id, i.product_id, o.customer_id, o.order_status,
    CAST({ts('o.order_date')} AS DATE) AS sales_date, {num('i.quantity')} AS q, {num('i.unit_price')} AS price,
    {num('i.discount_amount')} AS disc, {num('i.tax_amount')} AS tx, {num('i.item_total')} AS total
    FROM order_items_s i JOIN orders_s o ON i.order_id = o.order_id WHERE o.order_status IN {DONE})"""


def daily_sales() -> str:
    return _silver("orders", "order_items", "payments") + f""",
{_SALES},
d AS (SELECT sales_date, count(DISTINCT order_id) AS total_orders, count(DISTINCT order_item_id) AS total_order_items,
    CAST(sum(q) AS BIGINT) AS total_quantity, sum({product('q', 'price')}) AS gross, sum(disc) AS disc, sum(tx) AS tx, sum(total) AS net,
    count(DISTINCT customer_id) AS unique_customers, count(DISTINCT product_id) AS unique_products
    FROM sales WHERE sales_date IS NOT NULL GROUP BY sales_date),
p AS (SELECT CAST({ts('payment_date')} AS DATE) AS pday, sum({num('amount')}) AS paid FROM payments_s
    WHERE payment_status = 'Success' GROUP BY 1)
SELECT strftime(sales_date, '%Y-%m-%d') AS sales_date, total_orders, total_order_items, total_quantity,
    CAST(round(gross, 2) AS DOUBLE) AS gross_sales, CAST(round(disc, 2) AS DOUBLE) AS discount_amount,
    CAST(round(tx, 2) AS DOUBLE) AS tax_amount, CAST(round(net, 2) AS DOUBLE) AS net_sales,
    unique_customers, unique_products, CAST(round(coalesce(paid, 0), 2) AS DOUBLE) AS successful_payment_amount,
    {ratio('net', 'total_orders')} AS average_order_value
FROM d LEFT JOIN p ON sales_date = pday"""


def sales_with_product() -> str:
    return _silver("orders", "order_items", "products") + f""",
{_SALES}
SELECT p.category, p.subcategory, p.brand, count(*) AS lines, CAST(sum(q) AS BIGINT) AS quantity, CAST(round(sum(total), 2) AS DOUBLE) AS net_sales
FROM sales LEFT JOIN products_s p USING (product_id) GROUP BY p.category, p.subcategory, p.brand"""


def order_filter_counts() -> str:
    return _silver("orders") + (
        f"SELECT count(*) FILTER (WHERE order_status IN {DONE}) AS included, "
        f"count(*) FILTER (WHERE order_status NOT IN {DONE}) AS excluded FROM orders_s"
    )


def status_counts() -> str:
    return _silver("orders") + (
        f"SELECT order_status, count(*) AS count FROM orders_s WHERE order_status IN {DONE} GROUP BY order_status"
    )


def _mart_checks(key: str, required, amounts) -> str:
    branches = [f"SELECT 'repeated_{key}' AS \"check\", count(*) AS violations FROM (SELECT {key} FROM m GROUP BY 1 HAVING count(*) > 1)"]
    branches += [f"SELECT 'null_{c}' AS \"check\", count(*) AS violations FROM m WHERE {c} IS NULL" for c in required]
    branches += [f"SELECT 'negative_{c}' AS \"check\", count(*) AS violations FROM m WHERE {c} < 0" for c in amounts]
    return " UNION ALL ".join(branches)


def mart_check() -> str:
    amounts = ("gross_sales", "discount_amount", "tax_amount", "net_sales", "successful_payment_amount")
    return f"WITH m AS ({daily_sales()}) " + _mart_checks("sales_date", ["sales_date"], amounts)


C360_COLUMNS = (
    "customer_id", "first_name", "last_name", "city", "state", "country", "loyalty_tier", "customer_status",
    "registration_date", "total_orders", "completed_orders", "cancelled_orders", "returned_orders", "total_items_purchased",
    "total_spend", "first_order_date", "last_order_date", "successful_payment_amount", "average_order_value",
    "customer_lifetime_days",
)


def mart_check_customers() -> str:
    amounts = ("total_spend", "successful_payment_amount", "average_order_value", "total_orders")
    return f"WITH m AS ({customer_360()}) " + _mart_checks("customer_id", C360_COLUMNS, amounts)


def mart_conservation() -> str:
    """What silver holds for silver customers, ids compared without outer spaces; the mart must hold as much."""
    return _silver("customers", "orders", "order_items", "payments") + f""",
known AS (SELECT trim(order_id) AS oid, trim(customer_id) AS cid, order_status FROM orders_s
    WHERE trim(customer_id) IN (SELECT trim(customer_id) FROM customers_s)),
spend AS (SELECT CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total FROM (SELECT round(sum({num('item_total')}), 2) AS amount
    FROM order_items_s JOIN known ON trim(order_id) = oid WHERE order_status IN {DONE} GROUP BY cid)),
paid AS (SELECT CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total FROM (SELECT round(sum({num('amount')}), 2) AS amount
    FROM payments_s JOIN known ON trim(order_id) = oid WHERE payment_status = 'Success' GROUP BY cid))
SELECT 'spend' AS measure, total AS silver_total, total AS mart_total FROM spend
UNION ALL SELECT 'paid', total, total FROM paid"""


def resend_validate() -> str:
    view = f"({sql_view('orders')})"
    return (
        "SELECT order_id, count(*) AS n_rows, CASE WHEN order_id IS NULL THEN 0 ELSE count(*) - 1 END AS n_duplicates "
        f"FROM (SELECT order_id FROM {view} UNION ALL SELECT order_id FROM {view} WHERE ingest_seq % 17 = 0) GROUP BY order_id"
    )


def null_profile(columns) -> str:
    return _merge(_prepared("order_items")) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM order_items_v" for c in columns
    )


def payment_recheck() -> str:
    """Silver payments against raw orders: stated amount differs or no order total."""
    ctes = _labelled("payments") + ["raw_orders AS (SELECT order_id AS rid, min(" + num("total_amount") + ") AS rtotal FROM orders_v WHERE NOT " + blank("order_id") + " GROUP BY 1)"]
    return _merge(ctes) + (
        f"SELECT payment_id, amount, CAST(rtotal AS DOUBLE) AS order_total FROM payments_l LEFT JOIN raw_orders ON order_id = rid "
        f"WHERE rtotal IS NULL OR round({num('amount')}, 2) <> round(rtotal, 2)"
    )


_REGIONS = """(VALUES ('Maharashtra', 'West'), ('Gujarat', 'West'), ('Rajasthan', 'North'), ('Delhi', 'North'), ('Punjab', 'North'),
 ('Karnataka', 'South'), ('Tamil Nadu', 'South'), ('Kerala', 'South'), ('Telangana', 'South'), ('West Bengal', 'East'),
 ('Odisha', 'East'), ('Bihar', 'East'), ('Madhya Pradesh', 'Central'), ('Uttar Pradesh', 'Central')) AS regions(name, region)"""

_SUBCATEGORIES = """(VALUES ('Mobiles', 'Electronics'), ('Laptops', 'Electronics'), ('Accessories', 'Electronics'), ('Audio', 'Electronics'),
 ('Men', 'Fashion'), ('Women', 'Fashion'), ('Kids', 'Fashion'), ('Footwear', 'Fashion'), ('Furniture', 'Home'), ('Kitchen', 'Home'),
 ('Decor', 'Home'), ('Staples', 'Grocery'), ('Snacks', 'Grocery'), ('Beverages', 'Grocery'), ('Skincare', 'Beauty'),
 ('Haircare', 'Beauty'), ('Makeup', 'Beauty')) AS subs(sub, cat)"""

_RANKED = """SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_shipdate) AS n,
 count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem"""

_NAMED = """(SELECT o_orderkey, CASE WHEN o_orderkey % 29 = 0 THEN 'no' || CAST(o_custkey AS VARCHAR) WHEN o_orderkey % 31 = 0 THEN NULL
 ELSE CAST(o_custkey AS VARCHAR) END AS customer_id FROM orders)"""
_CUSTOMERS = "(SELECT CAST(c_custkey AS VARCHAR) AS cid, c_mktsegment, c_acctbal FROM customer)"


def _constraint_totals() -> str:
    return (
        "SELECT 'issue_column_in_silver' AS \"check\", CAST(0 AS BIGINT) AS violations "
        "UNION ALL SELECT 'issue_column_missing_in_quarantine', CAST(0 AS BIGINT) "
        "UNION ALL SELECT 'quarantine_rows_without_issue', count(*) FILTER (WHERE _dq_issue IS NULL) "
        "FROM (SELECT * FROM orders_l WHERE _dq_issue IS NOT NULL)"
    )


def build() -> dict[str, str]:
    from ..entities import schemas

    flag = f"SELECT o_orderkey, customer_id, cid IS NOT NULL AS ref_exists FROM {_NAMED} LEFT JOIN {_CUSTOMERS} ON customer_id = cid"
    view = lambda e: f"({sql_view(e)})"
    return {
        "orders_first_issue": labels("orders"),
        "orders_all_issues": orders_all_issues(),
        "orders_issue_array": orders_issue_array(),
        "orders_silver": layer("orders", schemas.ORDERS),
        "orders_quarantine": layer("orders", schemas.ORDERS, invalid=True),
        "order_items_silver": layer("order_items", schemas.ORDER_ITEMS),
        "payments_quarantine": layer("payments", schemas.PAYMENTS, invalid=True),
        "dq_rule_counts": rule_counts("orders"),
        **{f"dq_rule_counts_{e}": rule_counts(e) for e in ("customers", "sellers", "products", "order_items", "payments", "inventory")},
        "dq_distribution": distribution("orders"),
        "dq_summary": totals("orders"),
        "customers_validate": labels("customers"),
        "sellers_validate": labels("sellers"),
        "products_validate_strict": labels("products"),
        "products_validate_multi": labels("products", "products_multi"),
        "order_items_validate": labels("order_items"),
        "payments_validate": labels("payments"),
        "inventory_validate": labels("inventory"),
        "null_profile": null_profile(schemas.ORDER_ITEMS),
        "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1",
        "duplicate_key_summary": "SELECT count(*) AS repeated_keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows FROM "
        "(SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)",
        "negative_counts": "SELECT 'c_acctbal' AS column_name, count(*) FILTER (WHERE c_acctbal < 0) AS negative_count FROM customer "
        "UNION ALL SELECT 'c_custkey', count(*) FILTER (WHERE c_custkey < 0) FROM customer",
        "constraint_report": silver_check("orders"),
        **{
            f"silver_recheck_{e}": silver_check(e)
            for e in ("customers", "sellers", "products", "order_items", "payments", "inventory")
        },
        "orders_is_valid": _merge(_labelled("orders")) + "SELECT ingest_seq, _dq_issue IS NULL AS is_valid FROM orders_l",
        "orders_validate_ranged": labels("orders", "orders_ranged"),
        "inventory_validate_by_day": labels("inventory", "inventory_by_day"),
        "customers_flag_all": f"SELECT ingest_seq, customer_id, count(*) OVER (PARTITION BY customer_id) > 1 AS is_repeated FROM {view('customers')}",
        "resend_validate": resend_validate(),
        "layer_check": _merge(_labelled("orders")) + _constraint_totals(),
        "mart_check": mart_check(),
        "mart_check_customers": mart_check_customers(),
        "mart_conservation": mart_conservation(),
        "dedup_keep_first": "SELECT * EXCLUDE (n, copies) REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate) "
        f"FROM ({_RANKED}) WHERE n = 1",
        "dedup_flag_later": f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate, n > 1 AS is_later_copy FROM ({_RANKED})",
        "dedup_flag_all": f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate, copies > 1 AS is_repeated FROM ({_RANKED})",
        "dedup_exact": "SELECT DISTINCT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate) FROM "
        "(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 17 = 0)",
        "ref_exists_flag": flag,
        "ref_exists_broadcast": flag,
        "ref_attributes": "SELECT o_orderkey, customer_id, c_mktsegment AS segment, c_acctbal AS balance, cid IS NOT NULL AS customer_found "
        f"FROM {_NAMED} LEFT JOIN {_CUSTOMERS} ON customer_id = cid",
        "orphan_report": f"SELECT o_orderkey, customer_id FROM {_NAMED} WHERE NOT EXISTS (SELECT 1 FROM {_CUSTOMERS} WHERE cid = customer_id)",
        "payment_orphans": _silver("orders") + f"SELECT ingest_seq, order_id FROM {view('payments')} v WHERE NOT EXISTS "
        "(SELECT 1 FROM orders_s s WHERE s.order_id = v.order_id)",
        "dependent_vocabulary": "SELECT * FROM (SELECT p_partkey, p_type, CASE WHEN p_partkey % 19 = 0 THEN 'Brand#00' ELSE p_brand END AS p_brand "
        "FROM part) a WHERE NOT EXISTS (SELECT 1 FROM part b WHERE b.p_type = a.p_type AND b.p_brand = a.p_brand)",
        "taxonomy_check": "SELECT ingest_seq, v.category, v.subcategory, pairs.category IS NULL AS outside "
        f"FROM {view('products')} v LEFT JOIN {PAIRS} ON v.category = pairs.category AND v.subcategory = pairs.subcategory",
        "ship_before_order": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate, "
        "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate",
        "order_total_reconciliation": "SELECT l_orderkey AS o_orderkey, CAST(total + CASE WHEN l_orderkey % 37 = 0 THEN 0.01 ELSE 0 END AS DOUBLE) AS stated_total, "
        "CASE WHEN l_orderkey % 41 <> 0 THEN CAST(total AS DOUBLE) END AS line_total FROM "
        "(SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total FROM lineitem GROUP BY 1) WHERE l_orderkey % 37 = 0 OR l_orderkey % 41 = 0",
        "payment_recheck": payment_recheck(),
        "line_total_check": f"SELECT ingest_seq, ingest_sub, ingest_day, quantity, unit_price, item_total, CAST(round({product(num('quantity'), num('unit_price'))}, 2) AS DOUBLE) AS computed_total "
        f"FROM {view('order_items')} WHERE round({num('item_total')}, 2) <> round({product(num('quantity'), num('unit_price'))}, 2) "
        f"OR ({num('item_total')} IS NOT NULL AND {huge(num('quantity'), num('unit_price'))})",
        "code_check": f"SELECT ingest_seq, ingest_sub, ingest_day, {no_code('order_id', 'O', 9)} AS bad_order, {no_code('product_id', 'P', 9)} AS bad_product FROM {view('order_items')}",
        "pattern_check": f"SELECT ingest_seq, {unlike('email', EMAIL)} AS bad_email, {unlike('phone', MOBILE)} AS bad_phone, "
        f"{unlike('postal_code', POSTAL)} AS bad_postal_code FROM {view('customers')}",
        "conditional_requirement": f"SELECT ingest_seq, coalesce(payment_status IN ('Success', 'Refunded'), false) AND {blank('transaction_reference')} AS missing_reference, "
        f"NOT {blank('transaction_reference')} AND NOT regexp_full_match(trim(coalesce(transaction_reference, '')), 'TXN[0-9]+') AS bad_reference FROM {view('payments')}",
        "status_consistency": f"SELECT ingest_seq, ({RULES['inventory'][12][1]}) AS status_conflict FROM "
        f"(SELECT *, {num('available_quantity')} AS available, {num('reorder_level')} AS reorder FROM {view('inventory')})",
        "daily_sales": daily_sales(),
        "customer_360": customer_360(),
        "sales_with_product": sales_with_product(),
        "order_filter_counts": order_filter_counts(),
        "status_counts": status_counts(),
        "late_arrivals": "SELECT event_id, strftime(CAST(ts AS DATE) + 2, '%Y-%m-%d') AS landing_date, 2 AS days_late FROM events WHERE event_id % 50 = 0",
        "quantity_triage": f"SELECT CASE WHEN quantity IS NULL THEN 'missing' WHEN n < 0 THEN 'return' WHEN n > 0 THEN 'sale' WHEN n = 0 THEN 'zero' ELSE 'malformed' END AS quantity_class, "
        f"count(*) AS count FROM (SELECT quantity, {num('quantity')} AS n FROM {view('order_items')}) GROUP BY 1",
        "price_normalize": "SELECT ingest_seq, unit_price, CAST(TRY_CAST(CASE WHEN unit_price LIKE 'Rs.%' THEN substr(unit_price, 4) "
        f"WHEN unit_price LIKE '₹%' THEN substr(unit_price, 2) ELSE unit_price END AS DECIMAL(30,10)) AS DOUBLE) AS unit_price_number FROM {view('products')}",
        "region_lookup": f"SELECT state, region, count(*) AS count FROM {view('customers')} v LEFT JOIN {_REGIONS} ON trim(v.state) = name GROUP BY ALL",
        "category_backfill": f"SELECT ingest_seq, CASE WHEN {blank('category')} THEN cat ELSE category END AS category, subcategory "
        f"FROM {view('products')} v LEFT JOIN {_SUBCATEGORIES} ON trim(v.subcategory) = sub",
        "contact_gaps": f"SELECT * FROM (SELECT ingest_seq, {blank('email')} AS missing_email, {unlike('phone', MOBILE)} AS missing_phone FROM {view('customers')}) "
        "WHERE missing_email OR missing_phone",
        "schema_drift_read": "SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN nullif(o_orderpriority, '5-LOW') END AS discount_code FROM orders",
        "preview_top10": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    }

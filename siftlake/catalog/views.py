"""Entity views over the shared tables, one SQL text for Spark and for the SQL counterpart.

Each view reads one whole table, renders it as an entity with text columns and plants defects by key
arithmetic, so that every rule has rows that break it. Placeholders in braces name the tables.
"""

from ..sources.tables import read_table

DIGITS = 9
AS_OF = "2001-01-01"


def plant(base: str, key: str, modulus: int, *values: str) -> str:
    """``base``, replaced by the i-th value where key % modulus = i."""
    cases = " ".join(f"WHEN {key} % {modulus} = {i} THEN {value}" for i, value in enumerate(values))
    return f"CASE {cases} ELSE {base} END"


def pick(key: str, *values: str) -> str:
    """One of several texts, chosen by key."""
    quoted = ["'" + v.replace("'", "''") + "'" for v in values]
    cases = " ".join(f"WHEN {key} % {len(quoted)} = {i} THEN {v}" for i, v in enumerate(quoted))
    return f"CASE {cases} END"


def code(prefix: str, number: str, digits: int = DIGITS) -> str:
    return f"'{prefix}' || lpad(CAST({number} AS STRING), {digits}, '0')"


def money(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(18,2)) AS STRING)"


def day(start: str, offset: str) -> str:
    return f"CAST(DATE '{start}' + CAST({offset} AS INT) AS STRING)"


def _select(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{expr} AS {name}" for name, expr in columns.items()) + f" FROM {source}"


def _steps(source: str, *steps: dict[str, str]) -> str:
    """A table with computed columns added step by step, each computed once."""
    for i, step in enumerate(steps):
        added = ", ".join(f"{expr} AS {name}" for name, expr in step.items())
        source = f"(SELECT *, {added} FROM {source}) AS step{i}"
    return source


_STATES = ("Maharashtra", "Gujarat", "Delhi", "Karnataka", "Kerala", "Telangana", "West Bengal", "Bihar", "Punjab")

CUSTOMERS = _select(
    {
        "customer_id": plant(
            plant(code("C", "c_custkey"), "c_custkey", 101, "NULL", "'   '"),
            "c_custkey", 89, code("C", "c_custkey + 1"),
        ),
        "first_name": plant("c_name", "c_custkey", 103, "''"),
        "last_name": plant("c_mktsegment", "c_custkey", 107, "NULL", "'  '"),
        "gender": plant(pick("c_custkey", "Male", "Female", "Other"), "c_custkey", 109, "'male'", "' Male'", "NULL"),
        "date_of_birth": plant(
            day("1950-01-01", "c_custkey % 18000"), "c_custkey", 113, "'30/10/1980'", "'2030-01-01'", "'1980-02-30'", "NULL"
        ),
        "email": plant(
            "'user' || CAST(c_custkey AS STRING) || '@example.com'", "c_custkey", 127,
            "'a@b'", "'a b@c.d'", "NULL", "''", "'a@@b.c'", "' user@mail.in '",
        ),
        "phone": plant(
            "'9' || lpad(CAST(c_custkey AS STRING), 9, '0')", "c_custkey", 131,
            "'5999999999'", "'N/A'", "'987654321'", "'98765432101'", "NULL",
        ),
        "city": plant("'City ' || CAST(c_nationkey AS STRING)", "c_custkey", 137, "''", "NULL"),
        "state": plant(pick("c_nationkey", *_STATES), "c_custkey", 139, "chr(9)", "NULL"),
        "country": plant("'India'", "c_custkey", 149, "'US'", "NULL", "'india'", "' India '"),
        "postal_code": plant(
            "CAST(100000 + c_custkey % 900000 AS STRING)", "c_custkey", 151, "'12345'", "'12345a'", "'123456' || chr(10)", "NULL"
        ),
        "registration_date": plant(
            day("1995-01-01", "c_custkey % 2000"), "c_custkey", 157, "'1999-08'", "'2001-05-05'", "NULL", "'2000-01-01 10:30:00'"
        ),
        "loyalty_tier": plant(pick("c_custkey", "Bronze", "Silver", "Gold"), "c_custkey", 163, "'Platinum'", "NULL"),
        "customer_status": plant(pick("c_nationkey", "Active", "Inactive"), "c_custkey", 167, "'active'", "NULL"),
        "ingest_seq": "c_custkey",
    },
    "{customer}",
)

SELLERS = _select(
    {
        "seller_id": plant(code("S", "s_suppkey"), "s_suppkey", 50, "NULL", "''", code("S", "s_suppkey + 1")),
        "seller_name": plant("s_name", "(s_suppkey + 20)", 50, "' '"),
        "email": plant("'shop' || CAST(s_suppkey AS STRING) || '@example.com'", "(s_suppkey + 46)", 50, "'shop'", "NULL"),
        "phone": plant("'8' || lpad(CAST(s_suppkey AS STRING), 9, '0')", "(s_suppkey + 44)", 50, "'12345'", "NULL"),
        "city": plant("'City ' || CAST(s_nationkey AS STRING)", "(s_suppkey + 42)", 50, "NULL"),
        "state": plant(pick("s_nationkey", *_STATES), "(s_suppkey + 41)", 50, "''"),
        "country": plant("'India'", "(s_suppkey + 40)", 50, "'Nepal'", "NULL"),
        "seller_rating": plant(
            "CAST(1 + s_suppkey % 5 AS DOUBLE)", "(s_suppkey + 38)", 50,
            "CAST(0.99 AS DOUBLE)", "CAST(5.01 AS DOUBLE)", "NULL",
        ),
        "seller_status": plant(pick("s_suppkey", "Active", "Inactive"), "(s_suppkey + 35)", 50, "'Closed'", "NULL"),
        "joined_date": plant(day("1996-01-01", "s_suppkey % 1500"), "(s_suppkey + 33)", 50, "'01-02-1999'", "'2001-02-01'", "NULL"),
        "ingest_seq": "s_suppkey",
    },
    "{supplier}",
)

_CATEGORIES = (
    ("Electronics", "Mobiles", "Accessories"),
    ("Fashion", "Men's Clothing", "Accessories"),
    ("Home & Kitchen", "Cookware", "Storage"),
    ("Beauty & Personal Care", "Skincare", "Makeup"),
    ("Grocery", "Snacks", "Dairy"),
    ("Sports & Fitness", "Yoga", "Sportswear"),
    ("Books", "Fiction", "Comics"),
    ("Toys", "Puzzles", "Board Games"),
    ("Automotive", "Tools", "Car Care"),
    ("Health & Wellness", "Ayurveda", "Supplements"),
)

PRODUCTS = _select(
    {
        "product_id": plant(
            plant(code("P", "p_partkey"), "p_partkey", 101, "NULL", "''"), "p_partkey", 89, code("P", "p_partkey + 1")
        ),
        "seller_id": plant(
            "'S' || lpad(CAST(p_partkey % 1000 + 1 AS STRING), 5, '0')", "p_partkey", 103, "'S01001'", "'s00001'", "NULL", "'S00000'", "' S00007 '"
        ),
        "product_name": plant("p_name", "p_partkey", 107, "''", "NULL"),
        "category": plant(pick("p_partkey", *[c[0] for c in _CATEGORIES]), "p_partkey", 109, "'Gadgets'", "NULL", "''"),
        "subcategory": plant(
            pick("p_partkey", *([c[1] for c in _CATEGORIES] + [c[2] for c in _CATEGORIES])),
            "p_partkey", 113, "'Accessories'", "NULL", "' '",
        ),
        "brand": "p_brand",
        "unit_price": plant(money("p_retailprice"), "p_partkey", 127, "'0'", "'Rs.499.0'", "NULL", "'-5'", "'1e3'"),
        "cost_price": plant(
            "CAST(CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 0.7 AS DECIMAL(18,2)) AS STRING)", "p_partkey", 131,
            money("p_retailprice"), "'0'", "'-1'", "'99999'", "NULL", "'cheap'",
        ),
        "stock_quantity": plant("CAST(p_size AS STRING)", "p_partkey", 137, "'-1'", "'abc'", "NULL", "'0'"),
        "product_status": plant(pick("p_size", "Active", "Inactive", "Discontinued"), "p_partkey", 139, "'Deleted'", "NULL"),
        "created_date": plant(
            day("1995-01-01", "p_partkey % 2000"), "p_partkey", 149,
            "'30/10/1999'", "'2001-01-02'", "NULL", "'1999-01-01 08:00:00'", "'1999-13-01'",
        ),
        "ingest_seq": "p_partkey",
    },
    "{part}",
)

_TOTAL, _DISCOUNT, _TAX, _SUBTOTAL = "total", "discount", "tax", "subtotal"
_PRICED_ORDERS = _steps(
    "{orders}",
    {"total": "CAST(o_totalprice AS DECIMAL(18,2))"},
    {"discount": "CAST(total * 0.05 AS DECIMAL(18,2))", "tax": "CAST(total * 0.10 AS DECIMAL(18,2))"},
    {"subtotal": "CAST(total + discount - tax - 50.00 AS DECIMAL(18,2))"},
)

ORDERS = _select(
    {
        "order_id": plant(
            plant(code("O", "o_orderkey"), "o_orderkey", 211, "''", "NULL"), "o_orderkey", 97, code("O", "o_orderkey + 1")
        ),
        "customer_id": plant(
            code("C", "o_custkey"), "o_orderkey", 223, "NULL", "'C' || CAST(o_custkey AS STRING)", "'  '",
            "'c' || lpad(CAST(o_custkey AS STRING), 9, '0')", "' C000000001 '",
        ),
        "order_date": plant(
            "CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) ELSE CAST(o_orderdate AS STRING) END",
            "o_orderkey", 227, "'30/10/1999'", "'1999-02-30'", "'1999-08'", "NULL", "'1999-08-01T10:00:00'",
        ),
        "order_status": plant(
            plant(
                "CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Confirmed' ELSE 'Pending' END",
                "o_orderkey", 13, "'Cancelled'", "'Returned'", "'Shipped'",
            ),
            "o_orderkey", 229, "'delivered'", "' Shipped '", "NULL",
        ),
        "payment_method": plant(
            pick("o_orderkey", "UPI", "Credit Card", "Debit Card", "Net Banking", "Cash on Delivery", "Wallet"),
            "o_orderkey", 233, "'Cheque'", "NULL",
        ),
        "shipping_city": plant("'City ' || CAST(o_custkey % 50 AS STRING)", "o_orderkey", 239, "'  '", "NULL", "chr(9)"),
        "shipping_state": plant(pick("o_custkey", *_STATES), "o_orderkey", 241, "''", "chr(10)"),
        "shipping_postal_code": plant(
            "CAST(100000 + o_orderkey % 900000 AS STRING)", "o_orderkey", 251,
            "'12345'", "'12345a'", "'123456' || chr(10)", "NULL", "' 123456 '",
        ),
        "subtotal_amount": plant(f"CAST({_SUBTOTAL} AS STRING)", "o_orderkey", 257, "'0.00'", "'abc'", "'-4'"),
        "discount_amount": plant(
            plant(f"CAST({_DISCOUNT} AS STRING)", "o_orderkey", 269, f"CAST(CAST({_SUBTOTAL} + 0.01 AS DECIMAL(18,2)) AS STRING)"),
            "o_orderkey", 263, "'-1.00'", "NULL",
        ),
        "shipping_fee": plant("'50.00'", "o_orderkey", 271, "'-5'", "'free'"),
        "tax_amount": plant(f"CAST({_TAX} AS STRING)", "o_orderkey", 277, "'NaN'", "'-0.01'"),
        "total_amount": plant(
            f"CAST({_TOTAL} AS STRING)", "o_orderkey", 281,
            f"CAST(CAST({_TOTAL} + 0.01 AS DECIMAL(18,2)) AS STRING)",
            f"CAST(CAST({_TOTAL} + 0.004 AS DECIMAL(18,3)) AS STRING)",
            "'-1'", "NULL",
        ),
        "ingest_seq": "o_orderkey",
    },
    _PRICED_ORDERS,
)

_PRICE, _GROSS, _LINE_DISCOUNT, _LINE_TAX, _LINE_TOTAL = "price", "gross", "discount", "tax", "total"
_PRICED_LINES = _steps(
    "{lineitem}",
    {"price": "CAST(l_extendedprice AS DECIMAL(18,2))"},
    {"gross": "CAST(CAST(l_quantity AS INT) * price AS DECIMAL(18,2))"},
    {
        "discount": "CAST(gross * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2))",
        "tax": "CAST(gross * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2))",
    },
    {"total": "CAST(gross - discount + tax AS DECIMAL(18,2))"},
)

_HUGE = "'9999999999999999999'"

# Lines repeat (l_orderkey, l_linenumber); the three ingest columns together order them totally.
ORDER_ITEMS = _select(
    {
        "order_item_id": plant(
            "'I' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)", "(l_orderkey + l_partkey)", 401, "''", "NULL"
        ),
        "order_id": plant(
            code("O", "l_orderkey"), "(l_orderkey + l_suppkey)", 409, "NULL", "'O' || CAST(l_orderkey AS STRING)", "'  '", "'O000000000'"
        ),
        "product_id": plant(
            code("P", "l_partkey"), "(l_partkey + l_linenumber)", 419, "''", "'X' || CAST(l_partkey AS STRING)", "NULL"
        ),
        # Both numbers of a line are huge together: their product is beyond any decimal.
        "quantity": plant(
            plant(
                "CAST(CAST(l_quantity AS INT) AS STRING)", "(l_orderkey + l_linenumber)", 421,
                "'0'", "'1.5'", "'abc'", "NULL", "'-2'", "'1000000000000'", "'1.0000001'",
            ),
            "(l_orderkey + l_linenumber)", 457, _HUGE,
        ),
        "unit_price": plant(
            plant(f"CAST({_PRICE} AS STRING)", "(l_orderkey + l_linenumber)", 431, "'0'", "'NaN'", "'0.0000001'"),
            "(l_orderkey + l_linenumber)", 457, _HUGE,
        ),
        "discount_amount": plant(
            plant(f"CAST({_LINE_DISCOUNT} AS STRING)", "(l_orderkey + l_partkey)", 439, f"CAST(CAST({_GROSS} + 0.01 AS DECIMAL(18,2)) AS STRING)"),
            "(l_orderkey + l_linenumber)", 433, "'-1'", "NULL",
        ),
        "tax_amount": plant(f"CAST({_LINE_TAX} AS STRING)", "(l_orderkey + l_linenumber)", 443, "'-0.5'", "'none'"),
        "item_total": plant(
            f"CAST({_LINE_TOTAL} AS STRING)", "(l_orderkey + l_linenumber)", 449,
            f"CAST(CAST({_LINE_TOTAL} + 0.01 AS DECIMAL(18,2)) AS STRING)",
            f"CAST(CAST({_LINE_TOTAL} + 0.004 AS DECIMAL(18,3)) AS STRING)", "'-1'", "NULL",
        ),
        "ingest_seq": "l_orderkey * 10 + l_linenumber",
        "ingest_sub": "l_partkey * 10000000 + l_suppkey",
        "ingest_day": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
    },
    _PRICED_LINES,
)

PAYMENTS = _select(
    {
        "payment_id": plant(
            plant(code("T", "o_orderkey"), "o_orderkey", 307, "NULL", "' '"), "o_orderkey", 83, code("T", "o_orderkey + 1")
        ),
        "order_id": plant(code("O", "o_orderkey"), "o_orderkey", 311, "NULL", "''", "'O999999999'", "' ' || " + code("O", "o_orderkey") + " || ' '"),
        "payment_date": plant(
            plant(
                "CAST(o_orderdate + INTERVAL '1' DAY * (o_orderkey % 5) AS STRING)",
                "o_orderkey", 53, "CAST(o_orderdate - INTERVAL '1' DAY AS STRING)",
            ),
            "o_orderkey", 313, "'31/12/1999'", "NULL", "'2001-06-01'",
        ),
        "payment_method": plant(
            pick("o_orderkey", "UPI", "Credit Card", "Debit Card", "Net Banking", "Cash on Delivery", "Wallet"),
            "o_orderkey", 317, "'Barter'", "NULL",
        ),
        "payment_status": plant(
            pick("o_orderkey", "Success", "Success", "Success", "Pending", "Failed", "Refunded", "Cancelled"), "o_orderkey", 331, "'Done'", "NULL"
        ),
        "transaction_reference": plant(
            pick("o_orderkey", *["TXN"] * 7) + " || CAST(o_orderkey AS STRING)", "o_orderkey", 41,
            "'TXN'", "'txn1'", "'TXN1x'", "NULL", "'  '", "' TXN77 '",
        ),
        "amount": plant(
            money("o_totalprice"), "o_orderkey", 337, "'0'", "'free'",
            "CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 0.01 AS DECIMAL(18,2)) AS STRING)",
            "CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 0.004 AS DECIMAL(18,3)) AS STRING)",
        ),
        "currency": plant("'INR'", "o_orderkey", 347, "'USD'", "NULL"),
        "payment_gateway": plant(pick("o_orderkey", "Razorpay", "PayU", "Cashfree", "Stripe"), "o_orderkey", 349, "'Paytm'", "NULL"),
        "ingest_seq": "o_orderkey",
    },
    "{orders}",
)

_STOCK = "p_size * 4"
_RESERVED = "CAST(p_partkey % 5 AS INT)"
_AVAILABLE = f"({_STOCK} - {_RESERVED})"
_REORDER = "CAST(p_partkey % 40 AS INT)"

INVENTORY = _select(
    {
        "inventory_id": plant(
            plant(code("V", "p_partkey"), "p_partkey", 101, "''", "NULL"), "p_partkey", 79, code("V", "p_partkey + 1")
        ),
        "product_id": plant(code("P", "p_partkey"), "p_partkey", 103, "NULL", "' '", "'P999999999'"),
        "warehouse_id": plant(
            pick("p_partkey", "W001", "W002", "W003", "W004", "W005", "W006", "W007", "W008", "W009", "W010"),
            "p_partkey", 61, "'W011'", "' W001 '", "NULL",
        ),
        "stock_quantity": plant(f"CAST({_STOCK} AS STRING)", "p_partkey", 67, "'-1'", "'1.5'", "'many'", "NULL"),
        "reserved_quantity": plant(f"CAST({_RESERVED} AS STRING)", "p_partkey", 71, "'-1'", "'0.5'", "'99999'", "NULL"),
        "available_quantity": plant(f"CAST({_AVAILABLE} AS STRING)", "p_partkey", 73, "'-1'", "'2.5'", "'7777'", "NULL"),
        "reorder_level": plant(f"CAST({_REORDER} AS STRING)", "p_partkey", 59, "'-1'", "'x'", "NULL"),
        "inventory_status": plant(
            plant(
                f"CASE WHEN {_AVAILABLE} = 0 THEN 'Out of Stock' WHEN {_AVAILABLE} <= {_REORDER} THEN 'Low Stock' "
                f"WHEN {_AVAILABLE} > 150 THEN 'Overstocked' ELSE 'In Stock' END",
                "p_partkey", 47, "'Out of Stock'", "'In Stock'",
            ),
            "p_partkey", 57, "'Gone'", "' In Stock '", "NULL",
        ),
        "last_updated": plant(
            day("1996-01-01", "p_partkey % 1500"), "p_partkey", 43, "'yesterday'", "'2001-01-01 10:00:00'", "'2001-02-01'", "NULL"
        ),
        "ingest_seq": "p_partkey",
    },
    "{part}",
)

VIEWS = {
    "customers": CUSTOMERS,
    "sellers": SELLERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "payments": PAYMENTS,
    "inventory": INVENTORY,
}

SOURCE = {
    "customers": "customer",
    "sellers": "supplier",
    "products": "part",
    "orders": "orders",
    "order_items": "lineitem",
    "payments": "orders",
    "inventory": "part",
}

ORDER_BY = {entity: ["ingest_seq"] for entity in VIEWS} | {"order_items": ["ingest_seq", "ingest_sub", "ingest_day"]}


def spark_view(spark, sf_dir: str, entity: str):
    """The entity view as a DataFrame."""
    table = SOURCE[entity]
    return spark.sql(VIEWS[entity], **{table: read_table(spark, sf_dir, table)})


def sql_view(entity: str) -> str:
    """The entity view as SQL text over the named tables."""
    return VIEWS[entity].format(**{SOURCE[entity]: SOURCE[entity]})

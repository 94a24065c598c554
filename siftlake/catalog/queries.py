"""Registered queries. Each reads whole tables below ``sf_dir`` and returns plain column types."""

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType

from .. import entities
from ..entities import schemas, vocabulary as v
from ..functions import parsing, predicates as p
from ..operators import dedup, landing, refs, report, skew, validate as dq
from ..plans import marts
from ..session import tune
from ..sources.lake import materialize
from ..sources.landing import union_drifting
from ..sources.tables import read_table as table
from . import oracles
from .views import AS_OF, DIGITS, ORDER_BY, spark_view

# Upper end of the customer ids that the ranged variant accepts.
MAX_CUSTOMER = 1000

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate"]


def line_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as text, so results compare across engines."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, TimestampNTZType):
            c = c.cast("string")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def ruleset(name: str) -> dq.RuleSet:
    build = {
        "customers": lambda: entities.customers(AS_OF),
        "sellers": lambda: entities.sellers(AS_OF),
        "products": lambda: entities.products_strict(AS_OF),
        "products_multi": lambda: entities.products_multi(AS_OF),
        "orders": lambda: entities.orders(AS_OF, DIGITS, None),
        "orders_ranged": lambda: entities.orders(AS_OF, DIGITS, MAX_CUSTOMER),
        "inventory_by_day": lambda: entities.inventory(AS_OF, grain="date", trim=True),
        "order_items": lambda: entities.order_items(DIGITS, None, None),
        "payments": lambda: entities.payments(AS_OF),
        "inventory": lambda: entities.inventory(AS_OF),
    }
    return build[name]()


REFERENCES = {"payments": ("orders",), "inventory": ("products",)}


# Columns of silver that the customer mart and the lookups of payments read.
MART_COLUMNS = {
    "orders": ("order_id", "customer_id", "order_date", "order_status", "total_amount"),
    "order_items": ("order_id", "quantity", "item_total"),
    "payments": ("order_id", "payment_status", "amount"),
}


class Silver:
    """Silver frames for one query, each built once; those named in ``shared`` are materialized, of those in ``columns``
    only the named columns."""

    def __init__(self, spark: SparkSession, sf_dir: str, shared: tuple[str, ...] = (), columns: dict[str, tuple[str, ...]] | None = None):
        self.spark, self.sf_dir, self.shared, self.columns, self.built = spark, sf_dir, shared, columns or {}, {}

    def references(self, entity: str) -> dict[str, DataFrame]:
        return {name: self[name] for name in REFERENCES.get(entity, ())}

    def __getitem__(self, entity: str) -> DataFrame:
        if entity not in self.built:
            rows = dq.silver(labelled(self.spark, self.sf_dir, entity, silver=self), self.columns.get(entity))
            self.built[entity] = materialize(rows, f"silver-{entity}") if entity in self.shared else rows
        return self.built[entity]


def labelled(spark, sf_dir, entity, rules: str | None = None, silver: Silver | None = None) -> DataFrame:
    refs_ = (silver or Silver(spark, sf_dir)).references(entity)
    return dq.validate(spark_view(spark, sf_dir, entity), ruleset(rules or entity), refs_, ORDER_BY[entity])


def prepared(spark, sf_dir, entity) -> tuple[DataFrame, dq.RuleSet]:
    rules, refs_ = ruleset(entity), Silver(spark, sf_dir).references(entity)
    return dq.prepare(spark_view(spark, sf_dir, entity), rules, refs_, ORDER_BY[entity]), dq.checked(rules)


def q_labels(spark, sf_dir, entity, rules=None):
    rows = labelled(spark, sf_dir, entity, rules)
    return rows.select(oracles.KEYS[entity], *ORDER_BY[entity], dq.ISSUE)


def q_silver(spark, sf_dir, entity):
    columns = [*schemas.COLUMNS[entity], *ORDER_BY[entity]]
    return dq.silver(labelled(spark, sf_dir, entity), columns)


def q_quarantine(spark, sf_dir, entity):
    columns = [*schemas.COLUMNS[entity], *ORDER_BY[entity]]
    return dq.quarantine(labelled(spark, sf_dir, entity), columns)


def q_orders_all_issues(spark, sf_dir):
    rows, rules = prepared(spark, sf_dir, "orders")
    n_issues = F.size(dq.issue_array(rules.rules)).alias("n_issues")
    return rows.select("ingest_seq", dq.all_issues(rules.rules).alias(dq.ISSUE), n_issues)


def q_orders_issue_array(spark, sf_dir):
    rows, rules = prepared(spark, sf_dir, "orders")
    return rows.select("ingest_seq", F.explode(dq.issue_array(rules.rules)).alias("issue"))


def q_rule_counts(spark, sf_dir, entity):
    return report.rule_counts(*prepared(spark, sf_dir, entity))


def q_distribution(spark, sf_dir, entity):
    return report.issue_distribution(labelled(spark, sf_dir, entity))


def q_summary(spark, sf_dir, entity):
    return report.totals(labelled(spark, sf_dir, entity))


def q_null_profile(spark, sf_dir):
    return report.null_profile(spark_view(spark, sf_dir, "order_items"), schemas.ORDER_ITEMS)


def q_repeated_keys(spark, sf_dir):
    return report.repeated_keys(line_table(spark, sf_dir), LINE_KEY)


def q_repeated_key_summary(spark, sf_dir):
    return report.repeated_key_summary(line_table(spark, sf_dir), LINE_KEY)


def q_negative_counts(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return report.negative_profile(customer, ["c_acctbal", "c_custkey"])


def q_silver_check(spark, sf_dir, entity):
    """Rules of an entity counted on the raw view and again on its silver rows."""
    view, rules = spark_view(spark, sf_dir, entity), ruleset(entity)
    refs_ = Silver(spark, sf_dir, shared=REFERENCES.get(entity, ())).references(entity)
    rows = dq.prepare(view, rules, refs_, ORDER_BY[entity])
    raw = report.rule_counts(rows, dq.checked(rules))
    # Stored: copies and hot ids of silver are counted before its rules are, and all three read it.
    silver = materialize(dq.silver(dq.label(rows, rules, view.columns)), f"silver-{entity}")
    clean = report.check_rules(silver, rules, refs_, ORDER_BY[entity])
    return raw.select(F.lit("raw").alias("layer"), "*").unionByName(clean.select(F.lit("silver").alias("layer"), "*"))


def q_is_valid(spark, sf_dir):
    rows, rules = prepared(spark, sf_dir, "orders")
    return rows.select("ingest_seq", dq.is_valid(rules.rules).alias("is_valid"))


def q_flag_all_customers(spark, sf_dir):
    """Every copy of a repeated customer id; NULL ids are equal to each other."""
    rows = dedup.flag_all_copies(spark_view(spark, sf_dir, "customers"), "customer_id", "is_repeated", "equal")
    return rows.select("ingest_seq", "customer_id", "is_repeated")


def q_resend_validate(spark, sf_dir):
    """Orders without an arrival number, every 17th row sent twice: rows and duplicates of each id."""
    view = spark_view(spark, sf_dir, "orders")
    sent = view.union(view.where("ingest_seq % 17 = 0")).select(*schemas.ORDERS)
    found = dq.validate(sent, ruleset("orders"))
    duplicate = F.count_if(F.col(dq.ISSUE) == "duplicate_order_record")
    return found.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(duplicate, F.lit(0)).alias("n_duplicates"))


def q_layer_check(spark, sf_dir):
    rows = labelled(spark, sf_dir, "orders")
    return report.check_layers(dq.silver(rows), dq.quarantine(rows))


def q_mart_check(spark, sf_dir):
    amounts = ["gross_sales", "discount_amount", "tax_amount", "net_sales", "successful_payment_amount"]
    return report.check_mart(daily(spark, sf_dir, ordered=False), "sales_date", amounts)


def customers_mart(spark, sf_dir, silver: Silver | None = None, ordered: bool = True) -> DataFrame:
    silver = silver or Silver(spark, sf_dir, shared=("orders",), columns=MART_COLUMNS)
    t = [silver[e] for e in ("customers", "orders", "order_items", "payments")]
    return marts.customer_360(*t, ordered=ordered)


def q_mart_check_customers(spark, sf_dir):
    mart = customers_mart(spark, sf_dir, ordered=False)
    amounts = ["total_spend", "successful_payment_amount", "average_order_value", "total_orders"]
    return report.check_mart(mart, "customer_id", amounts, mart.columns)


def q_mart_conservation(spark, sf_dir):
    """Silver amounts that belong to a silver customer, outer spaces of ids aside, and the customer mart's totals."""
    c = F.col
    silver = Silver(spark, sf_dir, shared=("customers", "orders", "order_items", "payments"), columns=MART_COLUMNS)
    known = silver["customers"].select(F.trim("customer_id").alias("_customer"))
    orders = silver["orders"].select(F.trim("order_id").alias("_order"), F.trim("customer_id").alias("_customer"), "order_status")
    orders = orders.join(known, "_customer", "left_semi")
    done = orders.where(c("order_status").isin(*v.COMPLETED_STATUSES))
    paid = silver["payments"].where("payment_status = 'Success'")
    mart = customers_mart(spark, sf_dir, silver, ordered=False)

    def kept(measure, rows, owners, stated):
        """Amounts per customer, rounded like the mart's."""
        rows = rows.select(F.trim("order_id").alias("_order"), parsing.number(c(stated)).alias("_stated"))
        sums = rows.join(owners, "_order").groupBy("_customer").agg(parsing.money(F.sum("_stated")).alias("amount"))
        return sums.select(F.lit(measure).alias("measure"), F.lit("silver").alias("side"), "amount")

    def shown(measure, column):
        return mart.select(F.lit(measure).alias("measure"), F.lit("mart").alias("side"), c(column).alias("amount"))

    sides = kept("spend", silver["order_items"], done, "item_total").union(shown("spend", "total_spend"))
    sides = sides.union(kept("paid", paid, orders, "amount")).union(shown("paid", "successful_payment_amount"))
    totals = [
        parsing.money(F.coalesce(F.sum(F.when(c("side") == name, c("amount"))), F.lit(0))).alias(f"{name}_total")
        for name in ("silver", "mart")
    ]
    return plain(sides.groupBy("measure").agg(*totals))


def q_dedup_keep_first(spark, sf_dir):
    return plain(dedup.keep_first(line_table(spark, sf_dir), LINE_KEY, LINE_ORDER))


def q_dedup_flag_later(spark, sf_dir):
    rows = dedup.flag_later_copies(line_table(spark, sf_dir), LINE_KEY, LINE_ORDER, "is_later_copy")
    return plain(rows.select(*LINE_KEY, *LINE_ORDER, "is_later_copy"))


def q_dedup_flag_all(spark, sf_dir):
    rows = dedup.flag_all_copies(line_table(spark, sf_dir), LINE_KEY, "is_repeated", spread_by=LINE_ORDER)
    return plain(rows.select(*LINE_KEY, *LINE_ORDER, "is_repeated"))


def q_dedup_exact(spark, sf_dir):
    """Whole line items, those of every 17th order sent twice."""
    lines = line_table(spark, sf_dir)
    return plain(dedup.drop_exact_copies(lines.union(lines.where("l_orderkey % 17 = 0"))))


def _with_text_ids(spark, sf_dir):
    """All orders and customers with text ids; every 29th order names nobody known, every 31st nobody."""
    key = F.col("o_orderkey")
    planted = F.when(key % 29 == 0, F.concat(F.lit("no"), F.col("o_custkey"))).when(key % 31 == 0, F.lit(None))
    orders = table(spark, sf_dir, "orders").withColumn("customer_id", planted.otherwise(F.col("o_custkey").cast("string")))
    return orders, table(spark, sf_dir, "customer").withColumn("customer_id", F.col("c_custkey").cast("string"))


def q_ref_exists_flag(spark, sf_dir):
    orders, customers = _with_text_ids(spark, sf_dir)
    return refs.exists_flag(orders, customers, "customer_id", "customer_id", spread_by=["o_orderkey"]).select("o_orderkey", "customer_id", "ref_exists")


def q_ref_exists_broadcast(spark, sf_dir):
    orders, customers = _with_text_ids(spark, sf_dir)
    flagged = refs.exists_flag(orders, customers, "customer_id", "customer_id", broadcast_rows=100_000)
    return flagged.select("o_orderkey", "customer_id", "ref_exists")


def q_ref_attributes(spark, sf_dir):
    orders, customers = _with_text_ids(spark, sf_dir)
    attributes = {"segment": F.col("c_mktsegment"), "balance": parsing.number(F.col("c_acctbal"))}
    lookup = refs.Lookup("customers", "customer_id", "customer_id", "customer_found", attributes)
    joined = refs.attach(orders, customers, lookup, spread_by=["o_orderkey"])
    return plain(joined.select("o_orderkey", "customer_id", "segment", "balance", "customer_found"))


def q_orphan_report(spark, sf_dir):
    orders, customers = _with_text_ids(spark, sf_dir)
    return refs.orphans(orders, customers, "customer_id", "customer_id", spread_by=["o_orderkey"]).select("o_orderkey", "customer_id")


def q_payment_orphans(spark, sf_dir):
    view = spark_view(spark, sf_dir, "payments")
    return refs.orphans(view, Silver(spark, sf_dir)["orders"], "order_id", "order_id").select("ingest_seq", "order_id")


def q_dependent_vocabulary(spark, sf_dir):
    """Parts, every 19th of another brand, whose (type, brand) does not occur in the table."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    other = F.when(F.col("p_partkey") % 19 == 0, F.lit("Brand#00")).otherwise(F.col("p_brand"))
    return refs.outside_vocabulary(parts.withColumn("p_brand", other), parts, ["p_type", "p_brand"]).select(*parts.columns)


def q_taxonomy_check(spark, sf_dir):
    bad = p.outside_taxonomy(F.col("category"), F.col("subcategory"), v.TAXONOMY)
    return spark_view(spark, sf_dir, "products").select("ingest_seq", "category", "subcategory", bad.alias("outside"))


def q_ship_before_order(spark, sf_dir):
    lines = line_table(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"), "o_orderdate")
    hot = skew.hot_keys(lines, F.col("l_orderkey"))
    joined = skew.spread_lookup(lines, orders, "l_orderkey", "order_key", hot, spread_by=[*LINE_KEY, *LINE_ORDER])
    early = p.exceeds(F.col("o_orderdate"), F.col("l_shipdate"))
    return plain(joined.where(early).select(*LINE_KEY, *LINE_ORDER, "o_orderdate"))


def q_order_total_reconciliation(spark, sf_dir):
    """Orders whose stated total differs from the sum of their lines: every 37th is a cent off, every 41st has no line."""
    key = F.col("l_orderkey")
    price = parsing.number(F.col("l_extendedprice"))
    lines = line_table(spark, sf_dir)
    sums = lines.groupBy("l_orderkey").agg(parsing.money(F.sum(price)).alias("line_total"))
    cent = F.when(key % 37 == 0, F.lit("0.01").cast("decimal(3,2)")).otherwise(0)
    orders = sums.select(key.alias("o_orderkey"), (F.col("line_total") + cent).alias("stated_total"))
    ref = sums.where(key % 41 != 0).select(key.alias("order_key"), "line_total")
    lookup = refs.Lookup("lines", "o_orderkey", "order_key", "_found", {"line_total": F.col("line_total")})
    wrong = refs.reconcile(orders, ref, lookup, F.col("stated_total"), "line_total")
    return plain(wrong.select("o_orderkey", "stated_total", "line_total"))


def q_payment_recheck(spark, sf_dir):
    """Payments whose amount differs from the raw order total, or without one."""
    total = {"order_total": parsing.number(F.col("total_amount"))}
    lookup = refs.Lookup("orders", "order_id", "order_id", "_found", total)
    payments = labelled(spark, sf_dir, "payments")
    orders = spark_view(spark, sf_dir, "orders")
    hot = _hot(spark, sf_dir, "payments", "order_id")
    wrong = refs.reconcile(payments, orders, lookup, parsing.number(F.col("amount")), "order_total", hot)
    return plain(wrong.select("payment_id", "amount", "order_total"))


def q_line_total_check(spark, sf_dir):
    view = spark_view(spark, sf_dir, "order_items")
    wrong = landing.line_total_mismatches(view, "quantity", "unit_price", "item_total")
    return plain(wrong.select(*ORDER_BY["order_items"], "quantity", "unit_price", "item_total", "computed_total"))


def _flags(spark, sf_dir, entity, **flags):
    view = spark_view(spark, sf_dir, entity)
    return view.select(*ORDER_BY[entity], *[c.alias(n) for n, c in flags.items()])


def q_code_check(spark, sf_dir):
    c = F.col
    return _flags(
        spark, sf_dir, "order_items",
        bad_order=p.bad_code(c("order_id"), "O", DIGITS, 1),
        bad_product=p.bad_code(c("product_id"), "P", DIGITS, 1),
    )


def q_pattern_check(spark, sf_dir):
    c = F.col
    return _flags(
        spark, sf_dir, "customers",
        bad_email=p.not_matching(c("email"), v.EMAIL),
        bad_phone=p.not_matching(c("phone"), v.MOBILE),
        bad_postal_code=p.not_matching(c("postal_code"), v.POSTAL_CODE),
    )


def q_conditional_requirement(spark, sf_dir):
    c = F.col
    return _flags(
        spark, sf_dir, "payments",
        missing_reference=p.required_when(c("payment_status"), v.SETTLED_STATUSES, c("transaction_reference")),
        bad_reference=p.given_but_not_matching(c("transaction_reference"), v.TRANSACTION),
    )


def q_status_consistency(spark, sf_dir):
    available, reorder = parsing.number(F.col("available_quantity")), parsing.number(F.col("reorder_level"))
    conflict = p.stock_status_conflict(available, reorder, F.col("inventory_status"))
    return _flags(spark, sf_dir, "inventory", status_conflict=conflict)


def _hot(spark, sf_dir, entity, column) -> DataFrame:
    return skew.hot_keys(spark_view(spark, sf_dir, entity), F.col(column))


def daily(spark, sf_dir, ordered: bool = True):
    # Lines are read twice: for their sums and for the products of a day.
    columns = {"orders": MART_COLUMNS["orders"], "order_items": schemas.ORDER_ITEMS}
    silver = Silver(spark, sf_dir, shared=("orders", "order_items"), columns=columns)
    return marts.daily_sales(
        silver["orders"],
        silver["order_items"],
        silver["payments"],
        item_ids_unique=True,
        ordered=ordered,
    )


def q_daily_sales(spark, sf_dir):
    return plain(daily(spark, sf_dir))


def q_customer_360(spark, sf_dir):
    return plain(customers_mart(spark, sf_dir))


def q_sales_with_product(spark, sf_dir):
    silver = Silver(spark, sf_dir)
    lines = marts.sales_lines(
        silver["orders"],
        silver["order_items"],
        hot_orders=_hot(spark, sf_dir, "order_items", "order_id"),
    )
    hot_products = _hot(spark, sf_dir, "order_items", "product_id")
    rich = marts.sales_with_product(lines, silver["products"], hot_products)
    return plain(
        rich.groupBy("category", "subcategory", "brand").agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("quantity").cast("bigint").alias("quantity"),
            parsing.money(F.sum("item_total")).alias("net_sales"),
        )
    )


def q_order_filter_counts(spark, sf_dir):
    return report.filter_counts(Silver(spark, sf_dir)["orders"], F.col("order_status").isin(*v.COMPLETED_STATUSES))


def q_status_counts(spark, sf_dir):
    kept = Silver(spark, sf_dir)["orders"].where(F.col("order_status").isin(*v.COMPLETED_STATUSES))
    return report.value_counts(kept, "order_status")


def q_late_arrivals(spark, sf_dir):
    day = F.to_date("ts")
    late = F.when(F.col("event_id") % 50 == 0, 2).otherwise(0)
    landed = table(spark, sf_dir, "events").withColumn("landing_date", F.date_add(day, late))
    return plain(
        landing.late_arrivals(landed, day, F.col("landing_date")).select("event_id", "landing_date", "days_late")
    )


def q_quantity_triage(spark, sf_dir):
    return landing.quantity_triage(spark_view(spark, sf_dir, "order_items"))


def q_price_normalize(spark, sf_dir):
    priced = landing.normalize_price(spark_view(spark, sf_dir, "products"))
    return plain(priced.select("ingest_seq", "unit_price", "unit_price_number"))


def q_region_lookup(spark, sf_dir):
    located = landing.add_region(spark_view(spark, sf_dir, "customers"))
    return located.groupBy("state", "region").agg(F.count(F.lit(1)).alias("count"))


def q_category_backfill(spark, sf_dir):
    filled = landing.backfill_category(spark_view(spark, sf_dir, "products"), "category", "subcategory")
    return filled.select("ingest_seq", "category", "subcategory")


def q_contact_gaps(spark, sf_dir):
    gaps = landing.contact_gaps(spark_view(spark, sf_dir, "customers"), phone_pattern=v.MOBILE)
    return gaps.select("ingest_seq", "missing_email", "missing_phone")


def q_schema_drift(spark, sf_dir):
    """Orders before and after a column appears, as one frame."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    change = F.lit("1998-01-01").cast("timestamp_ntz")
    before = orders.where(F.col("o_orderdate") < change).select("o_orderkey")
    after = orders.where(F.col("o_orderdate") >= change)
    after = after.select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("discount_code"))
    return union_drifting([before, after])


def q_preview(spark, sf_dir):
    return report.preview(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"])


def _tuned(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(tune(spark), sf_dir)

    return run


_QUERIES = {
    "orders_first_issue": partial(q_labels, entity="orders"),
    "orders_all_issues": q_orders_all_issues,
    "orders_issue_array": q_orders_issue_array,
    "orders_silver": partial(q_silver, entity="orders"),
    "orders_quarantine": partial(q_quarantine, entity="orders"),
    "order_items_silver": partial(q_silver, entity="order_items"),
    "payments_quarantine": partial(q_quarantine, entity="payments"),
    "dq_rule_counts": partial(q_rule_counts, entity="orders"),
    "dq_rule_counts_customers": partial(q_rule_counts, entity="customers"),
    "dq_rule_counts_sellers": partial(q_rule_counts, entity="sellers"),
    "dq_rule_counts_products": partial(q_rule_counts, entity="products"),
    "dq_rule_counts_order_items": partial(q_rule_counts, entity="order_items"),
    "dq_rule_counts_payments": partial(q_rule_counts, entity="payments"),
    "dq_rule_counts_inventory": partial(q_rule_counts, entity="inventory"),
    "dq_distribution": partial(q_distribution, entity="orders"),
    "dq_summary": partial(q_summary, entity="orders"),
    "customers_validate": partial(q_labels, entity="customers"),
    "sellers_validate": partial(q_labels, entity="sellers"),
    "products_validate_strict": partial(q_labels, entity="products"),
    "products_validate_multi": partial(q_labels, entity="products", rules="products_multi"),
    "order_items_validate": partial(q_labels, entity="order_items"),
    "payments_validate": partial(q_labels, entity="payments"),
    "inventory_validate": partial(q_labels, entity="inventory"),
    "null_profile": q_null_profile,
    "duplicate_keys": q_repeated_keys,
    "duplicate_key_summary": q_repeated_key_summary,
    "negative_counts": q_negative_counts,
    "constraint_report": partial(q_silver_check, entity="orders"),
    **{
        f"silver_recheck_{e}": partial(q_silver_check, entity=e)
        for e in ("customers", "sellers", "products", "order_items", "payments", "inventory")
    },
    "orders_is_valid": q_is_valid,
    "orders_validate_ranged": partial(q_labels, entity="orders", rules="orders_ranged"),
    "inventory_validate_by_day": partial(q_labels, entity="inventory", rules="inventory_by_day"),
    "customers_flag_all": q_flag_all_customers,
    "resend_validate": q_resend_validate,
    "layer_check": q_layer_check,
    "mart_check": q_mart_check,
    "mart_check_customers": q_mart_check_customers,
    "mart_conservation": q_mart_conservation,
    "dedup_keep_first": q_dedup_keep_first,
    "dedup_flag_later": q_dedup_flag_later,
    "dedup_flag_all": q_dedup_flag_all,
    "dedup_exact": q_dedup_exact,
    "ref_exists_flag": q_ref_exists_flag,
    "ref_exists_broadcast": q_ref_exists_broadcast,
    "ref_attributes": q_ref_attributes,
    "orphan_report": q_orphan_report,
    "payment_orphans": q_payment_orphans,
    "dependent_vocabulary": q_dependent_vocabulary,
    "taxonomy_check": q_taxonomy_check,
    "ship_before_order": q_ship_before_order,
    "order_total_reconciliation": q_order_total_reconciliation,
    "payment_recheck": q_payment_recheck,
    "line_total_check": q_line_total_check,
    "code_check": q_code_check,
    "pattern_check": q_pattern_check,
    "conditional_requirement": q_conditional_requirement,
    "status_consistency": q_status_consistency,
    "daily_sales": q_daily_sales,
    "customer_360": q_customer_360,
    "sales_with_product": q_sales_with_product,
    "order_filter_counts": q_order_filter_counts,
    "status_counts": q_status_counts,
    "late_arrivals": q_late_arrivals,
    "quantity_triage": q_quantity_triage,
    "price_normalize": q_price_normalize,
    "region_lookup": q_region_lookup,
    "category_backfill": q_category_backfill,
    "contact_gaps": q_contact_gaps,
    "schema_drift_read": q_schema_drift,
    "preview_top10": q_preview,
}

QUERIES = {name: _tuned(query) for name, query in _QUERIES.items()}

"""Gold marts: customer 360 and daily sales.

Inputs are silver tables. Order items and payments are summed per order before they meet the orders in
both marts, so one order with very many lines cannot unbalance a join; only ``sales_lines`` joins single lines.
"""

from pyspark.sql import DataFrame, functions as F

from ..entities.vocabulary import COMPLETED_STATUSES
from ..functions.parsing import money, number, product, timestamp
from ..operators import refs, skew
from ..sources.bucketed import Bucketed

CUSTOMER_COLUMNS = (
    "customer_id", "first_name", "last_name", "city", "state", "country", "loyalty_tier", "customer_status",
)


def _zero(c):
    return F.coalesce(c, F.lit(0))


def _average(amount, n):
    """Amount per unit with enough digits left for an exact final rounding; NULL when n is 0."""
    return F.try_divide(amount.try_cast("decimal(32,6)"), n.cast("decimal(19,0)"))


def customer_360(
    customers: DataFrame, orders: DataFrame, order_items: DataFrame, payments: DataFrame, ordered: bool = True
) -> DataFrame:
    """One row per customer with order counts, spend, payments and lifetime.

    Spend and items count completed orders only; successful payments count every order.
    """
    per_order = orders_with_sums(orders, item_sums(order_items), payment_sums(payments))
    return _per_customer(customers, per_order, ordered)


def item_sums(order_items: DataFrame) -> DataFrame:
    """Items and spend of each order."""
    c = F.col
    return order_items.groupBy(c("order_id").alias("_item_order")).agg(
        F.try_sum(number(c("quantity"))).alias("_items"), F.try_sum(number(c("item_total"))).alias("_spend")
    )


def payment_sums(payments: DataFrame) -> DataFrame:
    """Successful payments of each order."""
    c = F.col
    successful = payments.where(c("payment_status") == "Success")
    return successful.groupBy(c("order_id").alias("_paid_order")).agg(F.try_sum(number(c("amount"))).alias("_paid"))


def orders_with_sums(orders: DataFrame, items: DataFrame, paid: DataFrame) -> DataFrame:
    """Orders as the customer mart reads them, with the sums of their items and payments."""
    c = F.col
    status = c("order_status")
    return (
        orders.select(
            "order_id",
            "customer_id",
            status.isin(*COMPLETED_STATUSES).alias("_completed"),
            (status == "Cancelled").alias("_cancelled"),
            (status == "Returned").alias("_returned"),
            timestamp(c("order_date")).alias("_ordered"),
        )
        .join(items, c("order_id") == c("_item_order"), "left")
        .join(paid, c("order_id") == c("_paid_order"), "left")
    )


def bucketed_orders_with_sums(orders: Bucketed, order_items: Bucketed, payments: Bucketed) -> DataFrame:
    """``orders_with_sums`` of tables bucketed by order id: sums and joins work bucket by bucket, without a shuffle.

    Orders with too many lines for one bucket are summed apart and joined last, as a small table.
    """
    if len({t.buckets for t in (orders, order_items, payments)}) > 1 or {t.key for t in (orders, order_items, payments)} != {"order_id"}:
        raise ValueError("the tables must have the same number of buckets of order_id")
    if orders.rest is not None:
        raise ValueError("order ids must be known and unique, as validated ones are")
    # Not broadcast either: both sides are sorted buckets already.
    found = orders_with_sums(orders.rows, item_sums(order_items.rows).hint("merge"), payment_sums(payments.rows).hint("merge"))
    for table, sums, key, columns in (
        (order_items, item_sums, "_item_order", ("_items", "_spend")), (payments, payment_sums, "_paid_order", ("_paid",)),
    ):
        if table.rest is not None:
            rest = sums(table.rest)
            rest = rest.select(F.col(key).alias("_rest"), *[F.col(n).alias(f"{n}_rest") for n in columns])
            found = found.join(rest, F.col("order_id") == F.col("_rest"), "left")
            found = found.withColumns({n: F.coalesce(n, f"{n}_rest") for n in columns}).drop("_rest", *[f"{n}_rest" for n in columns])
    return found


def customer_360_bucketed(
    customers: DataFrame, orders: Bucketed, order_items: Bucketed, payments: Bucketed, ordered: bool = True
) -> DataFrame:
    """``customer_360`` of tables bucketed by order id."""
    return _per_customer(customers, bucketed_orders_with_sums(orders, order_items, payments), ordered)


def _per_customer(customers: DataFrame, per_order: DataFrame, ordered: bool) -> DataFrame:
    c = F.col
    # Grouping by order as well turns the distinct counts below into plain sums.
    completed = c("_completed")
    per_order = per_order.groupBy("customer_id", "order_id").agg(
        F.max(completed).alias("_completed"),
        F.max("_cancelled").alias("_cancelled"),
        F.max("_returned").alias("_returned"),
        F.try_sum(F.when(completed, c("_items"))).alias("_items"),
        F.try_sum(F.when(completed, c("_spend"))).alias("_spend"),
        F.min(F.when(completed, c("_ordered"))).alias("_first"),
        F.max(F.when(completed, c("_ordered"))).alias("_last"),
        F.try_sum("_paid").alias("_paid"),
    )
    per_customer = per_order.groupBy(c("customer_id").alias("_customer")).agg(
        F.count("order_id").alias("_n_orders"),
        F.count_if(c("_completed")).alias("_n_completed"),
        F.count_if(c("_cancelled")).alias("_n_cancelled"),
        F.count_if(c("_returned")).alias("_n_returned"),
        F.try_sum("_items").alias("_items"),
        F.try_sum("_spend").alias("_spend"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.try_sum("_paid").alias("_paid"),
    )
    per_order_value = _average(_zero(c("_spend")), c("_n_completed"))
    mart = customers.join(per_customer, c("customer_id") == c("_customer"), "left").select(
        *CUSTOMER_COLUMNS,
        timestamp(c("registration_date")).alias("registration_date"),
        _zero(c("_n_orders")).alias("total_orders"),
        _zero(c("_n_completed")).alias("completed_orders"),
        _zero(c("_n_cancelled")).alias("cancelled_orders"),
        _zero(c("_n_returned")).alias("returned_orders"),
        _zero(c("_items")).try_cast("bigint").alias("total_items_purchased"),
        money(_zero(c("_spend"))).alias("total_spend"),
        c("_first").alias("first_order_date"),
        c("_last").alias("last_order_date"),
        money(_zero(c("_paid"))).alias("successful_payment_amount"),
        money(_zero(per_order_value)).alias("average_order_value"),
        F.timestamp_diff("DAY", c("_first"), c("_last")).alias("customer_lifetime_days"),
    )
    return mart.orderBy("customer_id") if ordered else mart


def sales_lines(orders: DataFrame, order_items: DataFrame, hot_orders: DataFrame | None = None) -> DataFrame:
    """Lines of completed orders with parsed amounts, gross amount and sales date.

    ``hot_orders`` may pass the hot order ids when they are known from a cheaper frame.
    """
    c = F.col
    lines = order_items.select(
        "order_item_id",
        "order_id",
        "product_id",
        number(c("quantity")).alias("quantity"),
        product(number(c("quantity")), number(c("unit_price"))).alias("gross_item_amount"),
        number(c("discount_amount")).alias("discount_amount"),
        number(c("tax_amount")).alias("tax_amount"),
        number(c("item_total")).alias("item_total"),
    )
    eligible = orders.where(c("order_status").isin(*COMPLETED_STATUSES)).select(
        c("order_id").alias("_order"),
        "customer_id",
        "order_status",
        F.to_date(timestamp(c("order_date"))).alias("sales_date"),
    )
    hot = skew.hot_keys(order_items, c("order_id")) if hot_orders is None else hot_orders
    return skew.spread_lookup(lines, eligible, "order_id", "_order", hot, how="inner").drop("_order")


def sales_with_product(lines: DataFrame, products: DataFrame, hot_products: DataFrame | None = None) -> DataFrame:
    """Sales lines with category, subcategory and brand; lines without a known product keep NULLs."""
    attributes = {n: F.col(n) for n in ("category", "subcategory", "brand")}
    lookup = refs.Lookup("products", "product_id", "product_id", "_product_found", attributes)
    return refs.attach(lines, products, lookup, hot_products).drop("_product_found")


def daily_payments(payments: DataFrame) -> DataFrame:
    """Successful payments per payment day."""
    c = F.col
    return (
        payments.where(c("payment_status") == "Success")
        .groupBy(F.to_date(timestamp(c("payment_date"))).alias("payment_day"))
        .agg(F.try_sum(number(c("amount"))).alias("_paid"))
    )


def daily_sales(
    orders: DataFrame, order_items: DataFrame, payments: DataFrame, item_ids_unique: bool = False, ordered: bool = True
) -> DataFrame:
    """One row per day with a completed sale.

    Lines are summed per order before they meet the orders; the distinct products of a day come from the
    distinct (order, product) pairs. ``item_ids_unique`` (true for silver, where validation removed
    repeated ids) counts lines without shuffling their ids.
    """
    c = F.col
    eligible = orders.where(c("order_status").isin(*COMPLETED_STATUSES)).select(
        c("order_id").alias("_order"), "customer_id", F.to_date(timestamp(c("order_date"))).alias("sales_date")
    )
    eligible = eligible.where(c("sales_date").isNotNull())
    quantity = number(c("quantity"))
    per_order = order_items.groupBy("order_id").agg(
        F.count("order_item_id").alias("_items"),
        F.try_sum(quantity).alias("_quantity"),
        F.try_sum(product(quantity, number(c("unit_price")))).alias("_gross"),
        F.try_sum(number(c("discount_amount"))).alias("_discount"),
        F.try_sum(number(c("tax_amount"))).alias("_tax"),
        F.try_sum(number(c("item_total"))).alias("_net"),
    )
    sold = per_order.join(eligible, c("order_id") == c("_order"))
    sums = [F.try_sum(n).alias(n) for n in ("_items", "_quantity", "_gross", "_discount", "_tax", "_net")]
    # One row per (day, customer) first; days with very many orders stay many rows until the last step.
    per_customer = sold.groupBy("sales_date", "customer_id", "order_id").agg(*sums)
    per_customer = per_customer.groupBy("sales_date", "customer_id").agg(F.count("order_id").alias("_orders"), *sums)
    daily = per_customer.groupBy("sales_date").agg(
        F.sum("_orders").alias("total_orders"), F.count("customer_id").alias("unique_customers"), *sums
    )

    def per_day(column, name):
        pairs = order_items.select("order_id", column).distinct().join(eligible, c("order_id") == c("_order"))
        pairs = pairs.select(c("sales_date").alias("_day"), column).distinct()
        return pairs.groupBy(c("_day").alias(f"_day_{name}")).agg(F.count(column).alias(name))

    daily = daily.join(per_day("product_id", "unique_products"), c("sales_date") == c("_day_unique_products"))
    if item_ids_unique:
        daily = daily.withColumn("total_order_items", c("_items"))
    else:
        daily = daily.join(per_day("order_item_id", "total_order_items"), c("sales_date") == c("_day_total_order_items"))
    net = _zero(c("_net"))
    mart = daily.join(daily_payments(payments), c("sales_date") == c("payment_day"), "left").select(
        "sales_date",
        "total_orders",
        "total_order_items",
        _zero(c("_quantity")).try_cast("bigint").alias("total_quantity"),
        money(_zero(c("_gross"))).alias("gross_sales"),
        money(_zero(c("_discount"))).alias("discount_amount"),
        money(_zero(c("_tax"))).alias("tax_amount"),
        money(net).alias("net_sales"),
        "unique_customers",
        "unique_products",
        money(_zero(c("_paid"))).alias("successful_payment_amount"),
        money(_average(net, c("total_orders"))).alias("average_order_value"),
    )
    return mart.orderBy("sales_date") if ordered else mart

"""Rule sets of orders, order items and payments."""

from pyspark.sql import functions as F

from ..functions import predicates as p
from ..functions.parsing import number, product, timestamp
from ..operators.refs import Lookup
from ..operators.validate import DUPLICATE, Rule, RuleSet
from . import schemas, vocabulary as v


def orders(
    as_of=v.AS_OF, id_digits: int = 6, max_customer: int | None = v.MAX_CUSTOMER, null_keys: str = "distinct"
) -> RuleSet:
    c = F.col
    subtotal, discount, shipping, tax, total = (c(n) for n in ("_subtotal", "_discount", "_shipping", "_tax", "_total"))
    ordered = c("_ordered")
    return RuleSet(
        entity="orders",
        key="order_id",
        columns=schemas.ORDERS,
        null_keys=null_keys,
        derived={
            "_ordered": timestamp(c("order_date")),
            "_subtotal": number(c("subtotal_amount")),
            "_discount": number(c("discount_amount")),
            "_shipping": number(c("shipping_fee")),
            "_tax": number(c("tax_amount")),
            "_total": number(c("total_amount")),
        },
        rules=(
            Rule("duplicate_order_record", c(DUPLICATE)),
            Rule("missing_required_field_order_id", p.blank(c("order_id"))),
            Rule("missing_customer_id", p.blank(c("customer_id"))),
            Rule("invalid_customer_id", p.bad_code(c("customer_id"), "C", id_digits, 1, max_customer)),
            Rule("invalid_order_date", p.unparseable(ordered)),
            Rule("future_order_date", p.in_future(ordered, as_of)),
            Rule("invalid_order_status", p.not_in(c("order_status"), v.ORDER_STATUSES)),
            Rule("invalid_payment_method", p.not_in(c("payment_method"), v.PAYMENT_METHODS)),
            Rule("missing_shipping_city", p.blank(c("shipping_city"))),
            Rule("missing_shipping_state", p.blank(c("shipping_state"))),
            Rule("invalid_shipping_postal_code", p.not_matching(c("shipping_postal_code"), v.POSTAL_CODE)),
            Rule("invalid_subtotal_amount", p.out_of_range(subtotal, above=0)),
            Rule("invalid_discount_amount", p.out_of_range(discount, low=0)),
            Rule("discount_exceeds_subtotal", p.exceeds(discount, subtotal)),
            Rule("invalid_shipping_fee", p.out_of_range(shipping, low=0)),
            Rule("invalid_tax_amount", p.out_of_range(tax, low=0)),
            Rule(
                "invalid_total_amount",
                p.out_of_range(total, low=0) | p.disagrees(total, subtotal - discount + shipping + tax),
            ),
        ),
    )


def order_items(
    id_digits: int = 6,
    max_order: int | None = v.MAX_ORDER,
    max_product: int | None = v.MAX_PRODUCT,
    null_keys: str = "distinct",
) -> RuleSet:
    c = F.col
    quantity, price, discount, tax, total = (c(n) for n in ("_quantity", "_price", "_discount", "_tax", "_total"))
    gross = product(quantity, price)
    # No total in range equals a gross amount beyond it, and every discount exceeds one far below zero.
    beyond = p.overflows(quantity, price, gross)
    negative = F.coalesce((quantity < 0) != (price < 0), F.lit(False))
    return RuleSet(
        entity="order_items",
        key="order_item_id",
        columns=schemas.ORDER_ITEMS,
        null_keys=null_keys,
        derived={
            "_quantity": number(c("quantity")),
            "_price": number(c("unit_price")),
            "_discount": number(c("discount_amount")),
            "_tax": number(c("tax_amount")),
            "_total": number(c("item_total")),
        },
        rules=(
            Rule("duplicate_order_item_record", c(DUPLICATE)),
            Rule("missing_order_item_id", p.blank(c("order_item_id"))),
            Rule("missing_order_id", p.blank(c("order_id"))),
            Rule("invalid_order_id", p.bad_code(c("order_id"), "O", id_digits, 1, max_order)),
            Rule("missing_product_id", p.blank(c("product_id"))),
            Rule("invalid_product_id", p.bad_code(c("product_id"), "P", id_digits, 1, max_product)),
            Rule("invalid_quantity", p.not_a_count(quantity, above=0)),
            Rule("invalid_unit_price", p.out_of_range(price, above=0)),
            Rule("invalid_discount_amount", p.out_of_range(discount, low=0)),
            Rule("discount_exceeds_gross_amount", p.exceeds(discount, F.round(gross, 2)) | (beyond & negative & discount.isNotNull())),
            Rule("invalid_tax_amount", p.out_of_range(tax, low=0)),
            Rule(
                "invalid_item_total",
                p.out_of_range(total, low=0)
                | p.disagrees(total, F.try_add(F.try_subtract(gross, discount), tax))
                | (beyond & discount.isNotNull() & tax.isNotNull()),
            ),
        ),
    )


def payments(as_of=v.AS_OF, null_keys: str = "distinct") -> RuleSet:
    c = F.col
    paid, amount, reference = c("_paid"), c("_amount"), c("transaction_reference")
    return RuleSet(
        entity="payments",
        key="payment_id",
        columns=schemas.PAYMENTS,
        null_keys=null_keys,
        lookups=(
            Lookup(
                "orders",
                "order_id",
                "order_id",
                found="_order_found",
                attributes={"_ordered": timestamp(c("order_date")), "_order_total": number(c("total_amount"))},
            ),
        ),
        derived={"_paid": timestamp(c("payment_date")), "_amount": number(c("amount"))},
        rules=(
            Rule("duplicate_payment_record", c(DUPLICATE)),
            Rule("missing_payment_id", p.blank(c("payment_id"))),
            Rule("missing_order_id", p.blank(c("order_id"))),
            Rule("invalid_order_id", ~c("_order_found")),
            Rule("invalid_payment_date", p.unparseable(paid)),
            Rule("future_payment_date", p.in_future(paid, as_of)),
            Rule("payment_before_order_date", p.exceeds(c("_ordered"), paid)),
            Rule("invalid_payment_method", p.not_in(c("payment_method"), v.PAYMENT_METHODS)),
            Rule("invalid_payment_status", p.not_in(c("payment_status"), v.PAYMENT_STATUSES)),
            Rule("invalid_transaction_reference", p.given_but_not_matching(reference, v.TRANSACTION)),
            Rule("invalid_amount", p.out_of_range(amount, above=0)),
            Rule("invalid_currency", p.not_in(c("currency"), v.CURRENCIES)),
            Rule("invalid_payment_gateway", p.not_in(c("payment_gateway"), v.GATEWAYS)),
            Rule("missing_transaction_reference", p.required_when(c("payment_status"), v.SETTLED_STATUSES, reference)),
            Rule("amount_mismatch_with_order", p.disagrees(amount, c("_order_total"))),
        ),
    )

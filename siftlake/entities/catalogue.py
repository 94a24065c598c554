"""Rule sets of products (two variants) and inventory."""

from pyspark.sql import functions as F

from ..functions import predicates as p
from ..functions.parsing import iso_date, number, text, timestamp
from ..operators.refs import Lookup
from ..operators.validate import DUPLICATE, Rule, RuleSet
from . import schemas, vocabulary as v


def products_strict(
    as_of=v.AS_OF, max_seller: int | None = v.MAX_SELLER, duplicates: str = "later", null_keys: str = "distinct"
) -> RuleSet:
    """First issue only; taxonomy, seller range and cost below price are enforced."""
    c = F.col
    price, cost, stock, created = c("_price"), c("_cost"), c("_stock"), c("_created")
    return RuleSet(
        entity="products",
        key="product_id",
        columns=schemas.PRODUCTS,
        duplicates=duplicates,
        null_keys=null_keys,
        derived={
            "_price": number(c("unit_price")),
            "_cost": number(c("cost_price")),
            "_stock": number(c("stock_quantity")),
            "_created": timestamp(c("created_date")),
        },
        rules=(
            Rule("duplicate_product_record", c(DUPLICATE)),
            Rule("missing_required_field_product_id", p.blank(c("product_id"))),
            Rule("invalid_seller_id", p.bad_code(c("seller_id"), "S", 5, 1, max_seller)),
            Rule("missing_product_name", p.blank(c("product_name"))),
            Rule("invalid_category", p.not_in(c("category"), v.TAXONOMY)),
            Rule("invalid_subcategory", p.outside_taxonomy(c("category"), c("subcategory"), v.TAXONOMY)),
            Rule("invalid_unit_price", p.out_of_range(price, above=0)),
            Rule("invalid_cost_price", p.out_of_range(cost, above=0) | p.exceeds(cost, price, or_equals=True)),
            Rule("invalid_stock_quantity", p.out_of_range(stock, low=0)),
            Rule("invalid_product_status", p.not_in(c("product_status"), v.PRODUCT_STATUSES)),
            Rule("invalid_created_date", p.unparseable(created)),
            Rule("future_created_date", p.in_future(created, as_of)),
        ),
    )


def products_multi(as_of=v.AS_OF) -> RuleSet:
    """Every issue of a row; every copy of a repeated id is an issue; dates are exactly yyyy-MM-dd."""
    c = F.col
    price, cost, stock, created = c("_price"), c("_cost"), c("_stock"), c("_created")
    return RuleSet(
        entity="products",
        key="product_id",
        columns=schemas.PRODUCTS,
        duplicates="all",
        null_keys="distinct",
        labelling="all",
        derived={
            "_price": number(c("unit_price")),
            "_cost": number(c("cost_price")),
            "_stock": number(c("stock_quantity")),
            "_created": iso_date(c("created_date")),
        },
        rules=(
            Rule("missing_product_id", p.blank(c("product_id"))),
            Rule("duplicate_product_id", c(DUPLICATE)),
            Rule("invalid_seller_id", p.not_matching(c("seller_id"), r"\AS[0-9]{5}\z")),
            Rule("missing_product_name", p.blank(c("product_name"))),
            Rule("invalid_category", p.blank(c("category"))),
            Rule("invalid_subcategory", p.blank(c("subcategory"))),
            Rule("invalid_unit_price", p.out_of_range(price, above=0)),
            Rule("invalid_cost_price", p.out_of_range(cost, low=0) | p.exceeds(cost, price)),
            Rule("invalid_stock_quantity", p.out_of_range(stock, low=0)),
            Rule("invalid_product_status", p.not_in(c("product_status"), v.PRODUCT_STATUSES)),
            Rule("invalid_created_date", p.unparseable(created)),
            Rule("future_created_date", p.in_future(created, as_of, grain="date")),
        ),
    )


def inventory(as_of=v.AS_OF, grain: str = "timestamp", trim: bool = False, null_keys: str = "distinct") -> RuleSet:
    """``grain="date"`` and ``trim=True`` give the variant that compares days and ignores outer spaces."""
    c = F.col
    stock, reserved, available, reorder = c("_stock"), c("_reserved"), c("_available"), c("_reorder")
    updated, status = c("_updated"), c("inventory_status")
    return RuleSet(
        entity="inventory",
        key="inventory_id",
        columns=schemas.INVENTORY,
        null_keys=null_keys,
        duplicate_key=text(c("inventory_id")) if trim else None,
        lookups=(Lookup("products", "product_id", "product_id", found="_product_found"),),
        derived={
            "_stock": number(c("stock_quantity")),
            "_reserved": number(c("reserved_quantity")),
            "_available": number(c("available_quantity")),
            "_reorder": number(c("reorder_level")),
            "_updated": timestamp(c("last_updated")),
        },
        rules=(
            Rule("duplicate_inventory_record", c(DUPLICATE)),
            Rule("missing_inventory_id", p.blank(c("inventory_id"))),
            Rule("missing_product_id", p.blank(c("product_id"))),
            Rule("invalid_product_id", ~c("_product_found")),
            Rule("invalid_warehouse_id", p.not_in(c("warehouse_id"), v.WAREHOUSES, trim)),
            Rule("invalid_stock_quantity", p.not_a_count(stock, low=0)),
            Rule("invalid_reserved_quantity", p.not_a_count(reserved, low=0)),
            Rule("reserved_exceeds_stock", p.exceeds(reserved, stock)),
            Rule("invalid_available_quantity", p.not_a_count(available, low=0)),
            Rule("available_quantity_mismatch", p.differs(available, stock - reserved)),
            Rule("invalid_reorder_level", p.not_a_count(reorder, low=0)),
            Rule("invalid_inventory_status", p.not_in(status, v.STOCK_STATUSES, trim)),
            Rule(
                "inventory_status_mismatch",
                p.stock_status_conflict(available, reorder, text(status) if trim else status),
            ),
            Rule("invalid_last_updated", p.unparseable(updated)),
            Rule("future_last_updated", p.in_future(updated, as_of, grain)),
        ),
    )

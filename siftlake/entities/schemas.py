"""Column lists and read schemas. Text columns stay text: rules must survive malformed values."""

from pyspark.sql.types import DoubleType, StringType, StructField, StructType

CUSTOMERS = (
    "customer_id", "first_name", "last_name", "gender", "date_of_birth", "email", "phone", "city", "state",
    "country", "postal_code", "registration_date", "loyalty_tier", "customer_status",
)
SELLERS = (
    "seller_id", "seller_name", "email", "phone", "city", "state", "country", "seller_rating", "seller_status",
    "joined_date",
)
PRODUCTS = (
    "product_id", "seller_id", "product_name", "category", "subcategory", "brand", "unit_price", "cost_price",
    "stock_quantity", "product_status", "created_date",
)
ORDERS = (
    "order_id", "customer_id", "order_date", "order_status", "payment_method", "shipping_city", "shipping_state",
    "shipping_postal_code", "subtotal_amount", "discount_amount", "shipping_fee", "tax_amount", "total_amount",
)
ORDER_ITEMS = (
    "order_item_id", "order_id", "product_id", "quantity", "unit_price", "discount_amount", "tax_amount",
    "item_total",
)
PAYMENTS = (
    "payment_id", "order_id", "payment_date", "payment_method", "payment_status", "transaction_reference", "amount",
    "currency", "payment_gateway",
)
INVENTORY = (
    "inventory_id", "product_id", "warehouse_id", "stock_quantity", "reserved_quantity", "available_quantity",
    "reorder_level", "inventory_status", "last_updated",
)

COLUMNS = {
    "customers": CUSTOMERS,
    "sellers": SELLERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "payments": PAYMENTS,
    "inventory": INVENTORY,
}

_NUMERIC = {"seller_rating"}


def schema(entity: str, extra: StructType | None = None) -> StructType:
    """Read schema of an entity, with optional technical columns behind it."""
    fields = [StructField(c, DoubleType() if c in _NUMERIC else StringType()) for c in COLUMNS[entity]]
    return StructType(fields + (list(extra.fields) if extra else []))

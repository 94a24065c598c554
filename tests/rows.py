"""One valid row per entity; tests change single fields of it."""

VALID = {
    "customers": {
        "customer_id": "C000001", "first_name": "Asha", "last_name": "Rao", "gender": "Female",
        "date_of_birth": "1990-05-01", "email": "asha@mail.in", "phone": "9876543210", "city": "Pune",
        "state": "Maharashtra", "country": "India", "postal_code": "411001", "registration_date": "2020-01-01",
        "loyalty_tier": "Gold", "customer_status": "Active",
    },
    "sellers": {
        "seller_id": "S00001", "seller_name": "Shop", "email": "shop@mail.in", "phone": "6000000000", "city": "Pune",
        "state": "Maharashtra", "country": "India", "seller_rating": 5.0, "seller_status": "Active",
        "joined_date": "2020-01-01",
    },
    "products": {
        "product_id": "P000001", "seller_id": "S00001", "product_name": "Shoe", "category": "Fashion",
        "subcategory": "Footwear", "brand": "B", "unit_price": "100", "cost_price": "60", "stock_quantity": "5",
        "product_status": "Active", "created_date": "2020-01-01",
    },
    "orders": {
        "order_id": "O000001", "customer_id": "C000001", "order_date": "2026-07-01", "order_status": "Delivered",
        "payment_method": "UPI", "shipping_city": "Pune", "shipping_state": "Maharashtra",
        "shipping_postal_code": "411001", "subtotal_amount": "100.00", "discount_amount": "10.00",
        "shipping_fee": "5.00", "tax_amount": "5.00", "total_amount": "100.00",
    },
    "order_items": {
        "order_item_id": "I1", "order_id": "O000001", "product_id": "P000001", "quantity": "2", "unit_price": "50",
        "discount_amount": "10", "tax_amount": "5", "item_total": "95",
    },
    "payments": {
        "payment_id": "T1", "order_id": "O000001", "payment_date": "2026-07-02", "payment_method": "UPI",
        "payment_status": "Success", "transaction_reference": "TXN1", "amount": "100.00", "currency": "INR",
        "payment_gateway": "PayU",
    },
    "inventory": {
        "inventory_id": "V1", "product_id": "P000001", "warehouse_id": "W001", "stock_quantity": "10",
        "reserved_quantity": "2", "available_quantity": "8", "reorder_level": "3", "inventory_status": "In Stock",
        "last_updated": "2026-07-01",
    },
}


def frame(spark, entity, changes):
    """One row per dict of changes, numbered in ``ingest_seq``."""
    from pyspark.sql.types import LongType, StructField, StructType

    from siftlake.entities.schemas import schema

    full = schema(entity, StructType([StructField("ingest_seq", LongType())]))
    rows = [{**VALID[entity], **change, "ingest_seq": i} for i, change in enumerate(changes)]
    return spark.createDataFrame([tuple(r[f.name] for f in full.fields) for r in rows], full)

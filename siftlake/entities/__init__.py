"""Schemas, vocabularies and ordered rule sets of the seven entities."""

from .catalogue import inventory, products_multi, products_strict
from .people import customers, sellers
from .sales import order_items, orders, payments

__all__ = [
    "customers",
    "inventory",
    "order_items",
    "orders",
    "payments",
    "products_multi",
    "products_strict",
    "sellers",
]

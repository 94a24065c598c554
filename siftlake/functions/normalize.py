"""Value normalizers for landed data."""

from pyspark.sql import Column, functions as F

from .parsing import money, number, product, text

# State to sales region.
REGION_OF_STATE = {
    "Maharashtra": "West",
    "Gujarat": "West",
    "Rajasthan": "North",
    "Delhi": "North",
    "Punjab": "North",
    "Karnataka": "South",
    "Tamil Nadu": "South",
    "Kerala": "South",
    "Telangana": "South",
    "West Bengal": "East",
    "Odisha": "East",
    "Bihar": "East",
    "Madhya Pradesh": "Central",
    "Uttar Pradesh": "Central",
}

# The landing catalogue's sub-categories.
LANDING_CATEGORIES = {
    "Electronics": ("Mobiles", "Laptops", "Accessories", "Audio"),
    "Fashion": ("Men", "Women", "Kids", "Footwear"),
    "Home": ("Furniture", "Kitchen", "Decor"),
    "Grocery": ("Staples", "Snacks", "Beverages"),
    "Beauty": ("Skincare", "Haircare", "Makeup"),
}


def lookup(c: Column, table: dict[str, str]) -> Column:
    """Value of a small fixed table, NULL when the key is unknown."""
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), c)


def region_of_state(state: Column) -> Column:
    return lookup(text(state), REGION_OF_STATE)


def category_of_subcategory(subcategory: Column) -> Column:
    """Category implied by a landing sub-category."""
    inverse = {sub: name for name, subs in LANDING_CATEGORIES.items() for sub in subs}
    return lookup(text(subcategory), inverse)


def price(c: Column) -> Column:
    """Decimal price from a number or from text with a rupee mark in front."""
    return number(F.regexp_replace(text(c), r"\A(?:Rs\.|₹)\s*", ""))


def quantity_class(c: Column) -> Column:
    """missing, return (negative), sale (positive), zero or malformed."""
    n = number(c)
    return (
        F.when(c.isNull(), "missing")
        .when(n < 0, "return")
        .when(n > 0, "sale")
        .when(n == 0, "zero")
        .otherwise("malformed")
    )


def line_amount(quantity: Column, unit_price: Column) -> Column:
    """Quantity times unit price, as money; NULL where it is beyond range."""
    return money(product(number(quantity), number(unit_price)))

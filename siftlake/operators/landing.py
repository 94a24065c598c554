"""Checks and repairs for landed tables."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import normalize
from ..functions.parsing import timestamp
from ..functions.predicates import blank, differs, not_matching, overflows
from ..functions.parsing import money, number


def late_arrivals(df: DataFrame, record_date: Column, landing_date: Column) -> DataFrame:
    """Rows whose own date lies before the day they landed, with the delay in days."""
    delay = F.datediff(landing_date, record_date)
    return df.withColumn("days_late", delay).where(F.col("days_late") > 0)


def normalize_price(df: DataFrame, column: str = "unit_price", output: str = "unit_price_number") -> DataFrame:
    """Add the decimal price; NULL marks text that is no price."""
    return df.withColumn(output, normalize.price(F.col(column)))


def quantity_triage(df: DataFrame, column: str = "quantity") -> DataFrame:
    """Rows per quantity class."""
    classes = df.select(normalize.quantity_class(F.col(column)).alias("quantity_class"))
    return classes.groupBy("quantity_class").agg(F.count(F.lit(1)).alias("count"))


def contact_gaps(df: DataFrame, email: str = "email", phone: str = "phone", phone_pattern: str | None = None) -> DataFrame:
    """Rows without an e-mail or without a usable phone, with one flag for each."""
    bad_phone = F.upper(F.trim(F.col(phone))).eqNullSafe(F.lit("N/A")) | blank(F.col(phone))
    if phone_pattern is not None:
        bad_phone = bad_phone | not_matching(F.col(phone), phone_pattern)
    flagged = df.withColumns({"missing_email": blank(F.col(email)), "missing_phone": bad_phone})
    return flagged.where(F.col("missing_email") | F.col("missing_phone"))


def backfill_category(df: DataFrame, category: str = "category", subcategory: str = "sub_category") -> DataFrame:
    """Fill a blank category from its sub-category where that is known."""
    filled = F.when(blank(F.col(category)), normalize.category_of_subcategory(F.col(subcategory)))
    return df.withColumn(category, filled.otherwise(F.col(category)))


def add_region(df: DataFrame, state: str = "state", output: str = "region") -> DataFrame:
    """Add the sales region of a state."""
    return df.withColumn(output, normalize.region_of_state(F.col(state)))


def line_total_mismatches(df: DataFrame, quantity: str, unit_price: str, total: str) -> DataFrame:
    """Lines whose stated total differs from quantity times unit price, with the computed amount.

    A computed amount beyond range is NULL and differs from every stated one.
    """
    computed = normalize.line_amount(F.col(quantity), F.col(unit_price))
    out = df.withColumn("computed_total", computed)
    stated = money(number(F.col(total)))
    beyond = overflows(number(F.col(quantity)), number(F.col(unit_price)), F.col("computed_total"))
    return out.where(differs(stated, F.col("computed_total")) | (stated.isNotNull() & beyond))


def parse_record_date(c: Column) -> Column:
    """Calendar day of a record's own date text."""
    return F.to_date(timestamp(c))

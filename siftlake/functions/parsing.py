"""Safe readers for text columns. Malformed text becomes NULL, never an error."""

from pyspark.sql import Column, functions as F

# Everything a regex calls white space; F.trim alone strips spaces only.
WHITESPACE = " \t\n\x0b\f\r"

# Values below 10^20 with ten places: wide and fine enough for amounts, their products and sums.
NUMBER = "decimal(30,10)"
MONEY = "decimal(38,2)"

# A full date, alone or with a time to the minute, second or fraction, and an offset.
ISO_TIMESTAMP = r"\A\d{4}-\d{2}-\d{2}(?:[ T]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)?\z"
OFFSET_TIMESTAMP = r"\A\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?(?:Z|[+-]\d{2}:?\d{2})\z"
ISO_DATE = r"\A\d{4}-\d{2}-\d{2}\z"


def text(c: Column) -> Column:
    """The value as text without surrounding spaces."""
    return F.trim(c.cast("string"))


def number(c: Column) -> Column:
    """Decimal value of a text or numeric column; NaN, infinities and bad text give NULL."""
    return c.try_cast(NUMBER)


def product(a: Column, b: Column) -> Column:
    """Product of two parsed numbers; NULL where it is beyond range, never an error."""
    return F.try_multiply(a, b)


def money(c: Column) -> Column:
    """Amount rounded half-up to two places."""
    return F.round(c, 2).cast(MONEY)


def timestamp(c: Column) -> Column:
    """Zone-free timestamp from ISO text; a bare date means midnight, a time with an offset is taken in UTC.

    The patterns keep out the year-only and year-month forms a plain cast would accept.
    """
    value = text(c)
    plain = F.when(value.rlike(ISO_TIMESTAMP), value).try_cast("timestamp_ntz")
    # An offset of hours and minutes shifts the local time written before it.
    zone = F.regexp_extract(value, r"(Z|[+-]\d{2}:?\d{2})\z", 1)
    local = F.when(value.rlike(OFFSET_TIMESTAMP), F.regexp_replace(value, r"(?:Z|[+-]\d{2}:?\d{2})\z", ""))
    minutes = F.when(zone == "Z", 0).otherwise(
        F.concat(F.substring(zone, 1, 1), F.lit("1")).try_cast("int")
        * (F.substring(zone, 2, 2).try_cast("int") * 60 + F.right(zone, F.lit(2)).try_cast("int"))
    )
    shifted = F.timestamp_add("MINUTE", -minutes, local.try_cast("timestamp_ntz"))
    return F.coalesce(plain, shifted)


def iso_date(c: Column) -> Column:
    """Date from text that is exactly yyyy-MM-dd."""
    value = text(c)
    return F.when(value.rlike(ISO_DATE), value).try_cast("date")


def code_number(c: Column, prefix: str, digits: int) -> Column:
    """Number behind a coded id such as C000042; NULL when the text is not exactly such a code."""
    value = c.cast("string")
    coded = value.rlike(rf"\A{prefix}[0-9]{{{digits}}}\z")
    return F.when(coded, F.substring(value, len(prefix) + 1, digits)).cast("bigint")


def instant(value) -> Column:
    """Literal processing instant from a date, datetime or ISO text."""
    return F.lit(str(value)).cast("timestamp_ntz")

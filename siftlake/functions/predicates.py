"""Predicate templates for rules. Every one is true for an invalid value and never NULL."""

from pyspark.sql import Column, functions as F

from .parsing import WHITESPACE, code_number, instant, text


def _known(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def blank(c: Column) -> Column:
    """NULL, empty or only white space."""
    return c.isNull() | (F.btrim(c.cast("string"), F.lit(WHITESPACE)) == "")


def not_in(c: Column, values, trim: bool = False) -> Column:
    """Outside a controlled vocabulary; NULL counts as outside."""
    value = text(c) if trim else c
    return ~_known(value.isin(*values))


def not_matching(c: Column, pattern: str) -> Column:
    """Trimmed text does not match; NULL counts as not matching. Anchor patterns with \\A and \\z."""
    return ~_known(text(c).rlike(pattern))


def given_but_not_matching(c: Column, pattern: str) -> Column:
    """Present text that does not match; NULL and blank are allowed."""
    return ~blank(c) & ~_known(text(c).rlike(pattern))


def not_equal(c: Column, constant: str) -> Column:
    """Trimmed text differs from a constant; NULL counts as different."""
    return ~text(c).eqNullSafe(F.lit(constant))


def out_of_range(n: Column, low=None, high=None, above=None) -> Column:
    """Not a number, below ``low``, above ``high``, or not greater than ``above``."""
    bad = n.isNull()
    if low is not None:
        bad = bad | (n < low)
    if high is not None:
        bad = bad | (n > high)
    if above is not None:
        bad = bad | (n <= above)
    return bad


def fractional(n: Column) -> Column:
    """A known number that is not whole."""
    return _known(n != F.floor(n))


def not_a_count(n: Column, low=None, above=None) -> Column:
    """Not a whole number in range."""
    return out_of_range(n, low=low, above=above) | fractional(n)


def bad_code(c: Column, prefix: str, digits: int, low: int | None = None, high: int | None = None) -> Column:
    """Not prefix + digits, or its number outside low..high."""
    n = code_number(c, prefix, digits)
    if low is not None and high is not None:
        return ~_known(n.between(low, high))
    if low is None and high is None:
        return n.isNull()
    return ~_known(n >= low if low is not None else n <= high)


def exceeds(a: Column, b: Column, or_equals: bool = False) -> Column:
    """a > b (or a >= b) when both are known."""
    return _known(a >= b if or_equals else a > b)


def disagrees(stated: Column, computed: Column, scale: int = 2) -> Column:
    """Two known amounts differ after rounding both to ``scale`` places."""
    return _known(F.round(stated, scale) != F.round(computed, scale))


def overflows(a: Column, b: Column, computed: Column) -> Column:
    """Two known numbers whose combination is beyond range, so that it came out NULL."""
    return a.isNotNull() & b.isNotNull() & computed.isNull()


def differs(a: Column, b: Column) -> Column:
    """Two known values differ exactly."""
    return _known(a != b)


def unparseable(parsed: Column) -> Column:
    """The parsed date or timestamp is missing."""
    return parsed.isNull()


def in_future(parsed: Column, as_of, grain: str = "timestamp") -> Column:
    """Later than the processing instant; grain "date" compares calendar days."""
    now = instant(as_of)
    if grain == "date":
        return _known(F.to_date(parsed) > F.to_date(now))
    return _known(parsed > now)


def required_when(status: Column, statuses, c: Column) -> Column:
    """Blank although the status demands a value."""
    return _known(status.isin(*statuses)) & blank(c)


def stock_status_conflict(available: Column, reorder: Column, status: Column) -> Column:
    """Stock status contradicts the available quantity and the reorder level."""
    empty = (available == 0) & (status != "Out of Stock")
    low = (available > 0) & (available <= reorder) & (status != "Low Stock")
    stocked = (available > reorder) & (status == "Out of Stock")
    return _known(empty) | _known(low) | _known(stocked)


def outside_taxonomy(category: Column, subcategory: Column, taxonomy: dict[str, tuple[str, ...]]) -> Column:
    """Subcategory not listed under its category, or the category itself unknown."""
    allowed = F.lit(False)
    for name, members in taxonomy.items():
        allowed = allowed | ((category == name) & subcategory.isin(*members))
    return ~_known(allowed)

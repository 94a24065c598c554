"""Reference checks against another table: existence, attributes, orphans, allowed pairs."""

from dataclasses import dataclass, field
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.predicates import blank, disagrees
from . import skew


def as_id(c: Column) -> Column:
    """An id as text. Outer spaces belong to it: marts join ids as they are stored."""
    return c.cast("string")


@dataclass(frozen=True)
class Lookup:
    """A left join to a reference table on an id, compared exactly.

    ``attributes`` maps output columns to expressions over the reference. ``found`` names the
    boolean column that tells whether the id exists there.
    """

    table: str
    column: str
    key: str
    found: str
    attributes: dict[str, Column] = field(default_factory=dict)


def reference_keys(ref: DataFrame, key: str, name: str = "_ref_key") -> DataFrame:
    """Distinct non-blank ids of a reference table."""
    return ref.where(~blank(F.col(key))).select(as_id(F.col(key)).alias(name)).distinct()


def _unique_reference(ref: DataFrame, lookup: Lookup, unique: bool) -> DataFrame:
    """One row per id, so that a repeated id cannot multiply rows."""
    names = list(lookup.attributes)
    rows = ref.where(~blank(F.col(lookup.key))).select(
        as_id(F.col(lookup.key)).alias("_ref_key"), *[c.alias(n) for n, c in lookup.attributes.items()]
    )
    if unique:
        return rows.withColumn(lookup.found, F.lit(True))
    if not names:
        return rows.distinct().withColumn(lookup.found, F.lit(True))
    picked = F.min(F.col(names[0]) if len(names) == 1 else F.struct(*names)).alias("_picked")
    grouped = rows.groupBy("_ref_key").agg(picked)
    attributes = [F.col("_picked").alias(names[0])] if len(names) == 1 else [F.col(f"_picked.{n}") for n in names]
    return grouped.select("_ref_key", *attributes, F.lit(True).alias(lookup.found))


def attach(
    df: DataFrame, ref: DataFrame, lookup: Lookup, hot: DataFrame | None = None, unique: bool = False,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Add the existence flag and the reference attributes to every row; no row is lost or repeated.

    ``hot`` may pass the hot ids when they are known from a cheaper frame than ``df``. ``unique``
    states that ids do not repeat in the reference, which saves one shuffle of it. ``spread_by`` names
    columns that tell rows of one id apart, for frames of which few columns are needed.
    """
    usable = F.when(~blank(F.col(lookup.column)), as_id(F.col(lookup.column)))
    if hot is None:
        hot = skew.hot_keys(df, usable)
    left = df.withColumn("_lookup_key", usable)
    out = skew.spread_lookup(left, _unique_reference(ref, lookup, unique), "_lookup_key", "_ref_key", hot, spread_by=spread_by)
    return out.withColumn(lookup.found, F.coalesce(F.col(lookup.found), F.lit(False))).drop("_lookup_key", "_ref_key")


def exists_flag(
    df: DataFrame, ref: DataFrame, column: str, key: str, flag: str = "ref_exists", broadcast_rows: int | None = None,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Flag rows whose id exists in the reference.

    With ``broadcast_rows`` the reference keys are counted first and broadcast when they are few enough.
    """
    if broadcast_rows is None:
        return attach(df, ref, Lookup("", column, key, flag), spread_by=spread_by)
    keys = reference_keys(ref, key).withColumn(flag, F.lit(True))
    side = skew.bounded_broadcast(keys, broadcast_rows)
    if side is keys:
        return attach(df, ref, Lookup("", column, key, flag), spread_by=spread_by)
    joined = df.join(side, as_id(df[column]) == side["_ref_key"], "left").drop("_ref_key")
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def orphans(
    df: DataFrame, ref: DataFrame, column: str, key: str, hot: DataFrame | None = None, spread_by: list[str] | None = None
) -> DataFrame:
    """Rows whose id does not exist in the reference, NULL and blank ids included."""
    usable = F.when(~blank(F.col(column)), as_id(F.col(column)))
    if hot is None:
        hot = skew.hot_keys(df, usable)
    left = df.withColumn("_lookup_key", usable)
    out = skew.spread_lookup(left, reference_keys(ref, key), "_lookup_key", "_ref_key", hot, "left_anti", spread_by)
    return out.drop("_lookup_key")


def outside_vocabulary(df: DataFrame, vocabulary: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose column combination is not listed in a vocabulary table with the same column names.

    One join on the typed values whatever the vocabulary's size; a NULL is never listed.
    """
    pairs = skew.bounded_broadcast(vocabulary.select(*columns).distinct())
    return df.join(pairs, columns, "left_anti")


def reconcile(
    df: DataFrame, ref: DataFrame, lookup: Lookup, stated: Column, expected: str, hot: DataFrame | None = None
) -> DataFrame:
    """Rows whose stated amount differs from the reference amount, or whose reference is missing."""
    joined = attach(df, ref, lookup, hot)
    return joined.where(F.col(expected).isNull() | disagrees(stated, F.col(expected)))

"""Duplicate flags and survivors by key, with an explicit arrival order.

Key statistics are aggregated first (copies collapse before the shuffle) and joined back with hot
keys spread, so no task ever holds all copies of one key.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.lake import materialize
from . import skew


def _names(value) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def _ordering(order_by: list[str]) -> list[Column]:
    """Fields that sort like the columns, NULL last."""
    fields = []
    for i, name in enumerate(order_by):
        fields += [F.col(name).isNull().alias(f"_unknown{i}"), F.col(name).alias(f"_order{i}")]
    return fields


def _rank(order_by: list[str]) -> Column:
    """Comparable arrival rank; a single column stays plain, so that its minimum is a hash aggregate."""
    return F.col(order_by[0]) if len(order_by) == 1 else F.struct(*_ordering(order_by))


def _repeated(df: DataFrame, keys: list[str], null_keys: str, *aggregates: Column, concerned: Column | None = None) -> DataFrame:
    if null_keys == "distinct":
        df = df.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    elif null_keys != "equal":
        raise ValueError(f"null_keys must be 'distinct' or 'equal', not {null_keys!r}")
    grouped = df.groupBy(*[F.col(k).alias(f"_dup_key{i}") for i, k in enumerate(keys)])
    if concerned is None:
        return grouped.agg(F.count(F.lit(1)).alias("_copies"), *aggregates).where("_copies > 1")
    out = grouped.agg(F.count(F.lit(1)).alias("_copies"), *aggregates, F.max(concerned).alias("_concerned"))
    return out.where("_copies > 1 AND _concerned").drop("_concerned")


def _equal(left: DataFrame, right: DataFrame, keys: list[str], names: list[str], null_keys: str) -> list[Column]:
    if null_keys == "equal":
        return [left[k].eqNullSafe(right[n]) for k, n in zip(keys, names)]
    return [left[k] == right[n] for k, n in zip(keys, names)]


def _attach(
    df: DataFrame, repeated: DataFrame, keys: list[str], null_keys: str, broadcast_rows: int | None, spread_by=None
) -> DataFrame:
    names = [f"_dup_key{i}" for i in range(len(keys))]
    # Stored: the statistics are aggregated once, and Spark joins the table by its size.
    repeated = materialize(repeated, "repeated-keys")
    if broadcast_rows is not None:
        # Few repeated keys: the rows themselves need no shuffle at all.
        side = skew.bounded_broadcast(repeated, broadcast_rows)
        if side is not repeated:
            return df.join(side, _equal(df, side, keys, names, null_keys), "left").drop(*names)
    is_hot = F.col("_copies") >= skew.HOT_ROWS
    n_buckets = skew.buckets(F.col("_copies"))
    # At most total rows / HOT_ROWS keys are hot. Stored apart: as a part of the repeated keys they would be joined by
    # the size of all of those, for which every row is shuffled once more.
    hot = repeated.where(is_hot).select(*[F.col(n).alias(f"_hot{n}") for n in names], n_buckets.alias("_buckets"))
    hot = skew.stored(hot, "hot-repeated")
    marked = df.join(hot, _equal(df, hot, keys, [f"_hot{n}" for n in names], null_keys), "left")
    joined = skew.spread_join(
        marked.drop(*[f"_hot{n}" for n in names]),
        repeated,
        list(zip(keys, names)),
        left_buckets=F.col("_buckets"),
        right_buckets=F.when(is_hot, n_buckets).otherwise(1),
        null_safe=null_keys == "equal",
        spread_by=spread_by,
    )
    return joined.drop(*names, "_buckets")


def flag_later_copies(
    df: DataFrame,
    keys,
    order_by,
    flag: str = "_duplicate",
    null_keys: str = "distinct",
    broadcast_rows: int | None = None,
    copies_of: DataFrame | None = None,
    concerned: Column | None = None,
) -> DataFrame:
    """Add a boolean column that is true for every copy of a key after its first.

    ``order_by`` must order the copies of a key totally (``order_ties`` finds violations).
    ``null_keys="distinct"`` never calls a row with a NULL key a duplicate; ``"equal"`` treats NULL
    keys as one key. With ``broadcast_rows`` the repeated keys are found and counted first, and
    broadcast when they are few enough. ``copies_of`` is the frame whose copies count, if ``df`` is a part of it
    or has further columns; ``concerned`` tells which of its rows ``df`` may hold, and keys without such a row are left out.
    The order tells rows of a key apart, so that it alone spreads those of a hot one.
    """
    keys, order_by = _names(keys), _names(order_by)
    rank = _rank(order_by)
    repeated = _repeated(df if copies_of is None else copies_of, keys, null_keys, F.min(rank).alias("_first"), concerned=concerned)
    out = _attach(df, repeated, keys, null_keys, broadcast_rows, order_by)
    # A row of unknown rank comes after every ranked copy of its key.
    later = F.coalesce(rank > F.col("_first"), F.col("_first").isNotNull())
    return out.withColumn(flag, later).drop("_first", "_copies")


def flag_all_copies(
    df: DataFrame, keys, flag: str = "_duplicate", null_keys: str = "equal", broadcast_rows: int | None = None,
    copies_of: DataFrame | None = None, spread_by: list[str] | None = None, concerned: Column | None = None,
) -> DataFrame:
    """Add a boolean column that is true for every copy of a repeated key, the first included.

    ``spread_by`` names columns that tell rows of one key apart, for frames of which few columns are needed.
    ``copies_of`` and ``concerned`` as for ``flag_later_copies``.
    """
    keys = _names(keys)
    repeated = _repeated(df if copies_of is None else copies_of, keys, null_keys, concerned=concerned)
    out = _attach(df, repeated, keys, null_keys, broadcast_rows, spread_by)
    return out.withColumn(flag, F.col("_copies").isNotNull()).drop("_copies")


# Copies of one row that one task puts out.
COPIES = 1_000_000


def digest(columns) -> Column:
    """256 bits of a whole row: each value as text behind its length, NULL marked, so that no two rows look alike.

    The columns must have types that a cast to text writes in full.
    """
    framed = []
    for name in columns:
        value = F.col(name).cast("string")
        framed.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*framed).cast("binary"), 256)


def flag_resends(
    df: DataFrame, keys, flag: str = "_duplicate", null_keys: str = "distinct", order_by=()
) -> DataFrame:
    """``flag_later_copies`` for rows that may be resent as they are, or arrive at one time or at none.

    Exact copies are aggregated into one row with their number first. Copies of a key that differ are
    told apart by ``order_by`` and then by ``digest`` of the row, a total order, so that exactly one of all
    is not flagged. Copies are then put out again, those of a row with more than ``COPIES`` by several tasks.
    """
    keys, order_by = _names(keys), _names(order_by)
    columns = df.columns
    # Copies of one row collapse before the shuffle, however many there are.
    once = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_resent"))
    once = materialize(once.withColumn("_row_digest", digest(columns)), "distinct-rows")
    found = flag_later_copies(once, keys, [*order_by, "_row_digest"], flag, null_keys).drop("_row_digest")

    few = found.where(F.col("_resent") <= COPIES).withColumn("_from", F.lit(1).cast("bigint"))
    starts = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_resent"), F.lit(COPIES).cast("bigint")))
    many = found.where(F.col("_resent") > COPIES).select("*", starts.alias("_from"))
    # An explicit number: the few narrow rows would be put back into one task by their size, and grow there.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = many.repartition(tasks, "_from", *keys)
    last = F.least(F.col("_resent"), F.col("_from") + COPIES - 1)
    spread = few.unionByName(many).select("*", F.explode(F.sequence("_from", last)).alias("_copy"))
    repeated = F.col("_copy") > 1
    if null_keys == "distinct":
        repeated = repeated & reduce(and_, [F.col(k).isNotNull() for k in keys])
    return spread.withColumn(flag, F.col(flag) | repeated).select(*columns, flag)


def keep_first(df: DataFrame, keys, order_by, null_keys: str = "distinct") -> DataFrame:
    """One row per key, the lowest by ``order_by``, in a single aggregation.

    Rows with a NULL key are all kept, unless ``null_keys="equal"`` treats them as one key.
    """
    keys, order_by = _names(keys), _names(order_by)
    if null_keys not in ("distinct", "equal"):
        raise ValueError(f"null_keys must be 'distinct' or 'equal', not {null_keys!r}")
    rest = [c for c in df.columns if c not in keys]
    first = F.min(F.struct(*_ordering(order_by), *rest)).alias("_row")
    groups = [F.col(k) for k in keys]
    if null_keys == "distinct":
        known = reduce(and_, [F.col(k).isNotNull() for k in keys])
        groups.append(F.when(~known, F.monotonically_increasing_id()).alias("_own"))
    out = df.groupBy(*groups).agg(first)
    return out.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def drop_exact_copies(df: DataFrame) -> DataFrame:
    """Remove rows that repeat another row in every column (a resent record)."""
    return df.dropDuplicates()


def order_ties(df: DataFrame, keys, order_by) -> DataFrame:
    """Keys whose arrival order is not total: several copies share one order value."""
    columns = _names(keys) + _names(order_by)
    return df.groupBy(*columns).count().where("count > 1")

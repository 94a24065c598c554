"""Joins that stay balanced when one key holds a large share of the rows.

The rows of a hot key are spread over several join buckets and the matching row of the other side
is repeated once per bucket, so results are those of the plain join.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.lake import materialize

# Rows one task takes comfortably. A key with more is hot and gets one bucket per HOT_ROWS rows, so
# hot keys and repeated rows together stay below 2 * total rows / HOT_ROWS.
HOT_ROWS = 1_000_000


def buckets(rows: Column) -> Column:
    """Number of join buckets for a key with that many rows."""
    return F.ceil(rows / F.lit(HOT_ROWS)).cast("int")


# Groups of keys that are counted first, by a hash of the key.
SLOTS = 1 << 16


def stored(hot: DataFrame, name: str) -> DataFrame:
    """The few hot keys as a table of their own, which Spark joins by its own size; where there are none, an empty
    relation that drops out of every plan."""
    table = materialize(hot, name)
    return table.where(F.lit(False)) if table.isEmpty() else table


def hot_keys(df: DataFrame, key: Column) -> DataFrame:
    """All keys with at least HOT_ROWS rows, as a table (hot_key, buckets).

    Exact counts from narrow passes, aggregated before the shuffle. The first counts slots of keys, a fixed number: no
    key of a slot with fewer rows is hot, so that the second, over single keys, reads few rows or does not run. The
    table has at most total rows / HOT_ROWS rows; it is stored, so that both sides of a join read the same one and
    Spark decides by its size how to join it.
    """
    keys = df.select(key.alias("hot_key")).where(F.col("hot_key").isNotNull())
    slot = F.pmod(F.xxhash64("hot_key"), F.lit(SLOTS))
    slots = keys.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= HOT_ROWS)
    slots = stored(slots.select("_slot"), "hot-slots")
    counts = keys.join(slots, slot == F.col("_slot"), "left_semi").groupBy("hot_key")
    hot = counts.agg(buckets(F.count(F.lit(1))).alias("buckets"), F.count(F.lit(1)).alias("rows"))
    return stored(hot.where(F.col("rows") >= HOT_ROWS).select("hot_key", "buckets"), "hot-keys")


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    left_buckets: Column,
    right_buckets: Column,
    how: str = "left",
    null_safe: bool = False,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Equi-join with the rows of hot keys spread over buckets.

    ``on`` pairs left and right column names; right names must not repeat left ones. The bucket
    columns give the number of buckets of the row's key and must agree for equal keys. Left rows
    with a NULL key match nothing (unless ``null_safe``) and are spread as well.

    The bucket of a left row is a hash of its columns (or of those in ``spread_by``, where reading all
    would be waste and these differ within a key) and its partition number: stable when a task is
    repeated, even within a partition that holds one key only, and different for copies in different
    partitions.
    """
    row = F.xxhash64(*(spread_by or left.columns), F.spark_partition_id())
    bucket = F.when(left_buckets > 1, F.pmod(row, left_buckets))
    if not null_safe:
        for name, _ in on:
            bucket = bucket.when(F.col(name).isNull(), F.pmod(row, F.lit(1 << 20)))
    left = left.withColumn("_bucket", bucket.otherwise(0).cast("int"))

    numbers = F.when(right_buckets > 1, F.sequence(F.lit(0), right_buckets - 1)).otherwise(F.array(F.lit(0)))
    right = right.select("*", F.explode(numbers).alias("_right_bucket"))

    cond = [left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b] for a, b in on]
    cond.append(left["_bucket"] == right["_right_bucket"])
    return left.join(right, cond, how).drop("_bucket", "_right_bucket")


def with_buckets(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Add ``_buckets``: the number of buckets of a hot key, NULL for any other."""
    return df.join(hot.select("hot_key", F.col("buckets").alias("_buckets")), df[key] == F.col("hot_key"), "left").drop("hot_key")


def spread_lookup(
    left: DataFrame, right: DataFrame, key: str, ref: str, hot: DataFrame, how: str = "left",
    spread_by: list[str] | None = None,
) -> DataFrame:
    """``spread_join`` on one key whose hot values are known."""
    right = with_buckets(right, ref, hot).withColumnRenamed("_buckets", "_right_buckets")
    out = spread_join(
        with_buckets(left, key, hot), right, [(key, ref)], F.col("_buckets"), F.col("_right_buckets"), how,
        spread_by=spread_by,
    )
    return out.drop("_buckets", "_right_buckets")


def bounded_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast hint for a side checked to have at most ``max_rows`` rows; otherwise unchanged."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df

"""Exact distinct counts that can be added up: bitmaps of whole-number ids per day.

A bitmap holds 32,768 consecutive ids, so (day, bucket of ids) is one row of at most 4 KB, however often an id
occurs. Weeks, months and everything are the union of the days' bitmaps; the rows themselves are read once.
Suited to ids that lie close together; very sparse ids take one bitmap each.
"""

from pyspark.sql import Column, DataFrame, functions as F

GRAINS = ("day", "week", "month", "all")


def daily_bitmaps(df: DataFrame, day: Column, number: Column) -> DataFrame:
    """day, bucket, bitmap. Rows without a day or an id are left out; a day's copies collapse before the shuffle."""
    rows = df.select(day.cast("date").alias("day"), number.cast("bigint").alias("_id")).where(F.col("day").isNotNull() & F.col("_id").isNotNull())
    bit = F.bitmap_construct_agg(F.bitmap_bit_position("_id"))
    return rows.groupBy("day", F.bitmap_bucket_number("_id").alias("bucket")).agg(bit.alias("bitmap"))


def period(grain: str, day: str = "day") -> Column:
    """First day of the period a day lies in, as text; ``all`` for everything."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}, expected one of {GRAINS}")
    if grain == "all":
        return F.lit("all")
    return F.date_format(F.col(day) if grain == "day" else F.trunc(day, grain), "yyyy-MM-dd")


def merged(bitmaps: DataFrame, grain: str) -> DataFrame:
    """period, bucket, bitmap of a coarser grain; may be merged again with others of the same grain."""
    return bitmaps.groupBy(period(grain).alias("period"), "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def uniques(bitmaps: DataFrame, grains=GRAINS, name: str = "uniques") -> DataFrame:
    """grain, period and number of distinct ids for several grains from one table of daily bitmaps."""
    at = F.explode(F.array(*[F.struct(F.lit(g).alias("grain"), period(g).alias("period")) for g in grains])).alias("at")
    union = bitmaps.select(at, "bucket", "bitmap").groupBy("at.grain", "at.period", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return union.groupBy("grain", "period").agg(F.sum(F.bitmap_count("bitmap")).alias(name))

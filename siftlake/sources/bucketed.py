"""Tables bucketed by a key: joins and sums by that key need no shuffle."""

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..operators import skew
from .lake import new_path

ROWS_PER_BUCKET = 2_000_000


@dataclass(frozen=True)
class Bucketed:
    """``rows`` lie in buckets of their key. ``rest`` holds the rows of NULL keys and of keys with too many rows
    for one bucket, in no order; None where there are none."""

    rows: DataFrame
    rest: DataFrame | None
    key: str
    buckets: int


def bucket_count(rows: int) -> int:
    """Buckets for a table of that many rows; tables to be joined share the number of the largest."""
    return max(8, -(-rows // ROWS_PER_BUCKET))


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> Bucketed:
    """Write a frame, best a stored one, as an external table with sorted buckets in the shared folder.

    One shuffle by the key; each bucket is one file. The table stays registered in the session's catalog.
    """
    spark = df.sparkSession
    hot = skew.hot_keys(df, F.col(key)).select(F.col("hot_key").alias("_hot"))
    apart = hot.count()  # a stored table of at most rows / HOT_ROWS rows
    without = df.where(F.col(key).isNull()).count()
    rows = df.where(F.col(key).isNotNull())
    rest = None
    if apart:
        rest = df.join(hot, F.col(key) == F.col("_hot"), "left_semi").unionByName(df.where(F.col(key).isNull()))
        rows = rows.join(hot, F.col(key) == F.col("_hot"), "left_anti")
    elif without:
        rest = df.where(F.col(key).isNull())
    table = f"{name}_{uuid.uuid4().hex}"
    writer = rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    writer.option("path", new_path(spark, name)).saveAsTable(table)
    return Bucketed(spark.table(table), rest, key, buckets)

"""Hot keys: spread joins and duplicate flags give the plain result and really spread."""

import pytest
from pyspark.sql import Window, functions as F

from siftlake.operators import dedup, refs, skew


@pytest.fixture()
def low_threshold(monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 50)


def hot_table(spark, n=3000):
    """A third of the rows share one key, a tenth have none, some are blank."""
    k = F.col("id")
    key = (
        F.when(k % 3 == 0, "hot")
        .when(k % 10 == 1, F.lit(None))
        .when(k % 10 == 2, " ")
        .otherwise(F.concat(F.lit("k"), (k % 700).cast("string")))
    )
    return spark.range(0, n, numPartitions=8).select(k.alias("seq"), key.alias("key"))


def same_rows(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_every_hot_key_is_found(spark, low_threshold):
    found = {r.hot_key: r.buckets for r in skew.hot_keys(hot_table(spark), F.col("key")).collect()}
    assert found["hot"] == 20
    many = spark.range(0, 200 * 120, numPartitions=8).select((F.col("id") % 200).alias("key"))
    found = skew.hot_keys(many, F.col("key")).collect()
    assert len(found) == 200 and {r.buckets for r in found} == {3}


def test_no_hot_key_in_uniform_data(spark):
    assert skew.hot_keys(hot_table(spark), F.col("key")).isEmpty()


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_spread_join_equals_plain_join(spark, low_threshold, how):
    left = hot_table(spark)
    right = left.where("seq % 2 = 0").select(F.col("key").alias("ref")).distinct().withColumn("v", F.length("ref"))
    hot = skew.hot_keys(left, F.col("key"))
    got = skew.spread_lookup(left, right, "key", "ref", hot, how)
    same_rows(got, left.join(right, F.col("key") == F.col("ref"), how))


@pytest.mark.parametrize("by", ["seq", "key"])
def test_hot_rows_are_spread_over_tasks(spark, monkeypatch, by):
    """Also where all rows of the hot key come from one partition."""
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    left = hot_table(spark).where("key = 'hot'").repartition(8, by)
    right = spark.createDataFrame([("hot", 1)], "ref string, v int")
    hot = skew.hot_keys(left, F.col("key"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.spread_lookup(left, right, "key", "ref", hot)
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(sizes) == n and max(r["count"] for r in sizes) <= 2 * 1000 / n
    assert sum(r["count"] for r in sizes) == 1000


@pytest.mark.parametrize("null_keys", ["distinct", "equal"])
def test_later_copies_equal_row_number(spark, low_threshold, null_keys):
    df = hot_table(spark)
    got = dedup.flag_later_copies(df, "key", "seq", "dup", null_keys)
    later = F.row_number().over(Window.partitionBy("key").orderBy("seq")) > 1
    if null_keys == "distinct":
        later = later & F.col("key").isNotNull()
    same_rows(got, df.withColumn("dup", later))
    for rows in (10_000, 10):
        same_rows(dedup.flag_later_copies(df, "key", "seq", "dup", null_keys, broadcast_rows=rows), got)


def test_later_copies_with_two_keys_and_two_order_columns(spark, low_threshold):
    df = hot_table(spark).select("key", (F.col("seq") % 2).alias("part"), (F.col("seq") % 5).alias("a"), F.col("seq").alias("b"))
    got = dedup.flag_later_copies(df, ["key", "part"], ["a", "b"], "dup")
    later = F.row_number().over(Window.partitionBy("key", "part").orderBy("a", "b")) > 1
    same_rows(got, df.withColumn("dup", later & F.col("key").isNotNull()))


@pytest.mark.parametrize("null_keys", ["distinct", "equal"])
def test_all_copies_equal_window_count(spark, low_threshold, null_keys):
    df = hot_table(spark)
    got = dedup.flag_all_copies(df, "key", "dup", null_keys)
    n = F.count(F.lit(1) if null_keys == "equal" else F.col("key")).over(Window.partitionBy("key"))
    same_rows(got, df.withColumn("dup", n > 1))
    same_rows(dedup.flag_all_copies(df, "key", "dup", null_keys, broadcast_rows=10_000), got)


def test_keep_first_and_exact_copies(spark):
    df = hot_table(spark)
    first = df.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("seq"))).where("n = 1").drop("n")
    first = first.where("key is not null").union(df.where("key is null"))
    same_rows(dedup.keep_first(df, "key", "seq"), first)
    assert dedup.keep_first(df, "key", "seq", null_keys="equal").where("key is null").count() == 1
    assert dedup.drop_exact_copies(df.unionByName(df)).count() == df.count()


def test_unknown_arrival_comes_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 7, 3), ("b", None, 4)], "k string, seq int, id int")
    assert {r.id for r in dedup.flag_later_copies(df, "k", "seq").where("not _duplicate").collect()} == {2, 4}
    assert {r.id for r in dedup.flag_later_copies(df, "k", ["seq", "id"]).where("not _duplicate").collect()} == {2, 4}
    assert {r.id for r in dedup.keep_first(df, "k", "seq").collect()} == {2, 4}


def test_order_ties(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1)], "key string, seq int")
    assert [tuple(r) for r in dedup.order_ties(df, "key", "seq").collect()] == [("a", 1, 2)]


def test_lookup_never_multiplies_or_loses_rows(spark, low_threshold):
    df = hot_table(spark)
    ref = spark.createDataFrame([("hot", 2), (" hot ", 1), ("k4", 7), (None, 9), (" ", 9)], "ref string, v int")
    lookup = refs.Lookup("r", "key", "ref", "found", {"v": F.col("v")})
    out = refs.attach(df, ref, lookup)
    assert out.count() == df.count()
    got = {(r.key, r.v, r.found) for r in out.select("key", "v", "found").distinct().collect()}
    assert ("hot", 2, True) in got and ("k4", 7, True) in got
    assert (None, None, False) in got and (" ", None, False) in got
    assert len({k for k, _, _ in got}) == len(got)


def test_exists_flag_and_orphans(spark, low_threshold):
    df = hot_table(spark)
    ref = spark.createDataFrame([("hot",), ("k4",), ("k5",)], "ref string")
    flagged = refs.exists_flag(df, ref, "key", "ref")
    same_rows(flagged, refs.exists_flag(df, ref, "key", "ref", broadcast_rows=10))
    same_rows(flagged, refs.exists_flag(df, ref, "key", "ref", broadcast_rows=2))
    same_rows(refs.orphans(df, ref, "key", "ref"), flagged.where("not ref_exists").drop("ref_exists"))


def test_broadcast_is_checked(spark):
    small, large = spark.range(5), spark.range(50)
    assert skew.bounded_broadcast(large, 10) is large
    assert skew.bounded_broadcast(small, 10) is not small


def test_unique_reference_gives_the_same_lookup(spark, low_threshold):
    df = hot_table(spark)
    ref = spark.createDataFrame([("hot", 1), ("k4", 7), ("k5", 8)], "ref string, v int")
    lookup = refs.Lookup("r", "key", "ref", "found", {"v": F.col("v")})
    same_rows(refs.attach(df, ref, lookup, unique=True), refs.attach(df, ref, lookup))
    bare = refs.Lookup("r", "key", "ref", "found")
    same_rows(refs.attach(df, ref, bare, unique=True), refs.attach(df, ref, bare))


def test_vocabulary_beyond_the_broadcast_bound(spark, low_threshold, monkeypatch):
    df = hot_table(spark).withColumn("part", (F.col("seq") % 2).cast("string"))
    words = spark.createDataFrame([("hot", "0"), ("k4", "0"), (None, "1")], "key string, part string")
    small = refs.outside_vocabulary(df, words, ["key", "part"]).select("seq", "key", "part")
    monkeypatch.setattr(skew, "bounded_broadcast", lambda side, max_rows=0: side)
    same_rows(refs.outside_vocabulary(df, words, ["key", "part"]).select("seq", "key", "part"), small)
    assert small.count() == df.where("key is null or not (part = '0' and key in ('hot', 'k4'))").count()


@pytest.mark.parametrize("bound", [0, 100_000])
def test_vocabulary_of_any_type_and_size(spark, monkeypatch, bound):
    values = "timestamp '2020-01-01 00:00:00.000001', -0.0D, 1.50BD", "timestamp '2020-01-01', 0.0D, 1.5BD", "null, 1D, 2BD"
    df = spark.sql(" union all ".join(f"select {v}" for v in values)).toDF("t", "d", "m")
    words = spark.sql("select timestamp '2020-01-01 00:00:00.000001', 0.0D, 1.5BD union all select null, 1D, 2BD").toDF("t", "d", "m")
    monkeypatch.setattr(skew, "bounded_broadcast", lambda side, max_rows=bound: side if not bound else F.broadcast(side))
    left = refs.outside_vocabulary(df, words, ["t", "d", "m"]).collect()
    assert sorted(str(r.t) for r in left) == ["2020-01-01 00:00:00", "None"]


@pytest.mark.parametrize("order_by", [(), "seq"])
def test_resends_leave_one_row_of_each_key(spark, low_threshold, order_by):
    """Whole-row copies, equal and unknown arrivals: all but one copy of a known key are flagged."""
    df = hot_table(spark).withColumn("seq", F.when(F.col("seq") % 4 > 0, F.lit(1)))
    df = df.union(df.where("key = 'hot'")).union(df.where("key = 'k4'"))
    out = dedup.flag_resends(df, "key", "dup", order_by=order_by)
    same_rows(out.drop("dup"), df)
    kept = {r.key: r["count"] for r in out.where("not dup").groupBy("key").count().collect()}
    assert {v for k, v in kept.items() if k is not None} == {1}
    assert set(kept) == {r.key for r in df.select("key").distinct().collect()} and kept[None] == df.where("key is null").count()


def test_copies_that_differ_in_the_place_of_a_null(spark):
    rows = [("k", "x", None), ("k", None, "x"), ("k", None, "x"), ("m", "1:a", "b"), ("m", "1", "a:b"), (None, None, "x"), (None, "x", None)]
    df = spark.createDataFrame(rows, "key string, a string, b string")
    out = dedup.flag_resends(df, "key", "dup")
    same_rows(out.drop("dup"), df)
    kept = [r.key for r in out.where("not dup").collect()]
    assert sorted(map(str, kept)) == ["None", "None", "k", "m"]
    digests = df.distinct().select(dedup.digest(df.columns).alias("d")).distinct()
    assert digests.count() == df.distinct().count()


def test_many_copies_of_one_row_are_put_out_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(dedup, "COPIES", 10)
    df = spark.range(35).select(F.lit("k").alias("key"), F.lit("x").alias("a"))
    df = df.union(spark.createDataFrame([("k", "y"), ("m", "x"), ("m", "x"), (None, "x")], "key string, a string"))
    out = dedup.flag_resends(df, "key", "dup")
    same_rows(out.drop("dup"), df)
    assert sorted(str(r.key) for r in out.where("not dup").collect()) == ["None", "k", "m"]
    tasks = out.where("key = 'k' and a = 'x'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 1

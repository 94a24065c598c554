"""Registered queries that write tables and files to the shared folder and read them back."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.parsing import timestamp
from ..operators import report, uniques, validate as dq
from ..plans import flow, marts
from ..sources import landing
from ..sources.bucketed import bucket_count, write_bucketed
from ..sources.lake import ISSUE, Lake, materialize, new_path
from ..sources.tables import read_table as table
from .queries import MART_COLUMNS, Silver, labelled, plain, prepared, ruleset
from .views import ORDER_BY, spark_view

MONTH = "order_month"


def month(column: str) -> Column:
    """First day of the month of a text date; NULL where it is none."""
    return F.trunc(timestamp(F.col(column)), "month")


def new_lake(spark: SparkSession, name: str) -> Lake:
    return Lake(spark, new_path(spark, name))


def _layers(lake: Lake, entity: str, *columns: str) -> DataFrame:
    """Rows of silver and quarantine with their layer and label."""
    silver = lake.read("silver", entity).select(F.lit("silver").alias("layer"), *columns, F.lit(None).cast("string").alias(ISSUE))
    return plain(silver.unionByName(lake.read("dq", entity).select(F.lit("dq").alias("layer"), *columns, ISSUE)))


def layers_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from raw through bronze to both layers, partitioned by month, written once and read back."""
    lake = new_lake(spark, "layers")
    lake.write(spark_view(spark, sf_dir, "orders"), "raw", "orders")
    lake.copy("orders")
    flow.promote(
        lake, ruleset("orders"), order_by="ingest_seq", extra_columns=ORDER_BY["orders"], partition={MONTH: month("order_date")},
        amounts=("subtotal_amount", "total_amount"),
    )
    return _layers(lake, "orders", "ingest_seq", "order_id", MONTH)


def promotion_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of payments by rule and the layer checks, all observed while both layers are written."""
    lake = new_lake(spark, "checks")
    for entity in ("orders", "payments"):
        lake.write(spark_view(spark, sf_dir, entity), "raw", entity)
        lake.copy(entity)
    flow.promote(lake, ruleset("orders"), order_by="ingest_seq")
    references = {"orders": lake.read("silver", "orders")}
    done = flow.promote(lake, ruleset("payments"), references, "ingest_seq", unique_references=True, amounts=("amount",))
    found = {"total_rows": done.total, "invalid_rows": done.invalid, **done.checks}
    found |= {f"rule_{label}": n for label, n in done.rule_counts.items()}
    return spark.createDataFrame(sorted(found.items()), "measure string, violations long")


# Two months get late records; the first delivery of the second day is wrong and sent again.
LATE_MONTHS, WRONG_MONTH = ("1995-03", "1996-07"), "1994-05"


def daily_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of two landing days, the second one sent twice: a full run, then refreshes of the touched months."""
    rules, period = ruleset("orders"), {MONTH: month("order_date")}
    view = spark_view(spark, sf_dir, "orders")
    in_month = F.coalesce(F.date_format(month("order_date"), "yyyy-MM"), F.lit(""))
    late = (F.col("ingest_seq") % 11 == 0) & in_month.isin(*LATE_MONTHS)
    lake = new_lake(spark, "refresh")
    flow.land(lake, rules, view.where(~late), "2000-01-01", period, changes=False)
    flow.promote(lake, rules, order_by="ingest_seq", extra_columns=ORDER_BY["orders"], partition=(MONTH,))
    # Wrong: unknown states, and orders of another month that landed the day before.
    second = materialize(view.where(late | ((F.col("ingest_seq") % 7 == 0) & (in_month == WRONG_MONTH))), "second-day")
    wrong = second.withColumn("order_status", F.lit("lost")).withColumn("ingest_seq", -F.col("ingest_seq"))
    for delivery in (wrong, second.where(late)):
        changed = flow.land(lake, rules, delivery, "2000-01-02", period)
        flow.refresh(lake, rules, changed, MONTH, order_by="ingest_seq", extra_columns=ORDER_BY["orders"])
    return _layers(lake, "orders", "ingest_seq", "order_id", MONTH)


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """JSON Lines of all orders, one folder a year: fields appear over the years, a total turns into text, lines break."""
    c = F.col
    orders = table(spark, sf_dir, "orders")
    year, key = F.year("o_orderdate"), c("o_orderkey")
    gift = F.when((year >= 1995) & (key % 3 == 0), F.struct((key % 2 == 0).alias("wrap"), F.concat(F.lit("note "), key).alias("note")))
    total = F.when(year < 1997, c("o_totalprice").cast("decimal(18,2)").cast("string"))
    as_text = F.when(year >= 1997, F.concat(F.lit("Rs."), c("o_totalprice").cast("decimal(18,2)").cast("string")))
    record = F.to_json(F.struct(
        key.alias("order_id"), total.cast("decimal(18,2)").alias("total"), as_text.alias("total_text"), gift.alias("gift"),
        F.when(year >= 1996, c("o_orderpriority")).alias("priority"),
    ))
    # The later text is a value of the same field.
    record = F.regexp_replace(record, "total_text", "total")
    broken = F.when(key % 97 == 0, F.concat(F.lit('{"order_id":'), key)).when(key % 89 == 0, F.concat(F.lit('{"order_id":1,"order_id":'), key, F.lit("}")))
    line = F.coalesce(broken, F.when(key % 83 == 0, F.concat(F.lit("["), key, F.lit("]"))), record)
    day = F.date_format(F.trunc("o_orderdate", "year"), "yyyy-MM-dd")
    path = new_path(spark, "landing")
    orders.select(line.alias("value"), day.alias("order_date")).write.partitionBy("order_date").text(path)
    return path


KNOWN = {"order_id": ("$.order_id", "bigint"), "total": ("$.total", "decimal(18,2)")}
LEARNED = {"total_text": ("$.total", "string"), "gift_note": ("$.gift.note", "string"), "gift_wrap": ("$.gift.wrap", "boolean"), "priority": ("$.priority", "string")}


def landing_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed records stored with all their fields; those the schema learns later come from the stored table."""
    records = landing.read_json_records(spark, _landed(spark, sf_dir))
    bronze = materialize(landing.extract(records, KNOWN), "records")
    rows = landing.extract(bronze, LEARNED).withColumn("total_text", F.when(F.col("total").isNull(), F.col("total_text")))
    return plain(rows.select(*KNOWN, *LEARNED, landing.CORRUPT, landing.LANDING_DATE))


def landing_unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the landed records that the schema does not know."""
    return landing.record_fields(landing.read_json_records(spark, _landed(spark, sf_dir)), list(KNOWN))


def drift_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in files of three years' types: a count as int, bigint and text, a price as float number and text, a new column."""
    c = F.col
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    key, price = c("o_orderkey"), c("o_totalprice").cast("decimal(18,2)")
    text = F.when(key % 53 == 0, F.lit("many")).when(key % 59 == 0, F.lit("1.5")).otherwise(F.concat(F.lit(" "), (key * 10).cast("string")))
    path = new_path(spark, "drift")
    batches = (
        (c("year") < 1994, key.cast("int"), price.cast("decimal(12,2)"), ()),
        ((c("year") >= 1994) & (c("year") < 1997), key + F.lit(10_000_000_000), price.cast("decimal(14,4)"), ()),
        (c("year") >= 1997, text, F.when(key % 61 == 0, F.lit("free")).otherwise(price.cast("string")), (c("o_orderpriority").alias("priority"),)),
    )
    for i, (part, count, cost, more) in enumerate(batches):
        orders.where(part).select(key.alias("id"), count.alias("units"), cost.alias("price"), *more).write.parquet(f"{path}/batch={i}")
    rows = landing.read_drifting_types(spark, path)
    bad = F.col(landing.UNREADABLE)
    return plain(rows.select("id", "units", "price", "priority", bad["units"].alias("bad_units"), bad["price"].alias("bad_price")))


def c360_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer mart from silver tables bucketed by order id."""
    names = ("orders", "order_items", "payments")
    silver = Silver(spark, sf_dir, shared=names, columns=MART_COLUMNS)
    buckets = bucket_count(max(silver[name].count() for name in names))
    tables = [write_bucketed(silver[name], f"silver_{name}", "order_id", buckets) for name in names]
    return plain(marts.customer_360_bucketed(silver["customers"], *tables))


def uniques_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers of a day, week, month and of all days, from daily bitmaps stored once."""
    orders = table(spark, sf_dir, "orders")
    daily = materialize(uniques.daily_bitmaps(orders, F.col("o_orderdate"), F.col("o_custkey")), "bitmaps")
    return uniques.uniques(daily, name="unique_customers")


def rule_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of order rules that are broken together."""
    rows, rules = prepared(spark, sf_dir, "orders")
    return report.cooccurrence(report.bit_patterns(rows, rules), rules)


def issues_from_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items' bitmask of broken rules, with the first issue and the number of issues read from it."""
    rows, rules = prepared(spark, sf_dir, "order_items")
    rows = rows.select(*ORDER_BY["order_items"], dq.issue_bits(rules.rules).alias("bits"))
    return rows.select("*", dq.first_issue_of_bits(F.col("bits"), rules.labels).alias("first_issue"), F.bit_count("bits").alias("n_issues"))


CUBE_DATES = {"customers": "registration_date", "sellers": "joined_date", "products": "created_date", "orders": "order_date"}


def dq_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of four entities by entity, month and label, with all totals."""
    return report.issue_cube({
        entity: (labelled(spark, sf_dir, entity), F.to_date(timestamp(F.col(date)))) for entity, date in CUBE_DATES.items()
    })


QUERIES = {
    "layers_written": layers_written,
    "promotion_checks": promotion_checks,
    "daily_refresh": daily_refresh,
    "landing_variant": landing_variant,
    "landing_unknown_fields": landing_unknown_fields,
    "drift_types": drift_types,
    "c360_bucketed": c360_bucketed,
    "uniques_rollup": uniques_rollup,
    "rule_cooccurrence": rule_cooccurrence,
    "issues_from_bits": issues_from_bits,
    "dq_cube": dq_cube,
}

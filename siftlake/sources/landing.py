"""Landing-zone readers with explicit schemas."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DataType, DateType, DecimalType, DoubleType, FractionalType, IntegralType, StringType, StructField, StructType, TimestampNTZType, TimestampType,
)

# The columns of the landing files. All are read as text, so that a malformed value stays
# visible to the rules; a line that cannot be read at all is kept in CORRUPT.
CUSTOMERS = (
    "customer_id", "first_name", "last_name", "email", "phone", "city", "state", "signup_date", "customer_segment",
)
PRODUCTS = ("product_id", "product_name", "category", "sub_category", "brand", "unit_price", "is_active")
STORES = ("store_id", "store_name", "city", "state", "region")
# discount_code appears in later files only; it reads as NULL where it is absent.
ORDERS = (
    "order_id", "customer_id", "store_id", "order_date", "order_status", "payment_mode", "channel", "discount_code",
)
ORDER_ITEMS = ("order_id", "product_id", "quantity", "unit_price", "line_total")

LANDING_DATE = "landing_date"
CORRUPT = "_corrupt_record"
RECORD = "record"
UNREADABLE = "_unreadable"


def _text_schema(columns) -> StructType:
    return StructType([StructField(c, StringType()) for c in (*columns, CORRUPT)])


def read_csv(spark: SparkSession, root: str, columns, partition: str = "ingest_date") -> DataFrame:
    """CSV files under ``root/<partition>=<date>/``; the directory date becomes ``landing_date``.

    Lines with too few or too many values are kept, their text in ``_corrupt_record``.
    """
    full = _text_schema(columns).add(partition, DateType())
    df = spark.read.schema(full).option("header", True).option("columnNameOfCorruptRecord", CORRUPT).csv(root)
    return df.withColumnRenamed(partition, LANDING_DATE)


def read_json_lines(spark: SparkSession, root: str, columns, partition: str = "order_date") -> DataFrame:
    """JSON Lines under ``root/<partition>=<date>/``; a line that is no JSON is kept in ``_corrupt_record``.

    The directory is named like a column of the records, so partition discovery would overwrite the
    record's own value. Files are listed recursively and the landing date is read from the path.
    """
    reader = spark.read.schema(_text_schema(columns)).option("recursiveFileLookup", True)
    df = reader.option("columnNameOfCorruptRecord", CORRUPT).json(root)
    return df.withColumn(LANDING_DATE, _path_date(partition))


def _path_date(partition: str) -> Column:
    day = F.regexp_extract(F.col("_metadata.file_path"), rf"{partition}=(\d{{4}}-\d{{2}}-\d{{2}})", 1)
    return day.try_cast("date")


def read_json_records(spark: SparkSession, root: str, partition: str = "order_date") -> DataFrame:
    """JSON Lines below ``root``, each record kept whole in the VARIANT column ``record``.

    Fields that nobody knows yet are kept with the others; ``extract`` takes out any field, also later and from a stored
    table. A line that is no JSON object (or repeats a field) has no record; its text is in ``_corrupt_record``.
    Lines of white space are skipped, as by the other readers.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(root).withColumn(LANDING_DATE, _path_date(partition))
    # A generator's output: parsed once, however many fields are taken out of it.
    parsed = F.inline(F.array(F.struct(F.try_parse_json("value").alias(RECORD))))
    rows = lines.where(F.trim("value", F.lit(" \t\r\n")) != "").select("value", LANDING_DATE, parsed)
    is_object = F.coalesce(F.startswith(F.schema_of_variant(RECORD), F.lit("OBJECT")), F.lit(False))
    return rows.select(
        F.when(is_object, F.col(RECORD)).alias(RECORD), F.when(~is_object, F.col("value")).alias(CORRUPT), LANDING_DATE
    )


def extract(df: DataFrame, fields: dict[str, tuple[str, str]], record: str = RECORD) -> DataFrame:
    """Add columns from a record: name to (path, type), like ``{"note": ("$.gift.note", "string")}``.

    A field that is absent, or whose value does not fit the type, is NULL; the record keeps it.
    """
    return df.withColumns({name: F.try_variant_get(F.col(record), path, kind) for name, (path, kind) in fields.items()})


def record_fields(df: DataFrame, known=(), record: str = RECORD) -> DataFrame:
    """field, kind and number of records of every top-level field that is not known."""
    pairs = df.select(F.col(record).alias("_record")).lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_record").outer()))
    kind = F.regexp_extract(F.schema_of_variant("value"), r"\A[A-Z]+", 0)
    found = pairs.where(F.col("key").isNotNull() & ~F.col("key").isin(*known) if known else F.col("key").isNotNull())
    return found.groupBy(F.col("key").alias("field"), kind.alias("kind")).agg(F.count(F.lit(1)).alias("records"))


def read_drifting_parquet(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """Parquet whose files differ in columns: an explicit superset schema, or merged footers."""
    if schema is not None:
        return spark.read.schema(schema).parquet(root)
    return spark.read.option("mergeSchema", True).parquet(root)


def union_drifting(frames: list[DataFrame]) -> DataFrame:
    """Batches with different columns as one frame; a column missing in a batch is NULL there."""
    head, *tail = frames
    for frame in tail:
        head = head.unionByName(frame, allowMissingColumns=True)
    return head


def schema_groups(spark: SparkSession, files: list[str]) -> list[tuple[StructType, list[str]]]:
    """Files grouped by compatible footers, with the schema of each group.

    Footers are read and merged by Spark, in parallel. Where two types of a column clash, the files are halved and
    each half tried, so a change of type between two days costs as many merges as its place in the list has
    bits. Groups with equal columns are joined again.
    """
    groups: dict[str, tuple[StructType, list[str]]] = {}
    waiting = [sorted(files)] if files else []
    while waiting:
        part = waiting.pop()
        try:
            schema = spark.read.option("mergeSchema", True).parquet(*part).schema
        except Exception as error:
            # Raised by the job that merges footers, without a class of its own in Python.
            if "CANNOT_MERGE_SCHEMAS" not in str(error) or len(part) == 1:
                raise
            waiting += [part[len(part) // 2 :], part[: len(part) // 2]]
            continue
        key = ",".join(sorted(f"{f.name}:{f.dataType.simpleString()}" for f in schema.fields))
        groups.setdefault(key, (schema, []))[1].extend(part)
    return list(groups.values())


def _wider(a: DataType, b: DataType) -> DataType:
    """The type that holds both; text where there is none. Text itself gives way: its values are parsed."""
    if a == b or isinstance(b, StringType):
        return a
    if isinstance(a, StringType):
        return b
    whole = ("tinyint", "smallint", "int", "bigint")
    if isinstance(a, IntegralType) and isinstance(b, IntegralType):
        return max(a, b, key=lambda t: whole.index(t.simpleString()))
    numbers = (IntegralType, FractionalType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        if all(isinstance(t, (IntegralType, DecimalType)) for t in (a, b)):
            scale = max(getattr(t, "scale", 0) for t in (a, b))
            digits = max(t.precision - t.scale if isinstance(t, DecimalType) else 19 for t in (a, b))
            return DecimalType(min(38, digits + scale), scale)
        return DoubleType()
    times = {DateType(): 0, TimestampNTZType(): 1, TimestampType(): 2}
    if a in times and b in times:
        return max(a, b, key=times.get)
    return StringType()


def _as_text(c: Column, kind: DataType) -> Column:
    return c.cast("string") if not isinstance(kind, StructType) else F.to_json(c)


def read_drifting_types(spark: SparkSession, root: str, wanted: dict[str, DataType] | None = None) -> DataFrame:
    """Parquet files below ``root`` whose columns change type or appear from file to file, as one frame.

    Every group of files is read with its own types and cast to the widest common type of each column, or to
    the one ``wanted``. Text is parsed. ``_unreadable`` maps the columns whose value does not fit that type to their text;
    it is NULL where all fit.
    """
    paths = spark.read.schema(StructType()).option("recursiveFileLookup", True).parquet(root).inputFiles()
    groups = schema_groups(spark, paths)
    types: dict[str, DataType] = {}
    for schema, _ in groups:
        for f in schema.fields:
            types[f.name] = _wider(types[f.name], f.dataType) if f.name in types else f.dataType
    types |= wanted or {}

    def typed(schema, files):
        own = {f.name: f.dataType for f in schema.fields}
        columns, faults = [], []
        for name, kind in types.items():
            if name not in own:
                columns.append(F.lit(None).cast(kind).alias(name))
                continue
            c = F.col(name)
            value = c if own[name] == kind else _as_text(c, own[name]) if isinstance(kind, StringType) else c.try_cast(kind)
            columns.append(value.alias(name))
            if own[name] != kind:
                entry = F.struct(F.lit(name).alias("key"), _as_text(c, own[name]).alias("value"))
                faults.append(F.when(c.isNotNull() & value.isNull(), entry))
        found = F.array_compact(F.array(*faults)) if faults else F.array().cast("array<struct<key:string,value:string>>")
        unreadable = F.when(F.size(found) > 0, F.map_from_entries(found)).alias(UNREADABLE)
        return spark.read.schema(schema).parquet(*files).select(*columns, unreadable)

    return reduce(DataFrame.unionByName, [typed(schema, files) for schema, files in groups])

"""Small helpers the operators share: adding columns batch by batch, stored intermediate tables, held-out rows."""

import ctypes
import os
import uuid
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..sources.lake import shared_folder

# Rows in one Arrow batch. Texts may be long, so batches stay far below Spark's default of 10,000 rows.
BATCH_ROWS = 1000

# Bytes of one Arrow batch: texts of any length, few rows of long ones.
BATCH_BYTES = 8 << 20

# What operators keep in a worker process for their next task there, and how to drop it.
HELD: dict[str, Callable[[], None]] = {}

PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> None:
    """Keep Arrow batches small in rows and bytes for all later jobs, and let Python workers on this machine find the package."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *filter(None, known)])
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key).removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def drop_held(keep: str = "") -> None:
    """Drop what the operators but ``keep`` hold in this worker process."""
    for owner, drop in HELD.items():
        if owner != keep:
            drop()


def give_back() -> None:
    """Return freed memory of this process to the system; a reused worker would keep its highest use."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def tidy(run: Callable, keep: str = "") -> Callable:
    """``run`` over a task's batches, without what other operators hold, giving memory back at the end."""
    def whole(batches):
        drop_held(keep)
        yield from run(batches)
        give_back()

    return whole


def append_columns(df: DataFrame, fields: str, make: Callable) -> DataFrame:
    """Every row with further columns, computed from one Arrow batch at a time.

    ``make()`` runs once per task and returns the function from a batch to the new columns, in the
    order of ``fields`` (a DDL string). A column of ``df`` with the name of a new one is replaced.
    """
    prepare(df.sparkSession)
    new = StructType.fromDDL(fields)
    old = [f for f in df.schema.fields if f.name not in set(new.names)]
    schema = StructType(old + list(new.fields))
    kept = [f.name for f in old]

    def run(batches):
        compute = make()
        for batch in batches:
            columns = compute(batch)
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + list(columns), names=schema.names)

    return df.mapInArrow(tidy(run), schema)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later stages start from that table."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus``; a NULL id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


# Ids in a broadcast: 16 MB of hashed long keys at most.
BROADCAST_ROWS = 1_000_000


def checked_broadcast(ids: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a narrow table counted to have at most ``rows`` rows; otherwise unchanged."""
    if ids.limit(rows + 1).count() <= rows:
        return F.broadcast(ids)
    return ids

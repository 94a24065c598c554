"""Layered lake: one directory per layer and table, Parquet inside.

Silver and quarantine of a table are two directories of one table, ``validated/<table>/layer=silver`` and
``layer=dq``, so that one partitioned write makes both. Partition columns of the rows lie below.
"""

import re
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

LAYERS = ("raw", "bronze", "silver", "dq", "gold")
VALIDATED = {"silver": "silver", "dq": "dq"}
LAYER = "layer"
LANDING = "landing_date"
# Directory of rows whose partition column is NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Label of invalid rows. Silver files hold it too, always NULL; it is left out when silver is read.
ISSUE = "_dq_issue"


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that every executor reaches, as named by spark.checkpoint.dir.

    On one machine a folder is made where none is named; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="siftlake-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several branches read to the shared folder and read it back.

    Later stages then start from a table instead of recomputing the frame, also after an executor
    is lost.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_values(column: str, values) -> Column:
    """The column has one of the values, None included; partitions are pruned by it."""
    known = [v for v in values if v is not None]
    found = F.col(column).isin(*known) if known else F.lit(False)
    return found | F.col(column).isNull() if None in values else found


@dataclass(frozen=True)
class Lake:
    """Paths, reads and writes below one root folder."""

    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
        root = self.root.rstrip("/")
        return f"{root}/validated/{table}/{LAYER}={layer}" if layer in VALIDATED else f"{root}/{layer}/{table}"

    def read(self, layer: str, table: str, schema: StructType | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        df = reader.parquet(self.path(layer, table))
        return df.drop(ISSUE) if layer == "silver" else df

    def has(self, layer: str, table: str) -> bool:
        """Whether the table has been written."""
        try:
            self.read(layer, table)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def read_all(self, layer: str, tables) -> dict[str, DataFrame]:
        return {t: self.read(layer, t) for t in tables}

    def write(self, df: DataFrame, layer: str, table: str, partition_by=()) -> str:
        """Overwrite a table. The frame must not read the path it replaces."""
        path = self.path(layer, table)
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        return path

    def write_validated(self, df: DataFrame, table: str, partition_by=(), only_touched: bool = False) -> None:
        """Write silver and quarantine in one go; ``df`` has the column ``layer`` and the label.

        With ``only_touched`` just the partitions that ``df`` has rows of are replaced, all others stay as they are;
        else the whole table is.
        """
        root = f"{self.root.rstrip('/')}/validated/{table}"
        mode = "dynamic" if only_touched else "static"
        df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(LAYER, *partition_by).parquet(root)

    def clear(self, layer: str, table: str, schema: StructType, partition: str = "") -> None:
        """Make a layer, or one partition of it, an empty table with a schema."""
        path = self.path(layer, table) + (f"/{partition}" if partition else "")
        self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)

    def copy(self, table: str, source: str = "raw", target: str = "bronze", schema: StructType | None = None) -> DataFrame:
        """Unchanged copy from one layer to another; returns the written copy, read back."""
        if source == target:
            raise ValueError("source and target layer must differ: a table cannot overwrite itself while it is read")
        self.write(self.read(source, table, schema), target, table)
        return self.read(target, table, schema)

    def land(self, df: DataFrame, table: str, landing_date: str, partition_by) -> None:
        """Replace the rows that landed on one day, partitioned by what the records themselves say."""
        path = f"{self.path('bronze', table)}/{LANDING}={landing_date}"
        rows = df.drop(LANDING).hint("rebalance", *partition_by) if partition_by else df.drop(LANDING)
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)

"""A commit log for stores of volumes.

A write puts its rows into a folder of its own and then lists the volumes it is about, with rows or without.  Only what is
listed counts, and of a volume only its latest listing, so a volume that is written again, if with nothing, replaces itself,
and a write that was cut off halfway is invisible.  Rows are never changed where they lie; a reader keeps what it
began with.  One writer at a time; a write with the number of an earlier one (a replayed batch) replaces that one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

DATA, LOG = "data", "log"


def listings(spark: SparkSession, path: str) -> DataFrame | None:
    """volume_id and batch of all commits; None before the first."""
    try:
        return spark.read.parquet(f"{path}/{LOG}")
    except AnalysisException:
        return None


def next_batch(spark: SparkSession, path: str) -> int:
    known = listings(spark, path)
    last = None if known is None else known.agg(F.max("batch")).first()[0]
    return 0 if last is None else last + 1


def publish(
    rows: DataFrame, path: str, partitions: Sequence[str], volumes: DataFrame | None = None, batch: int | None = None, kind: str = "parquet",
    placed: bool = False,
) -> int:
    """Write ``rows`` (with ``volume_id`` among the partition columns) and commit them; returns the number of the commit.

    ``volumes``: the volumes the write is about (``volume_id``), those without rows included; None: those that have rows.
    Rows are dealt by folder first, or each task would leave a file in every folder; ``placed``: they lie so already.
    """
    spark = rows.sparkSession
    batch = next_batch(spark, path) if batch is None else batch
    where = f"{path}/{DATA}/batch={batch}"
    dealt = rows if placed else rows.repartition(*partitions)
    dealt.write.mode("overwrite").format(kind).partitionBy(*partitions).save(where)
    if volumes is None:
        # From the names of the folders just written.
        found = spark.read.format(kind).schema(_typed(spark.read.format(kind).load(where).schema, rows.schema["volume_id"])).load(where) if _written(spark, where, kind) else rows.limit(0)
        volumes = found.select("volume_id").distinct()
    volumes.select("volume_id").distinct().write.mode("overwrite").parquet(f"{path}/{LOG}/batch={batch}")
    return batch


def _written(spark: SparkSession, where: str, kind: str) -> bool:
    try:
        return "volume_id" in spark.read.format(kind).load(where).columns
    except AnalysisException:
        return False


def _typed(schema: StructType, volume: StructField) -> StructType:
    """Names of folders read as what they were, not as numbers they may look like."""
    return StructType([StructField(f.name, volume.dataType if f.name == volume.name else f.dataType) for f in schema.fields])


def held(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """The rows of every volume as its latest commit left them; folders of other commits are not read."""
    known = listings(spark, path)
    if known is None:
        raise ValueError(f"nothing was committed to {path}")
    latest = known.groupBy("volume_id").agg(F.max("batch").alias("batch"))
    found = spark.read.format(kind).load(f"{path}/{DATA}")
    rows = spark.read.format(kind).schema(_typed(found.schema, known.schema["volume_id"])).load(f"{path}/{DATA}")
    return rows.join(latest, ["volume_id", "batch"], "left_semi").drop("batch")

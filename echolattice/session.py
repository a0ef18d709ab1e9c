"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, name: str = "echolattice") -> SparkSession:
    """A session for tests and the bench; on a cluster the session is given."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``).

    Only where a local session names none (tests, a laptop) is a temporary folder
    taken and set; on a cluster that is an error, since its machines share no folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("name a folder all machines share in spark.checkpoint.dir")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, unlike a local one."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` by column to the shared folder and read it again."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Spread few rows that are about to be unrolled into many.

    The number of partitions is given, so that adaptive coalescing does not gather
    the small rows into one task ahead of the unrolling.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)

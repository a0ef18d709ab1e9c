"""Running streams to the end of their input, with replayable sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def batch_table(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that keeps each batch in its own partition.

    A batch that is replayed after a failure overwrites its own rows only, which
    makes the sink exactly-once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def drain(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    """Process everything that is available now, batch by batch, then stop."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def collected(spark: SparkSession, stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Drain a stream into a batch table and read it back with its ``batch_id``.

    An empty part is written first, so a stream without rows reads back as no rows.
    """
    spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema]).write.mode(
        "overwrite"
    ).parquet(f"{path}/rows/batch_id=-1")
    drain(stream, batch_table(f"{path}/rows"), f"{path}/checkpoint", mode)
    schema = stream.schema.add("batch_id", "long")
    return spark.read.schema(schema).parquet(f"{path}/rows")


def latest_state(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The last emitted row of each key of an update-mode stream."""
    rest = [c for c in rows.columns if c not in (*keys, "batch_id")]
    last = F.max_by(F.struct(*rest), "batch_id").alias("__last")
    return rows.groupBy(*keys).agg(last).select(*keys, *[F.col(f"__last.{c}").alias(c) for c in rest])

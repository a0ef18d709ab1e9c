"""Reading, cutting lineage and feeding Arrow batches of texts to Python."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echolattice.session import shared_folder

#: Texts of a slice are worked on together; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20
#: Rows of an Arrow batch: few, as texts can be long.
BATCH_ROWS = 1000
#: Stands for a doc_id that is null where an order is needed: before all others.
NO_ID = -(2**63)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: After a write of so many seconds, or so many seconds after the last time, what nothing refers to is freed.
LONG_WRITE, FREE_EVERY = 1.0, 4.0
_freed = 0.0


def _free(spark: SparkSession, wrote: float) -> None:
    """Spark drops shuffle files when the driver collects garbage, which a driver with little to do seldom does."""
    global _freed
    if wrote > LONG_WRITE or time.monotonic() - _freed > FREE_EVERY:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        _freed = time.monotonic()


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: a lost executor costs no recomputation beyond it.

    The shuffle files of what was written are freed as soon as nothing refers to them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    began = time.monotonic()
    df.write.option("compression", "zstd").parquet(path)
    del df
    _free(spark, time.monotonic() - began)
    out = spark.read.parquet(path)
    out._cut_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables written by :func:`cut` that no plan still to be run reads."""
    for df in tables:
        jvm, path = df.sparkSession.sparkContext._jvm, df._cut_path
        hadoop = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(hadoop).delete(where, True)


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null: empty) and ``th``, which together tell rows apart.

    Rows that repeat both are one document; each such row gets the same result.
    Other columns are left out, whatever their names, but for those asked for.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"), *more)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text, one row at least."""
    sizes = [0 if x is None else x for x in pc.binary_length(batch.column(column)).to_pylist()]
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield batch.slice(first)


def map_texts(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, column: str = "text") -> DataFrame:
    """Apply ``function`` to slices of Arrow batches; None gives no rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                out = function(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)

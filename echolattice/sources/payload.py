"""Compressed sweep payloads to gate values."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: limits and sentinel of the payload format ---------------
MAX_GATES = 8400
SENTINEL = -1.797693134862315708e308
ROWS_PER_BATCH = 200_000
#: Sweeps that meet Python at once; one may hold millions of gates, so memory must not grow with the sweeps of a task.
SWEEPS_PER_BATCH = 64


def inflate(payload: bytes, nrays: int, ngates: int) -> tuple[np.ndarray | None, str | None]:
    """Values of one sweep in ray order, or the reason it is rejected."""
    if ngates > MAX_GATES:
        return None, f"more than {MAX_GATES} gates: {ngates}"
    try:
        values = np.frombuffer(zlib.decompress(payload), dtype="<f8")
    except (zlib.error, ValueError, TypeError) as problem:
        return None, f"payload does not inflate: {problem}"
    if values.size != nrays * ngates:
        return None, f"expected {nrays * ngates} values, found {values.size}"
    return values, None


def few_at_once(spark: SparkSession) -> None:
    """Arrow batches of this session hold few sweeps from here on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(SWEEPS_PER_BATCH))


def decode_sweeps(sweeps: DataFrame, keys: Sequence[str] = ("volume_id", "sweep")) -> DataFrame:
    """One row per gate of every sweep (``ray``, ``gate``, ``value``), and one row with
    ``reject`` for a sweep that cannot be read; a bad sweep never fails the job.

    ``sweeps`` has the keys, ``nrays``, ``ngates`` and a binary ``payload``.  Values
    leave a task in bounded batches, and one inflated sweep is held at a time.
    """
    few_at_once(sweeps.sparkSession)
    keyed = sweeps.select(*keys, "nrays", "ngates", "payload")
    schema = T.StructType([keyed.schema[k] for k in keys])
    for name, kind in (("ray", T.IntegerType()), ("gate", T.IntegerType()), ("value", T.DoubleType())):
        schema = schema.add(name, kind)
    schema = schema.add("reject", T.StringType())

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            types = [batch.schema.field(k).type for k in keys]
            for at_row in range(batch.num_rows):
                row = batch.slice(at_row, 1).to_pylist()[0]
                values, reject = inflate(row["payload"], row["nrays"], row["ngates"])
                if reject is not None:
                    cells = [pa.array([None], pa.int32()), pa.array([None], pa.int32()), pa.array([None], pa.float64())]
                    fixed = [pa.array([row[k]], t) for k, t in zip(keys, types)]
                    yield pa.record_batch([*fixed, *cells, pa.array([reject])], names=schema.names)
                    continue
                bad = (values == SENTINEL) | ~np.isfinite(values)
                for at in range(0, len(values), ROWS_PER_BATCH):
                    index = np.arange(at, min(at + ROWS_PER_BATCH, len(values)))
                    n = len(index)
                    fixed = [pa.repeat(pa.scalar(row[k], t), n) for k, t in zip(keys, types)]
                    yield pa.record_batch(
                        [
                            *fixed,
                            pa.array((index // row["ngates"]).astype(np.int32)),
                            pa.array((index % row["ngates"]).astype(np.int32)),
                            pa.array(values[index], mask=bad[index]),
                            pa.nulls(n, pa.string()),
                        ],
                        names=schema.names,
                    )

    return keyed.mapInArrow(decode, schema)


def decoded_gates(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reject").isNull() & F.col("value").isNotNull()).drop("reject")


def decoded_rejects(decoded: DataFrame, keys: Sequence[str] = ("volume_id", "sweep")) -> DataFrame:
    return decoded.filter(F.col("reject").isNotNull()).select(*keys, "reject")

"""Ledger operators over streams of arrivals.

Arrivals carry ``obs_ts`` (event time) and ``created_ts`` (arrival).  State is
bounded by a watermark everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from echolattice.config import RESUME_BUFFER_MINUTES
from echolattice.operators.ledger import with_previous
from echolattice.session import stored

VOLUME = ("radar", "strategy", "vol_nr", "obs_ts")
DEFAULT_DELAY = f"{RESUME_BUFFER_MINUTES} minutes"


def dedup_sink(path: str):
    """A batch sink that keeps each file name once, however late a copy or a first arrival comes.

    What is stored is itself the memory, by day of observation, so a batch is compared
    with the days it touches only, no state grows and no watermark drops rows.  A batch
    that is replayed ignores and overwrites its own earlier rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dated = batch.dropDuplicates(["filename"]).withColumn("obs_day", F.date_format("obs_ts", "yyyy-MM-dd"))
        schema = dated.schema.add("batch_id", "long")
        spark.createDataFrame([], schema).write.mode("append").partitionBy("obs_day", "batch_id").parquet(path)
        days = [r[0] for r in dated.select("obs_day").distinct().collect()]  # the days of one batch
        stored = spark.read.schema(schema).parquet(path).filter((F.col("batch_id") != batch_id) & F.col("obs_day").isin(days))
        fresh = dated.join(stored.select("filename"), "filename", "left_anti").withColumn("batch_id", F.lit(batch_id).cast("long"))
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("obs_day", "batch_id").parquet(path)

    return write


def stream_volumes(arrivals: DataFrame, expected: Sequence[str] | DataFrame, delay: str) -> DataFrame:
    """Field sets of volumes as they grow (update mode).

    ``expected``: fields of every volume, or a catalogue of them by strategy and vol_nr (``expected``
    sorted), as kinds of volumes have fields of their own; volumes it does not list are left out.
    The observation time is part of the key, so a volume's state is dropped once
    the watermark has passed it.  A field that arrives in time reopens its volume.
    """
    sets = (
        arrivals.filter(F.col("status") == "completed")
        .withWatermark("obs_ts", delay)
        .groupBy(*VOLUME)
        .agg(F.array_sort(F.collect_set("field")).alias("downloaded"))
    )
    if isinstance(expected, DataFrame):
        sets = sets.join(expected, ["strategy", "vol_nr"])
    else:
        sets = sets.withColumn("expected", F.array_sort(F.array(*[F.lit(f) for f in expected])))
    return sets.select(
        *VOLUME, "downloaded", (F.col("downloaded") == F.col("expected")).alias("is_complete"),
        F.array_except("expected", "downloaded").alias("missing"),
    )


def stream_timed_out(arrivals: DataFrame, expected: Sequence[str] | DataFrame, delay: str) -> DataFrame:
    """Volumes once, when the watermark passes them, with the fields at hand (append mode).

    A volume that is not complete by then is given up with ``is_complete`` false.
    Volumes of the last ``delay`` of a stream that ends are not behind its watermark and stay open.
    """
    return stream_volumes(arrivals, expected, delay)


def stream_slots(arrivals: DataFrame, delay: str, width: str = "10 minutes", time: str = "created_ts") -> DataFrame:
    """Tumbling product slots (update mode)."""
    return (
        arrivals.withWatermark(time, delay)
        .groupBy(F.window(time, width).alias("slot"), "radar")
        .agg(F.count(F.lit(1)).alias("files"), F.count(F.when(F.col("status") == "completed", 1)).alias("completed"))
        .select(F.col("slot.start").alias("slot_ts"), "radar", "files", "completed")
    )


def late_rows(arrivals: DataFrame, watermark: Column) -> DataFrame:
    """Rows of a batch that lie behind a watermark, for a side table."""
    return arrivals.filter(F.col("obs_ts") < watermark)


def late_sink(path: str, delay: str):
    """A batch sink that keeps rows in time under ``rows`` and rows behind the watermark under ``late``; nothing is dropped.

    The watermark is the newest observation of the batches before, less ``delay``, kept as one row for each batch under
    ``seen``.  A batch that is replayed sees the same watermark and replaces its own rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = stored(batch, "batch")
        newest = own.agg(F.max("obs_ts").alias("newest"))
        newest.limit(0).write.mode("append").parquet(f"{path}/seen/batch_id=-1")
        seen = spark.read.schema("newest timestamp, batch_id long").parquet(f"{path}/seen").filter(F.col("batch_id") < batch_id)
        limit = seen.agg((F.max("newest") - F.expr(f"INTERVAL {delay}")).alias("limit")).first()[0]
        behind = late_rows(own, F.lit(limit).cast("timestamp"))
        in_time = own.filter(F.coalesce(F.col("obs_ts") >= F.lit(limit).cast("timestamp"), F.lit(True)))
        in_time.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        behind.write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        newest.write.mode("overwrite").parquet(f"{path}/seen/batch_id={batch_id}")

    return write


def reopened_by_late(rows: DataFrame, late: DataFrame) -> DataFrame:
    """Volumes that late rows bring fields for: the fields held before, those that came late, and when the volume was opened again.

    Only the volumes of late rows are looked up among the rows in time.
    """
    came = late.filter(F.col("status") == "completed").groupBy(*VOLUME).agg(F.array_sort(F.collect_set("field")).alias("late_fields"), F.min("created_ts").alias("reopened_ts"))
    held = rows.filter(F.col("status") == "completed").join(came.select(*VOLUME), list(VOLUME), "left_semi").groupBy(*VOLUME).agg(F.array_sort(F.collect_set("field")).alias("held"))
    both = came.join(held, list(VOLUME), "left").withColumn("held", F.coalesce("held", F.array().cast("array<string>")))
    fresh = F.array_except("late_fields", "held")
    return both.filter(F.size(fresh) > 0).select(*VOLUME, "held", fresh.alias("late_fields"), "reopened_ts")


def reopened(states: DataFrame, products: DataFrame) -> DataFrame:
    """Completed products of volumes that a late field completed, pending again.

    ``states`` are the rows of :func:`stream_volumes` with ``batch_id``: a volume
    first seen incomplete and later complete has been reopened.
    """
    first = states.groupBy(*VOLUME).agg(
        F.min_by("is_complete", "batch_id").alias("before"), F.max_by("is_complete", "batch_id").alias("after")
    )
    changed = first.filter(~F.col("before") & F.col("after")).select(*VOLUME)
    chosen = products.filter(F.col("status") == "completed").join(changed, list(VOLUME), "left_semi")
    return chosen.withColumn("status", F.lit("pending"))


def stream_stuck(states: DataFrame, delay: str, timeout_minutes: int) -> DataFrame:
    """Volumes still processing when the timeout passes, as new pending states.

    ``states`` has ``volume_id``, ``status`` and ``updated_ts``.  One timer per
    volume in event time, so a replay gives the same result.
    """
    timeout_ms = timeout_minutes * 60_000

    def follow(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (at,) = state.get
            state.remove()
            yield pd.DataFrame({
                "volume_id": [key[0]], "status": ["pending"], "since_us": [at],
            })
            return
        rows = pd.concat(list(parts))
        last = rows.sort_values(["updated_ts", "event_id"]).iloc[-1]
        at = pd.Timestamp(last["updated_ts"]).value // 1000
        if state.exists and state.get[0] > at:
            return
        if last["status"] != "processing":
            if state.exists:
                state.remove()
            return
        state.update((at,))
        state.setTimeoutTimestamp(max(at // 1000 + timeout_ms, state.getCurrentWatermarkMs() + 1))

    return (
        states.withWatermark("updated_ts", delay)
        .groupBy("volume_id")
        .applyInPandasWithState(
            follow, "volume_id string, status string, since_us long", "at long", "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )


ORDER_KEY = ("radar", "obs_date", "strategy", "vol_nr", "field")


def order_sink(path: str):
    """A batch sink that flags arrivals older than the one before them, per (radar, day, kind): event_id, radar, out_of_order under ``rows``.

    A batch is ordered by segments of arrival time, with Spark windows; the last observation of each key is kept by day and
    batch under ``last``, and only the days a batch touches are read.  A key has one row for each batch that brought
    it rows.  A batch that is replayed sees the states before it and replaces its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        keys = list(ORDER_KEY)
        dated = batch.withColumns({"obs_date": F.date_format("obs_ts", "yyyy-MM-dd"), "obs_s": F.unix_timestamp("obs_ts")})
        dated = dated.select(*keys, "event_id", "created_ts", "obs_s")
        order = ["created_ts", "event_id"]
        found = stored(with_previous(dated, keys, "obs_s", F.col("created_ts"), order), "ordered")
        newest = found.groupBy(*keys).agg(F.max_by("obs_s", F.struct(*order)).alias("last"))
        schema = newest.withColumn("batch_id", F.lit(0).cast("long")).schema
        days = [r[0] for r in found.select("obs_date").distinct().collect()]  # the days of one batch
        spark.createDataFrame([], schema).write.mode("append").partitionBy("obs_date", "batch_id").parquet(f"{path}/last")
        kept = spark.read.schema(schema).parquet(f"{path}/last").filter((F.col("batch_id") < batch_id) & F.col("obs_date").isin(days))
        before = kept.groupBy(*keys).agg(F.max_by("last", "batch_id").alias("last")).withColumnsRenamed({k: f"__{k}" for k in keys})
        same = F.lit(True)
        for key in keys:
            same = same & F.col(key).eqNullSafe(F.col(f"__{key}"))
        previous = F.when(F.col("is_first"), F.col("last")).otherwise(F.col("previous"))
        flagged = found.join(before, same, "left").select("event_id", "radar", F.coalesce(F.col("obs_s") < previous, F.lit(False)).alias("out_of_order"))
        flagged.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        placed = newest.withColumn("batch_id", F.lit(batch_id).cast("long")).repartition("obs_date")
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("obs_date", "batch_id").parquet(f"{path}/last")

    return write

"""Incomplete volumes over a stream: retried, given up by attempts or by time, and never lost.

A volume is followed from its first arrival.  It comes out when it has all its fields, when every field it
lacks has failed often enough, or when it has waited long enough, whichever is first.  State is a value for each open volume and one
timer; what has come out is forgotten, and a field that arrives later opens the volume again, whose parts
:func:`outcomes` unites.  Volumes still open when the input ends are read from the state itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from echolattice.streaming.ledger import VOLUME

#: Failed downloads of a field after which it is not tried again, and minutes a volume waits for its fields.
MAX_ATTEMPTS, TIMEOUT_MINUTES = 3, 24 * 60
_STATE = "first_ms long, downloaded array<string>, failed array<string>"
_OUT = "radar string, strategy string, vol_nr string, obs_ts timestamp, first_ms long, downloaded array<string>, failed array<string>, reason string"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class VolumeFollower(StatefulProcessor):
    """``failed`` lists a field once for every failed download, so that attempts of later parts can be added."""

    def __init__(self, expected: Mapping[tuple[str, str], Sequence[str]], max_attempts: int, timeout_ms: int):
        self.expected, self.max_attempts, self.timeout_ms = expected, max_attempts, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("volume", _STATE)

    def _out(self, key: tuple, reason: str, state: tuple) -> pd.DataFrame:
        radar, strategy, vol_nr, obs_ts = key
        return pd.DataFrame({
            "radar": [radar], "strategy": [strategy], "vol_nr": [vol_nr], "obs_ts": [obs_ts], "first_ms": [state[0]],
            "downloaded": [list(state[1])], "failed": [list(state[2])], "reason": [reason],
        })

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.open.get() if self.open.exists() else None
        fresh = held is None
        first, downloaded, failed = held if held else (None, [], [])
        downloaded, failed = set(downloaded), list(failed)
        for part in rows:
            first = min([x for x in (first, int(part["created_ms"].min())) if x is not None])
            done = part["status"] == "completed"
            downloaded |= set(part.loc[done, "field"])
            failed += part.loc[part["status"] == "failed", "field"].tolist()
        state = (first, sorted(downloaded), sorted(failed))
        missing = set(self.expected.get((key[1], key[2]), ())) - downloaded
        given_up = all(failed.count(f) >= self.max_attempts for f in missing)
        if given_up:
            self._forget()
            yield self._out(key, "attempts" if missing else "complete", state)
            return
        self.open.update(state)
        if fresh:
            self.handle.registerTimer(max(first + self.timeout_ms, timerValues.getCurrentWatermarkInMs() + 1))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.open.exists():
            state = self.open.get()
            self._forget()
            yield self._out(key, "time", state)

    def _forget(self) -> None:
        self.open.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def close(self) -> None:
        pass


@contextmanager
def keyed_state(spark: SparkSession):
    """Streams started inside keep their state in a store that has timers."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def follow_volumes(
    arrivals: DataFrame, expected: Mapping[tuple[str, str], Sequence[str]], delay: str,
    max_attempts: int = MAX_ATTEMPTS, timeout_minutes: int = TIMEOUT_MINUTES,
) -> DataFrame:
    """Volumes as they come out: key, first arrival, downloaded fields, failed downloads and reason (complete, attempts or time).

    ``expected``: fields by (strategy, vol_nr).  Time is that of arrival (``created_ts``), so a field of an old observation is not late.
    """
    narrow = arrivals.withWatermark("created_ts", delay).select(*VOLUME, "field", "status", "created_ts", F.unix_millis("created_ts").alias("created_ms"))
    follower = VolumeFollower(dict(expected), max_attempts, timeout_minutes * 60_000)
    return narrow.groupBy(*VOLUME).transformWithStateInPandas(follower, _OUT, "append", "eventTime")


def still_open(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The volumes a stopped stream has not let out yet, from its state, with reason ``open``."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "volume").load()
    return state.select("key.*", "value.*", F.lit("open").alias("reason"))


def outcomes(parts: DataFrame, expected: DataFrame) -> DataFrame:
    """One row per volume: the fields of all its parts, attempts (failed downloads of fields it lacks) and whether it is complete.

    ``expected``: strategy, vol_nr, expected (sorted array).  A volume has few parts: it is opened again only by rows after it came out.
    """
    united = parts.groupBy(*VOLUME).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("downloaded")))).alias("downloaded"), F.flatten(F.collect_list("failed")).alias("failed"),
    )
    lacking = F.filter("failed", lambda f: ~F.array_contains(F.col("downloaded"), f))
    listed = united.join(expected, ["strategy", "vol_nr"], "left").withColumn("attempts", F.size(lacking))
    complete = F.coalesce(F.size(F.array_except("expected", "downloaded")) == 0, F.lit(False))
    return listed.select(*VOLUME, "downloaded", "attempts", complete.alias("is_complete"))

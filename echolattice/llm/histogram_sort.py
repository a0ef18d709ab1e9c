"""Shards of equal bytes by histogram sort.

Documents are put in the order of (hash of the text, doc_id), in which equal texts lie next to each other,
and the order is cut where the bytes are shared out.  Where to cut is found without sorting: all partitions
count the exact rows and bytes between candidate keys (probes), the interval of
every cut still off its target is divided into more probes, and so on until all
cuts meet the tolerance or no key lies in between.  Then all rows move once,
to sub-ranges of shards that are sorted each by itself.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from echolattice.llm.common import NO_ID, cut

SHARDS = 16
#: Share of a shard's bytes by which its borders may miss, and by which those of sub-ranges may.
TOLERANCE, LOOSE = 1e-3, 0.2
#: Bytes of a sub-range, which one task sorts; probes of an interval in each round, and of all intervals together.
RANGE_BYTES, PROBES, ALL_PROBES = 64 << 20, 64, 1 << 16
_LOW = -(2**63)

#: A key is (hash, id, number among rows equal in both), an integer of 192 bits in Python.
Key = int
_WORD = 2**64 - 1


def key_of(h: int, i: int, j: int = _LOW) -> Key:
    return ((h - _LOW) << 128) + ((i - _LOW) << 64) + (j - _LOW)


def _parts(key: Key) -> tuple[int, int, int]:
    return (key >> 128) + _LOW, (key >> 64 & _WORD) + _LOW, (key & _WORD) + _LOW


def rank_among(probes: list[Key], h: np.ndarray, i: np.ndarray, j: np.ndarray | None = None) -> np.ndarray:
    """For every row the number of probes at or below its key."""
    hs, ids, js = (np.array(x, dtype=np.int64) for x in zip(*map(_parts, probes))) if probes else [np.zeros(0, np.int64)] * 3
    low, high = np.searchsorted(hs, h, side="left"), np.searchsorted(hs, h, side="right")
    out = low.copy()
    for at in np.unique(np.flatnonzero(high > low)):
        first, last = low[at] + np.searchsorted(ids[low[at] : high[at]], i[at], side="left"), low[at] + np.searchsorted(ids[low[at] : high[at]], i[at], side="right")
        out[at] = first + np.searchsorted(js[first:last], _LOW if j is None else j[at], side="right")
    return out


def _histogram(keys: DataFrame, probes: list[Key]) -> tuple[np.ndarray, np.ndarray]:
    """Rows and bytes below each probe."""
    spark = keys.sparkSession
    given = spark.sparkContext.broadcast(probes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = np.zeros(len(given.value) + 1, dtype=np.int64), np.zeros(len(given.value) + 1, dtype=np.int64)
        for batch in batches:
            j = batch.column("j").to_numpy() if "j" in batch.schema.names else None
            bin_ = rank_among(given.value, batch.column("h").to_numpy(), batch.column("i").to_numpy(), j)
            rows += np.bincount(bin_, minlength=len(rows))
            np.add.at(size, bin_, batch.column("size").to_numpy())
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(rows[used]), pa.array(size[used])], names=["bin", "n", "bytes"])

    found = keys.mapInArrow(count, "bin long, n long, bytes long").groupBy("bin").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).toPandas()
    n, size = np.zeros(len(probes) + 1, dtype=np.int64), np.zeros(len(probes) + 1, dtype=np.int64)
    n[found["bin"]], size[found["bin"]] = found["n"], found["bytes"]
    return np.cumsum(n)[:-1], np.cumsum(size)[:-1]


def _split(keys: DataFrame, targets: list[int], slack: list[float]) -> tuple[list[tuple[Key, int, int]], list[Key]]:
    """:func:`splitters`, and the keys of several rows that keep a border from its target."""
    end = 2**192
    # Without numbers for equal rows only the first of a key can be told from the one before.
    unit = 1 if "j" in keys.columns else 2**64
    low, high = [(0, 0, 0)] * len(targets), [(end, None, None)] * len(targets)
    best: list[tuple[Key, int, int]] = [(0, 0, 0)] * len(targets)
    while True:
        open_ = [k for k, t in enumerate(targets) if abs(best[k][2] - t) > slack[k] and high[k][0] - low[k][0] > unit]
        if not open_:
            break
        many = max(4, min(PROBES, ALL_PROBES // len(open_)))
        probes = sorted({(low[k][0] + (high[k][0] - low[k][0]) * m // many) // unit * unit for k in open_ for m in range(1, many + 1)} - {0, end})
        rows, size = _histogram(keys, probes)
        seen = list(zip(probes, rows.tolist(), size.tolist()))
        for k in open_:
            within = seen[bisect_right(probes, low[k][0]) : bisect_left(probes, high[k][0])]
            split = bisect_right(within, targets[k], key=lambda x: x[2])
            if split:
                low[k] = within[split - 1]
            if split < len(within):
                high[k] = within[split]
            best[k] = min((best[k], *within[max(split - 1, 0) : split + 1]), key=lambda x: abs(x[2] - targets[k]))
            if high[k][1] is not None and high[k][1] - low[k][1] <= 1:
                low[k] = (high[k][0] - unit, low[k][1], low[k][2])  # one row is left in between
    n = None
    hot = set()
    for k, t in enumerate(targets):
        if abs(best[k][2] - t) > slack[k]:
            if high[k][1] is None:
                n = keys.count() if n is None else n
                high[k] = (high[k][0], n, None)
            if high[k][1] - low[k][1] > 1:
                hot.add(low[k][0])
    return best, sorted(hot)


def splitters(keys: DataFrame, targets: list[int], slack: list[float]) -> list[tuple[Key, int, int]]:
    """For each target number of bytes a key, with the exact rows and bytes below it, within slack of
    the target if any key is; ``keys``: h, i, size, and j where rows equal in h and i have numbers."""
    return _split(keys, targets, slack)[0]


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All input columns with ``shard_size``, ``shard`` and ``shard_slot``; the law is ``bytes``.

    The size of a document is the UTF-8 bytes of its text (null: none) plus one.  Shards differ
    from the mean by ``TOLERANCE`` of it plus one document at either border.  Equal texts lie next to each other, in order of
    doc_id (null first), and share a shard unless a border falls among them.  Where a border falls among rows equal in
    both, these rows, and no others, are written with numbers of their own that divide them.
    Slots number a shard's rows from 0.  Columns named like the added ones are replaced; an empty table gives no rows.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("shard_size", "shard", "shard_slot")]
    text = F.coalesce("text", F.lit(""))
    h, i = F.xxhash64(text), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    size = F.octet_length(text).cast("long") + 1
    ranged = docs.select(*kept, size.alias("shard_size"), h.alias("__h"), i.alias("__i"), F.lit(_LOW).alias("__j"))
    keys = cut(ranged.select(F.col("__h").alias("h"), F.col("__i").alias("i"), F.col("shard_size").alias("size")), "keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    ranges = int(max(1, -(-total // (shards * RANGE_BYTES)), -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards)))
    n = shards * ranges
    targets = [total * k // n for k in range(1, n)]
    slack = [(TOLERANCE if k % ranges == 0 else LOOSE / ranges) * total / shards for k in range(1, n)]
    borders, hot = _split(keys, targets, slack)
    if hot:
        # At most one key for each border.
        listed = spark.createDataFrame([_parts(key)[:2] for key in hot], "hot_h long, hot_i long")

        def one_of(frame: DataFrame, how: str) -> DataFrame:
            a, b = ("h", "i") if "h" in frame.columns and "__h" not in frame.columns else ("__h", "__i")
            return frame.join(listed, (frame[a] == listed["hot_h"]) & (frame[b] == listed["hot_i"]), how)

        same = cut(one_of(ranged, "left_semi").withColumn("__j", F.xxhash64(F.monotonically_increasing_id())), "same")
        numbered = same.select(F.col("__h").alias("h"), F.col("__i").alias("i"), F.col("__j").alias("j"), F.col("shard_size").alias("size"))
        others = one_of(keys, "left_anti").select("h", "i", F.lit(_LOW).alias("j"), "size")
        borders, _ = _split(cut(others.unionByName(numbered), "keys"), targets, slack)
        ranged = one_of(ranged, "left_anti").unionByName(same)
    borders = sorted(borders)
    below = np.array([0] + [b[1] for b in borders])
    # Rows of the shard before each of its sub-ranges.
    before = below - below[np.arange(n) - np.arange(n) % ranges]
    given = spark.sparkContext.broadcast(([b[0] for b in borders], before))  # a key and a number for each sub-range

    @F.pandas_udf("int")
    def range_of(h: pd.Series, i: pd.Series, j: pd.Series) -> pd.Series:
        return pd.Series(rank_among(given.value[0], h.to_numpy(), i.to_numpy(), j.to_numpy()).astype(np.int32))

    @F.pandas_udf("long")
    def before_of(number: pd.Series) -> pd.Series:
        return pd.Series(given.value[1][number.to_numpy()])

    placed = ranged.withColumn("__range", range_of("__h", "__i", "__j")).withColumn("__before", before_of("__range"))
    row = F.row_number().over(Window.partitionBy("__range").orderBy("__h", "__i", "__j", "shard_size")) - 1
    return placed.withColumn("shard_slot", F.col("__before") + row).withColumn("shard", F.floor(F.col("__range") / ranges).cast("int")).drop("__h", "__i", "__j", "__range", "__before")

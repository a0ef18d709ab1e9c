"""Gates kept where their map is: in buckets of (geometry, gate).

Gridding joins gates to a map on (geometry, gate).  Gates written once at ingest in as many buckets
as the map (:func:`geometry_store.save_bucketed`) meet it where they lie: no product of any volume
exchanges gates again, only what it sums by pixel or voxel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolattice.operators import volumes

KEY = ("geometry_id", "gate_id")
#: Fewest buckets of gates and maps.  A scan's gates number millions, so buckets are even.
BUCKETS = 16
#: Measurements of a bucket, at most: a task aggregates and sorts a bucket in memory, however many volumes there are.
ROWS = 500_000
#: Elevation of a volume's lowest sweep, kept beside its gates, so that products on that surface need no join.
LOWEST = "lowest_elevation"


def buckets_for(rows: int) -> int:
    """Buckets for so many measurements: doubled until one holds at most ``ROWS``."""
    buckets = BUCKETS
    while buckets * ROWS < rows:
        buckets *= 2
    return buckets


def with_lowest(gates: DataFrame, sweeps: DataFrame) -> DataFrame:
    """Gates with the elevation of the lowest sweep of their volume; null for a volume without sweeps."""
    lowest = volumes.lowest_sweep(sweeps).select("volume_id", F.col("elevation").alias(LOWEST))
    return gates.join(lowest, "volume_id", "left")


def save_gates(
    gates: DataFrame, table: str, path: str, buckets: int = BUCKETS, partitions: Sequence[str] = (), mode: str = "overwrite",
    placed: bool = False,
) -> None:
    """Write gates as a table in buckets, one file each; ``partitions`` (such as a day) let products read a part.

    ``placed``: the gates were dealt to as many partitions by ``KEY`` when they were made, and are not exchanged again.
    """
    placed = (gates if placed else gates.repartition(buckets, *KEY)).sortWithinPartitions(*partitions, *KEY)
    writer = placed.write.mode(mode).option("path", path).bucketBy(buckets, *KEY).sortBy(*KEY)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.saveAsTable(table)

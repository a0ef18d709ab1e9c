"""Products of volumes as they are completed."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echolattice.session import stored

#: From the gates of some volumes to rows of a product, with ``volume_id``.
Maker = Callable[[DataFrame], DataFrame]


def product_sink(
    gates: DataFrame, makers: Mapping[str, Maker], path: str, keys: Sequence[str] = ("volume_id",), prepare: Maker | None = None
) -> Callable[[DataFrame, int], None]:
    """A batch sink from completed volume ids to stored products, by name.

    All volumes of a batch go through one job per product; their gates are read from
    the source once.  A batch has a folder of its own in each product and in ``done``, which lists
    its volumes, so a replayed batch leaves one copy, and a folder holds many volumes.
    ``keys`` may add the partition columns of stored gates, which then prune the scan.  ``prepare`` makes, once a batch, what all
    makers start from (such as voxels) out of the gates; without it they start from the gates of the batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        done = batch.select(*keys).distinct()
        own = gates.join(done, list(keys), "left_semi")
        base = stored(own, "batch-gates") if prepare is None else prepare(own)
        for name, make in makers.items():
            make(base).write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
        # Listed last: a volume counts from when all its products are there.
        done.select("volume_id").distinct().write.mode("overwrite").parquet(f"{path}/done/batch_id={batch_id}")

    return write


def stored_products(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A product of every volume as its latest batch left it; a volume whose product came out empty has no rows."""
    latest = spark.read.parquet(f"{path}/done").groupBy("volume_id").agg(F.max("batch_id").alias("batch_id"))
    return spark.read.parquet(f"{path}/{name}").join(latest, ["volume_id", "batch_id"]).drop("batch_id")

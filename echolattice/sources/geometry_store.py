"""Maps kept as tables and reused by their canonical key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echolattice.config import Lattice

PAIRS, META = "geometry_pairs", "geometry_meta"


def geometry_meta(geometries: DataFrame, lattice: Lattice) -> DataFrame:
    """One row per geometry: shape, limits and the build parameters as a map.

    Parameters a geometry overrides (columns of ``geometries``) replace defaults.
    """
    defaults = {
        "h_factor": lattice.h_factor, "nb": lattice.nb, "bsp": lattice.bsp, "min_radius": lattice.min_radius,
        "blind_range_m": lattice.blind_range_m, "max_neighbors": lattice.max_neighbors, "weighting": lattice.weighting,
    }
    own = [c for c in defaults if c in geometries.columns]
    params = F.create_map(*[x for k, v in defaults.items() if k not in own for x in (F.lit(k), F.lit(str(v)))])
    if own:
        params = F.map_concat(params, F.create_map(*[x for k in own for x in (F.lit(k), F.col(k).cast("string"))]))
    return geometries.select(
        "geometry_id",
        F.lit(lattice.nz).alias("nz"), F.lit(lattice.ny).alias("ny"), F.lit(lattice.nx).alias("nx"),
        F.lit(lattice.z_limits[0]).alias("z_min"), F.lit(lattice.z_limits[1]).alias("z_max"),
        F.lit(lattice.y_limits[0]).alias("y_min"), F.lit(lattice.y_limits[1]).alias("y_max"),
        F.lit(lattice.x_limits[0]).alias("x_min"), F.lit(lattice.x_limits[1]).alias("x_max"),
        F.lit(lattice.toa).alias("toa"), params.alias("params"),
    )


def save_geometry(pairs: DataFrame, meta: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a map, gathered and ordered by the gates that gridding joins on."""
    (
        pairs.repartition("geometry_id", "gate_id")
        .sortWithinPartitions("geometry_id", "gate_id")
        .write.mode(mode)
        .parquet(f"{path}/{PAIRS}")
    )
    meta.write.mode(mode).parquet(f"{path}/{META}")


def save_bucketed(pairs: DataFrame, table: str, buckets: int, path: str | None = None, mode: str = "overwrite") -> None:
    """Write a map as a bucketed table, one file a bucket: gates in as many buckets join it without an exchange."""
    placed = pairs.repartition(buckets, "geometry_id", "gate_id").sortWithinPartitions("geometry_id", "gate_id")
    writer = placed.write.mode(mode).bucketBy(buckets, "geometry_id", "gate_id").sortBy("geometry_id", "gate_id")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def load_geometry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{PAIRS}")


def peek_geometry(spark: SparkSession, path: str) -> DataFrame:
    """Metadata only; the pairs are not opened."""
    return spark.read.parquet(f"{path}/{META}")


def unbuilt(wanted: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Wanted geometries that are not in the store yet."""
    return wanted.join(peek_geometry(spark, path).select("geometry_id"), "geometry_id", "left_anti")

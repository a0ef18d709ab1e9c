"""Maps found by their canonical key and searched only if nobody has searched them before.

The key of a map names radar, strategy, volume and all build parameters, overrides of a geometry over the defaults included, as
:func:`names.geometry_key` writes them, and the scan.  What is searched depends on scan and parameters only, so keys that
agree in these share one search (a build).  A search is written into a folder of its own and listed, with
the keys it serves, when it is complete; what is not listed does not exist.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echolattice.config import Lattice
from echolattice.functions import names
from echolattice.operators.neighbours import PER_GEOMETRY, for_all
from echolattice.session import stored

PAIRS, KEYS = "pairs", "keys"
#: Columns of a scan that name it; all others shape it.
NAMING = ("geometry_id", "radar", "strategy", "vol_nr")
#: From the scans of some geometries (all their columns) to pairs (geometry_id, voxel_id, gate_id, weight).
Search = Callable[[DataFrame], DataFrame]


def wanted_maps(scans: DataFrame, lattice: Lattice) -> DataFrame:
    """geometry_id, map_key and build of each geometry; ``scans``: a row per sweep with the columns of ``NAMING``, overridden
    parameters under their names, and what shapes the scan."""
    own = [c for c in PER_GEOMETRY if c in scans.columns]
    shape = sorted(c for c in scans.columns if c not in NAMING and c not in own)
    per = scans.groupBy("geometry_id").agg(
        *[F.first(c).alias(c) for c in NAMING[1:]], *[F.first(c).alias(c) for c in own],
        F.sha2(F.to_json(F.sort_array(F.collect_list(F.struct(*shape)))), 256).alias("scan"),
    )
    parameters = names.lattice_parameters(lattice) | {c: F.col(c) for c in NAMING[1:]}
    parameters |= {c: F.col(c) for c in own if c in parameters}
    key = F.concat(names.geometry_key(parameters), F.lit("_"), F.substring("scan", 1, 16))
    # Everything the search reads, the lattice whole and overrides at full precision.
    build = F.sha2(F.concat_ws("|", "scan", F.lit(repr(lattice)), *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in own]), 256)
    return per.select("geometry_id", key.alias("map_key"), build.alias("build"))


def known_maps(spark: SparkSession, path: str) -> DataFrame | None:
    """map_key, build and batch of all maps of a cache; None for a new one."""
    try:
        return spark.read.parquet(f"{path}/{KEYS}")
    except AnalysisException:
        return None


def ensure(scans: DataFrame, lattice: Lattice, path: str, search: Search) -> DataFrame:
    """Search what no earlier call has searched, and return geometry_id, map_key and build of all ``scans``."""
    spark = scans.sparkSession
    wanted = stored(wanted_maps(scans, lattice), "wanted")
    known = known_maps(spark, path)
    batch = 0 if known is None else (known.agg(F.max("batch")).first()[0] or 0) + 1
    fresh = wanted.select("map_key", "build").distinct()
    if known is not None:
        fresh = fresh.join(known.select("map_key", "build"), ["map_key", "build"], "left_anti")
    fresh = stored(fresh, "fresh")
    if fresh.isEmpty():
        return wanted
    builds = fresh.select("build").distinct()
    if known is not None:
        builds = builds.join(known.select("build").distinct(), "build", "left_anti")
    # One geometry stands for all with the same build.
    chosen = stored(wanted.join(builds, "build", "left_semi").groupBy("build").agg(F.min("geometry_id").alias("geometry_id")), "chosen")
    if not chosen.isEmpty():
        pairs = search(scans.join(chosen.select("geometry_id"), "geometry_id", "left_semi"))
        named = pairs.join(chosen, "geometry_id").drop("geometry_id")
        named.repartition("build", "gate_id").sortWithinPartitions("build", "gate_id").write.mode("overwrite").parquet(f"{path}/{PAIRS}/batch={batch}")
    fresh.write.mode("overwrite").parquet(f"{path}/{KEYS}/batch={batch}")
    return wanted


def load(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The pairs of all wanted geometries with the ``batch`` in which their map was searched."""
    known = known_maps(spark, path)
    builds = known.groupBy("build").agg(F.min("batch").alias("batch"))
    pairs = spark.read.parquet(f"{path}/{PAIRS}").join(builds, ["build", "batch"], "left_semi")
    used = pairs.join(wanted.select("build").distinct(), "build", "left_semi")
    return for_all(wanted.select("geometry_id", F.col("build").alias("shared_id")), used.withColumnRenamed("build", "geometry_id"))

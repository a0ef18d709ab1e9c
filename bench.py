"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8) choose data and
cores.  Every query runs to the end into a sink that keeps nothing.  The map of a
production-size volume is timed as well: the reference states minutes for it.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from echolattice.config import Lattice  # noqa: E402
from echolattice.operators import neighbours  # noqa: E402
from echolattice.plans import products  # noqa: E402
from echolattice.session import local_session, shared_folder  # noqa: E402
from echolattice.sources import gate_store, geometry_store  # noqa: E402
from workload import load_all, tables  # noqa: E402
from workload.registry import QUERIES  # noqa: E402

HEADLINE = (
    "colmax_product", "neighbours", "knn_gates", "geometry_build", "grid_field", "grid_field_barnes2", "grid_fields",
    "field_products", "column_max", "ppi", "cappi", "polar_colmax", "quality_rules", "despeckle", "quality_filter",
    "label_components", "cores", "tops", "cores_and_tops", "colorize", "overviews_average", "uncolor",
    "payload_to_gates", "current_files", "volume_completeness", "files_for_cleanup", "arrival_summary",
    "nearest_complete_slot", "pivot_fields", "align_fields", "stream_volumes", "stream_out_of_order",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def run(spark, name: str, sf_dir: str) -> None:
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def production_map(spark) -> dict:
    """One map of about 3.5 million gates and 900 thousand voxels, nearest gate."""
    scan = spark.range(20).select(
        F.lit(0).alias("geometry_id"), F.col("id").cast("int").alias("sweep"),
        (F.col("id") * 0.95 + 0.5).alias("elevation"), F.lit(360).alias("nrays"), F.lit(480).alias("ngates"),
        F.lit(500).alias("gate_size"), F.lit(500).alias("gate_offset"),
    )
    lattice = Lattice(
        nz=26, ny=187, nx=187, z_limits=(0.0, 15000.0), y_limits=(-240000.0, 240000.0),
        x_limits=(-240000.0, 240000.0), blind_range_m=500.0, lowest_elevation=0.5,
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    pairs = neighbours.geometry_pairs(tables.scan_gates(scan), scan.select("geometry_id").distinct(), lattice)
    seconds = timed(lambda: pairs.write.format("noop").mode("overwrite").save())
    out = {"seconds": round(seconds, 2), "gates": 20 * 360 * 480, "voxels": 26 * 187 * 187}
    out |= production_colmax(spark, pairs, lattice)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    return out


def production_colmax(spark, pairs, lattice, volumes: int = 4) -> dict:
    """The column maximum of full-size volumes whose gates lie in the buckets of their map, as ingest leaves them."""
    name = f"bench_{uuid.uuid4().hex}"
    cells = spark.range(20 * 360 * 480 * volumes)
    gate = F.col("id") % (20 * 360 * 480)
    noise = F.pmod(F.xxhash64("id"), F.lit(7000)) / 100.0
    gates = cells.select(
        F.expr(f"int(id div {20 * 360 * 480})").alias("volume_id"), F.lit(0).alias("geometry_id"), gate.alias("gate_id"), (noise - 10).alias("DBZH"),
        (1 - noise / 200).alias("RHOHV"), (noise / 20).alias("WRAD"), (noise / 10).alias("ZDR"), ((gate / (360 * 480)).cast("int") * 0.95 + 0.5).alias("elevation"),
    )
    geometry_store.save_bucketed(pairs, f"{name}_map", gate_store.BUCKETS, f"{shared_folder(spark)}/{name}-map")
    stored = timed(lambda: gate_store.save_gates(gates, f"{name}_gates", f"{shared_folder(spark)}/{name}-gates"))
    made = products.colmax_product(spark.table(f"{name}_gates"), spark.table(f"{name}_map"), lattice)
    seconds = timed(lambda: made.write.format("noop").mode("overwrite").save())
    return {"colmax_volumes": volumes, "colmax_store_gates_seconds": round(stored, 2), "colmax_seconds": round(seconds, 2)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    warm_up = timed(lambda: run(spark, "colmax_product", sf_dir))
    seconds = {name: round(timed(lambda n=name: run(spark, n, sf_dir)), 3) for name in HEADLINE}
    volumes = tables.sweeps(spark, sf_dir).select("volume_id").distinct().count()
    production = production_map(spark)
    print(
        json.dumps({
            "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
            "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus,
            "first_query_with_map_build": round(warm_up, 3),
            "colmax_volumes_per_sec": round(volumes / seconds["colmax_product"], 2), "volumes": volumes,
            "production_map_build": production,
        })
    )


if __name__ == "__main__":
    main()

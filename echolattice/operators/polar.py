"""Products on the polar lattice: vertical links and the polar column maximum."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from echolattice.functions import geomath


def vertical_link(
    scans: DataFrame, above: float = -5.0, ceiling_m: float = 20000.0, site_altitude: float = 0.0
) -> DataFrame:
    """For every gate of the reference sweep, the gate above it on each other sweep.

    The first gate, not before the reference gate's index, whose centre lies
    beyond the reference gate's near edge over ground, unless it is above the
    ceiling.  Ground distance on a ray inverts in closed form (law of sines about
    the earth's centre), so no gates are searched.  One map per scan, whatever the
    number of volumes.  Scans with fewer than two usable sweeps have no links.
    """
    earth = geomath.KE * geomath.EARTH_RADIUS
    whole = Window.partitionBy("geometry_id")
    order = whole.orderBy("elevation", "sweep")
    used = scans.filter(F.col("elevation") >= above).withColumns({
        "position": F.row_number().over(order),
        "available": F.count(F.lit(1)).over(whole),
        "ref_elevation": F.first("elevation").over(order),
        "ref_size": F.first("gate_size").over(order),
        "ref_offset": F.first("gate_offset").over(order),
    }).filter(F.col("available") > 1)
    rows = used.withColumn("ref_gate", F.explode(F.sequence(F.lit(0), F.col("ngates") - 1)))

    def ground(range_m, elevation_deg):
        z = F.sqrt(
            range_m * range_m + earth * earth + 2.0 * range_m * earth * F.sin(F.radians(elevation_deg))
        ) - earth
        return earth * F.asin(range_m * F.cos(F.radians(elevation_deg)) / (earth + z))

    ref_range = F.col("ref_offset") + F.col("ref_gate") * F.col("ref_size").cast("double")
    half = (
        ground(F.col("ref_offset") + F.col("ref_size").cast("double"), F.col("ref_elevation"))
        - ground(F.col("ref_offset").cast("double"), F.col("ref_elevation"))
    ) / 2
    edge = ground(ref_range, F.col("ref_elevation")) - half
    angle = edge / earth
    reach = earth * F.sin(angle) / F.cos(F.radians("elevation") + angle)
    found = F.greatest(F.floor((reach - F.col("gate_offset")) / F.col("gate_size")) + 1, F.col("ref_gate"))
    linked = rows.withColumn(
        "gate", F.when(F.col("position") == 1, F.col("ref_gate")).otherwise(found).cast("int")
    ).filter(F.col("gate") < F.col("ngates"))
    range_m = F.col("gate_offset") + F.col("gate") * F.col("gate_size").cast("double")
    height = F.sqrt(
        range_m * range_m + earth * earth + 2.0 * range_m * earth * F.sin(F.radians("elevation"))
    ) - earth + site_altitude
    kept = linked.filter((F.col("position") == 1) | (height <= ceiling_m))
    return kept.select("geometry_id", "sweep", "gate", "ref_gate", "position")


def polar_colmax(gates: DataFrame, links: DataFrame, field: str = "DBZH") -> DataFrame:
    """Highest value over the linked gates of a ray, on the reference sweep's gates.

    The link map has (sweeps x gates) rows per scan; AQE broadcasts it while it is
    small and otherwise joins by shuffle.
    """
    held = gates.filter(F.col(field).isNotNull()).select("volume_id", "geometry_id", "sweep", "ray", "gate", field)
    met = held.join(links.select("geometry_id", "sweep", "gate", "ref_gate"), ["geometry_id", "sweep", "gate"])
    return met.groupBy("volume_id", "ray", F.col("ref_gate").alias("gate")).agg(F.max(field).alias("value"))

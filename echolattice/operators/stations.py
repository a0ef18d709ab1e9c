"""Ground stations against radar sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolattice.functions import geomath

CELL_DEG = 4.0
# Cells of longitude go round: the one past the last is the first.
CELLS_ROUND = int(360 / CELL_DEG)


def stations_in_reach(stations: DataFrame, radars: DataFrame) -> DataFrame:
    """Every (station, radar) within the radar's range, with bearing, ray and gate.

    Stations: ``lon``, ``lat``.  Radars: ``site_lon``, ``site_lat``, ``nrays``,
    ``ngates``, ``gate_size``, ``gate_offset``.  A radar is copied to the degree
    cells its range touches and met by an equi-join, so no station is compared
    with every radar.
    """
    reach_km = F.col("ngates") * F.col("gate_size") / 1000.0
    d_lat = reach_km / 110.0
    d_lon = reach_km / (110.0 * F.greatest(F.cos(F.radians(F.abs("site_lat") + d_lat)), F.lit(0.05)))

    def cells(value, spread):
        return F.sequence(F.floor((value - spread) / CELL_DEG), F.floor((value + spread) / CELL_DEG))

    def wrapped(cell):
        return F.pmod(cell, F.lit(CELLS_ROUND).cast("bigint"))

    columns = F.array_distinct(F.transform(cells(F.col("site_lon"), d_lon), wrapped))
    offered = radars.withColumn("cx", F.explode(columns)).withColumn("cy", F.explode(cells(F.col("site_lat"), d_lat)))
    placed = stations.withColumns(
        {"cx": wrapped(F.floor(F.col("lon") / CELL_DEG)), "cy": F.floor(F.col("lat") / CELL_DEG)}
    )
    met = placed.join(offered, ["cx", "cy"]).drop("cx", "cy")
    azimuth, distance = geomath.bearing_range(F.col("site_lon"), F.col("site_lat"), F.col("lon"), F.col("lat"))
    near = met.withColumns({"bearing": azimuth, "distance_m": distance}).filter(
        F.col("distance_m") < F.col("ngates") * F.col("gate_size")
    )
    return near.withColumns({
        "ray": geomath.nearest_ray(F.col("bearing"), 360.0 / F.col("nrays"), F.col("nrays")),
        "gate": geomath.nearest_gate(F.col("distance_m"), F.col("gate_offset"), F.col("gate_size"), F.col("ngates")),
    })

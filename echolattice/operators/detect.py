"""Convective cores and storm tops."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolattice.config import CoreThresholds, Lattice, TopThresholds
from echolattice.functions import geomath
from echolattice.operators.components import image_runs, label_runs
from echolattice.operators.neighbours import axis
from echolattice.session import cut_lineage

# Strengths and means are compared at single-precision resolution, so that the
# order of a distributed sum cannot reorder equal blobs or flip a threshold.
STRENGTH_DIGITS = 5
MEAN_DIGITS = 6


def _xy(lattice: Lattice) -> tuple[Column, Column]:
    return axis(F.col("ix"), lattice.x_limits, lattice.nx), axis(F.col("iy"), lattice.y_limits, lattice.ny)


def blob_stats(
    pixels: DataFrame, lattice: Lattice, image: Sequence[str] = ("volume_id",), rhohv: str | None = None
) -> DataFrame:
    """Size, centroid, mean and highest value of every component of a pixel mask.

    Sums are taken per run before labelling, so pixels are never relabelled or
    joined back.  ``known_rhohv`` counts pixels with a value, for the rules where
    a missing one spoils the mean.
    """
    x, y = _xy(lattice)
    sums = {
        "sum_x": F.sum(x), "sum_y": F.sum(y), "sum_value": F.sum("value"), "max_value": F.max("value"),
        "sum_rhohv": F.sum(rhohv) if rhohv else F.lit(None).cast("double"),
        "known_rhohv": F.count(rhohv) if rhohv else F.lit(0).cast("bigint"),
    }
    runs = image_runs(pixels, image, "iy", "ix", sums)
    labelled = label_runs(runs, image, lattice.ny, lattice.nx)
    blobs = labelled.groupBy(*image, "label").agg(
        F.sum("pixels").alias("pixel_count"),
        *[F.sum(n).alias(n) for n in ("sum_x", "sum_y", "sum_value", "sum_rhohv", "known_rhohv")],
        F.max("max_value").alias("max_dbz"),
    )
    size = F.col("pixel_count")
    placed = blobs.select(
        *image, "label", "pixel_count",
        (F.col("sum_x") / size).alias("x_m"), (F.col("sum_y") / size).alias("y_m"),
        (F.col("sum_value") / size).alias("mean_dbz"), "max_dbz",
        F.when(F.col("known_rhohv") == size, F.round(F.col("sum_rhohv") / size, MEAN_DIGITS)).alias("mean_rhohv"),
        "known_rhohv",
    )
    return placed.withColumn("range_m", F.sqrt(F.col("x_m") * F.col("x_m") + F.col("y_m") * F.col("y_m")))


def _choose(radius: float):
    """Greedy choice within one group, as a grid of kept candidates with cells of the radius."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        x, y = group["x_m"].to_numpy(), group["y_m"].to_numpy()
        edge = radius if radius > 0 else 1.0
        cx, cy = np.floor(x / edge).astype(np.int64), np.floor(y / edge).astype(np.int64)
        cells: dict[tuple[int, int], list[int]] = {}
        kept = []
        for i in np.lexsort((group["tie"].to_numpy(), -group["strength"].to_numpy())):
            around = (cells.get((cx[i] + a, cy[i] + b), ()) for a in (-1, 0, 1) for b in (-1, 0, 1))
            if all(math.hypot(x[j] - x[i], y[j] - y[i]) >= radius for near in around for j in near):
                cells.setdefault((cx[i], cy[i]), []).append(i)
                kept.append(i)
        return group.iloc[kept]

    return run


def _rounds(candidates: DataFrame, keys: Sequence[str], radius: float) -> DataFrame:
    """The same choice without gathering a group: rounds over cells, until all is decided.

    Cells are so small that two candidates of one cell are always too close, so a
    cell offers its strongest only.  An offer without a stronger undecided candidate
    within the radius is kept, and what it covers is dropped.  No pairs within a
    cell are formed, and offers far apart never wait for each other.
    """
    if radius <= 0:
        return candidates  # nothing is closer than that
    keys = list(keys)
    edge = radius / math.sqrt(2)
    cells = candidates.withColumns({
        "cx": F.floor(F.col("x_m") / edge), "cy": F.floor(F.col("y_m") / edge),
        "order": F.struct(F.col("strength"), (-F.col("tie")).alias("tie")),
    })
    reach = F.sequence(F.lit(-2), F.lit(2))

    def around(df: DataFrame) -> DataFrame:
        wide = df.withColumn("__dx", F.explode(reach)).withColumn("__dy", F.explode(reach))
        return wide.withColumn("cx", F.col("cx") + F.col("__dx")).withColumn("cy", F.col("cy") + F.col("__dy"))

    dx, dy = F.col("x_m") - F.col("ox"), F.col("y_m") - F.col("oy")
    near = F.sqrt(dx * dx + dy * dy) < radius
    placed = [F.col("x_m").alias("ox"), F.col("y_m").alias("oy"), F.col("order").alias("offer")]
    active = cut_lineage(cells)
    chosen = None
    while not active.isEmpty():
        best = active.groupBy(*keys, "cx", "cy").agg(F.max("order").alias("order"))
        offers = active.join(best, [*keys, "cx", "cy", "order"])
        met = active.join(around(offers.select(*keys, "cx", "cy", *placed)).select(*keys, "cx", "cy", "ox", "oy", "offer"), [*keys, "cx", "cy"])
        blocked = met.filter(near & (F.col("order") > F.col("offer"))).select(*keys, F.col("offer").alias("order")).distinct()
        kept = cut_lineage(offers.join(blocked, [*keys, "order"], "left_anti").select(*active.columns))
        covering = around(kept.select(*keys, "cx", "cy", *placed)).select(*keys, "cx", "cy", "ox", "oy")
        covered = active.join(covering, [*keys, "cx", "cy"]).filter(near).select(*keys, "order").distinct()
        settled = covered.union(kept.select(*keys, "order")).distinct()
        active = cut_lineage(active.join(settled, [*keys, "order"], "left_anti").select(*active.columns))
        chosen = kept if chosen is None else chosen.union(kept)
    return candidates if chosen is None else chosen.drop("cx", "cy", "order")


def greedy_dedup(
    candidates: DataFrame, radius: float, keys: Sequence[str] = ("volume_id",), rounds: bool = False
) -> DataFrame:
    """Strongest first, keep a candidate unless a kept one is strictly closer than the radius.

    Candidates have ``strength`` (descending), ``tie`` (ascending, unique) and a
    position.  Sequential by nature, so not an anti-join of pairs.  A group is a
    volume, whose lattice bounds its candidates, and is decided in one task in time linear in them.
    ``rounds`` is for callers whose groups have no such bound.
    """
    if rounds:
        return _rounds(candidates, keys, radius)
    return candidates.groupBy(*keys).applyInPandas(_choose(radius), candidates.schema)


CORE_COLUMNS = ("volume_id", "label", "x_m", "y_m", "mean_dbz", "max_dbz", "pixel_count", "range_m")
TOP_COLUMNS = (
    "volume_id", "level_index", "label", "x_m", "y_m", "altitude_m", "altitude_km", "pixel_count", "range_m",
)


def core_candidates(
    colmax: DataFrame, lattice: Lattice, rhohv: DataFrame | str | None = None, t: CoreThresholds = CoreThresholds()
) -> DataFrame:
    """Blobs of the column maximum that pass the quality gate.

    ``rhohv`` is a table of pixels or the name of a column of ``colmax``.  A pixel without it spoils the blob's mean, and the
    RhoHV path then fails.
    """
    own = [F.col(rhohv).alias("rhohv")] if isinstance(rhohv, str) else []
    mask = colmax.select("volume_id", "iy", "ix", "value", *own).filter(F.col("value") >= t.min_dbz)
    if rhohv is not None and not own:
        keyed = rhohv.select("volume_id", "iy", "ix", F.col("value").alias("rhohv"))
        mask = mask.join(keyed, ["volume_id", "iy", "ix"], "left")
    blobs = blob_stats(mask, lattice, rhohv=None if rhohv is None else "rhohv")
    by_rhohv = F.coalesce((F.col("pixel_count") > t.min_pixels) & (F.col("mean_rhohv") > t.rhohv), F.lit(False))
    by_updraft = (F.col("max_dbz") > t.min_dbz_updraft) & (F.col("pixel_count") > t.min_pixels_updraft)
    return blobs.filter(
        (F.col("pixel_count") > 1) & (F.col("range_m") >= t.min_range_m) & (by_rhohv | by_updraft)
    ).select(*CORE_COLUMNS)


def cores(
    colmax: DataFrame, lattice: Lattice, rhohv: DataFrame | str | None = None, t: CoreThresholds = CoreThresholds()
) -> DataFrame:
    """Convective cores of every volume."""
    found = core_candidates(colmax, lattice, rhohv, t)
    ranked = found.withColumns({"strength": F.round("mean_dbz", STRENGTH_DIGITS), "tie": F.col("label")})
    return greedy_dedup(ranked, t.dedup_radius_m).select(*CORE_COLUMNS)


def top_candidates(
    voxels: DataFrame, lattice: Lattice, rhohv: str | None = None, t: TopThresholds = TopThresholds(),
    altitude: str | None = None,
) -> DataFrame:
    """Blobs of each level that are high, far and large enough.

    ``rhohv`` names a voxel column; a pixel without it spoils the blob's mean,
    and the blob is then kept.  ``altitude`` names a column of voxel heights where
    levels are not flat.
    """
    x, y = _xy(lattice)
    mask = voxels.filter((F.col("value") >= t.min_dbz) & (F.sqrt(x * x + y * y) >= t.min_range_m))
    if altitude is None:
        blobs = blob_stats(mask, lattice, ("volume_id", "iz"), rhohv)
        blobs = blobs.withColumn("altitude_m", axis(F.col("iz"), lattice.z_limits, lattice.nz))
    else:
        # The mean height rides in the value slot of a second pass over the same runs.
        blobs = blob_stats(mask.withColumn("value", F.col(altitude)), lattice, ("volume_id", "iz"), rhohv)
        blobs = blobs.withColumn("altitude_m", F.col("mean_dbz"))
    kept = blobs.filter(
        (F.col("pixel_count") > t.min_pixels)
        & (F.col("altitude_m") > t.min_altitude_m)
        & (F.col("range_m") >= t.min_range_m)
    )
    if rhohv is not None:
        kept = kept.filter(F.coalesce(F.col("mean_rhohv") > t.rhohv, F.lit(True)))
    return kept.withColumns(
        {"level_index": F.col("iz"), "altitude_km": F.bround(F.col("altitude_m") / 1000.0, 1)}
    ).select(*TOP_COLUMNS)


def tops(
    voxels: DataFrame, lattice: Lattice, rhohv: str | None = None, t: TopThresholds = TopThresholds(),
    altitude: str | None = None,
) -> DataFrame:
    """Storm tops of every volume; of two close ones the higher stays."""
    found = top_candidates(voxels, lattice, rhohv, t, altitude)
    plane = lattice.ny * lattice.nx
    ranked = found.withColumns({
        "strength": F.round("altitude_m", STRENGTH_DIGITS),
        "tie": F.col("level_index").cast("bigint") * plane + F.col("label"),
    })
    return greedy_dedup(ranked, t.dedup_radius_m).select(*TOP_COLUMNS)


def with_lonlat(found: DataFrame, sites: DataFrame) -> DataFrame:
    """Longitude and latitude of features about their radar's site."""
    lon, lat = geomath.xy_to_lonlat(F.col("x_m"), F.col("y_m"), F.col("site_lon"), F.col("site_lat"))
    return found.join(sites, "volume_id").withColumns({"lon": lon, "lat": lat}).drop("site_lon", "site_lat")


def features(core_rows: DataFrame, top_rows: DataFrame) -> DataFrame:
    """Cores and tops as one table; the kind orders a volume's cores before its tops."""
    one = core_rows.select(
        "volume_id", F.lit("core").alias("kind"), F.lit(-1).alias("level_index"), "label", "x_m", "y_m", "lon", "lat",
        F.col("mean_dbz").cast("int").alias("intensity_dbz"), F.lit(None).cast("int").alias("altitude_m"),
        "pixel_count",
    )
    two = top_rows.select(
        "volume_id", F.lit("top").alias("kind"), "level_index", "label", "x_m", "y_m", "lon", "lat",
        F.lit(None).cast("int").alias("intensity_dbz"), F.col("altitude_m").cast("int").alias("altitude_m"),
        "pixel_count",
    )
    return one.unionByName(two)

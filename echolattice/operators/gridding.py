"""Gates to voxels, and voxels to two-dimensional products."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolattice.config import Lattice
from echolattice.functions import geomath
from echolattice.operators.neighbours import axis, with_indices
from echolattice.session import spread


def grid_fields(
    gates: DataFrame, pairs: DataFrame, lattice: Lattice, fields: Mapping[str, tuple[str, Column | None]],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Weighted mean of many fields per voxel in one join and at most one shuffle.

    Gates and map in equal buckets (:mod:`echolattice.sources.gate_store`) are joined without an
    exchange.  ``keep``: columns that are constant in a volume and stay with its voxels.

    ``fields`` maps an output name to (source field, exclusion predicate).  An
    excluded or missing gate leaves numerator and denominator; a voxel with no
    weight left has NULL, and a voxel with nothing at all has no row.  A
    one-neighbour map needs no aggregation: the gate's value is the voxel's.
    """
    values = {
        name: F.col(source) if drop is None else F.when(~F.coalesce(drop, F.lit(False)), F.col(source))
        for name, (source, drop) in fields.items()
    }
    narrow = gates.select("volume_id", "geometry_id", "gate_id", *keep, *[v.alias(n) for n, v in values.items()])
    narrow = narrow.filter(F.coalesce(*[F.col(n) for n in values]).isNotNull())
    joined = narrow.join(pairs, ["geometry_id", "gate_id"])
    if lattice.max_neighbors == 1:
        voxels = joined.select("volume_id", "voxel_id", *keep, *values)
    else:
        sums = []
        for name in values:
            mass = F.sum(F.when(F.col(name).isNotNull(), F.col("weight")))
            total = F.sum(F.col("weight") * F.col(name))
            sums.append(F.when(mass > 0, total / mass).alias(name))
        voxels = joined.groupBy("volume_id", "voxel_id", *keep).agg(*sums)
        voxels = voxels.filter(F.coalesce(*[F.col(n) for n in values]).isNotNull())
    return with_indices(voxels, lattice)


def grid_field(
    gates: DataFrame, pairs: DataFrame, lattice: Lattice, field: str, exclude: Column | None = None
) -> DataFrame:
    """One field as ``value`` per voxel."""
    return grid_fields(gates, pairs, lattice, {"value": (field, exclude)})


def fill_lattice(voxels: DataFrame, volumes: DataFrame, lattice: Lattice, fill: float) -> DataFrame:
    """Dense voxels of every volume, ``fill`` where nothing is known."""
    lines = volumes.select("volume_id").withColumn(
        "line", F.explode(F.sequence(F.lit(0), F.lit(lattice.nz * lattice.ny - 1)))
    )
    cells = spread(lines, "volume_id", "line").withColumn(
        "ix", F.explode(F.sequence(F.lit(0), F.lit(lattice.nx - 1)))
    )
    frame = cells.select("volume_id", (F.col("line").cast("bigint") * lattice.nx + F.col("ix")).alias("voxel_id"))
    dense = frame.join(voxels.select("volume_id", "voxel_id", "value"), ["volume_id", "voxel_id"], "left")
    return with_indices(dense.withColumn("value", F.coalesce("value", F.lit(fill))), lattice)


def level_bounds(
    lattice: Lattice,
    z_min_idx: int | None = None,
    z_max_idx: int | None = None,
    z_min_alt: float | None = None,
    z_max_alt: float | None = None,
) -> tuple[int, int]:
    """Inclusive index range; altitudes win over indices, both ends inclusive."""
    levels = [lattice.z_at(i) for i in range(lattice.nz)]
    if z_min_alt is not None:
        z_min_idx = sum(1 for z in levels if z < z_min_alt)
    if z_max_alt is not None:
        z_max_idx = sum(1 for z in levels if z <= z_max_alt) - 1
    low = 0 if z_min_idx is None else max(0, z_min_idx)
    high = lattice.nz - 1 if z_max_idx is None else min(lattice.nz - 1, z_max_idx)
    return low, high


def column_aggregate(voxels: DataFrame, lattice: Lattice, how: str = "max", **bounds) -> DataFrame:
    """Per-pixel max, min or mean over a range of levels; no valid voxel, no row."""
    low, high = level_bounds(lattice, **bounds)
    aggregate = {"max": F.max, "min": F.min, "mean": F.avg}[how]
    part = voxels.filter(F.col("value").isNotNull())
    if (low, high) != (0, lattice.nz - 1):
        part = part.filter(F.col("iz").between(low, high))
    return part.groupBy("volume_id", "iy", "ix").agg(aggregate("value").alias("value"))


def ground_distance(lattice: Lattice) -> Column:
    x = axis(F.col("ix"), lattice.x_limits, lattice.nx)
    y = axis(F.col("iy"), lattice.y_limits, lattice.ny)
    return F.sqrt(x * x + y * y)


def ppi(
    voxels: DataFrame,
    lattice: Lattice,
    elevation: Column | float,
    interpolation: str = "linear",
    curved: bool = True,
    values: tuple[str, ...] = ("value",),
) -> DataFrame:
    """Values on the beam surface of one elevation (a column allows one per volume).

    A pixel's two levels follow from its own indices, so voxels are filtered, not
    joined.  Linear falls back to the one valid level; outside the lattice there
    is no row.
    """
    height = geomath.beam_height if curved else geomath.beam_height_flat
    target = height(ground_distance(lattice), elevation)
    z_min, z_max = lattice.z_limits
    fraction = (target - z_min) / lattice.z_step
    if interpolation == "nearest":
        return voxels.filter(F.col("iz") == F.rint(fraction)).select("volume_id", "iy", "ix", *values)
    if interpolation != "linear":
        raise ValueError(f"unknown interpolation: {interpolation}")
    low = F.floor(fraction)
    high = F.least(low + 1, F.lit(lattice.nz - 1))
    near = (
        voxels.withColumns({"target": target, "low": low, "high": high, "share": fraction - low})
        .filter((F.col("target") >= z_min) & (F.col("target") <= z_max))
        .filter((F.col("iz") == F.col("low")) | (F.col("iz") == F.col("high")))
    )
    picked = near.groupBy("volume_id", "iy", "ix").agg(
        F.max("share").alias("share"),
        *[F.max(F.when(F.col("iz") == F.col("low"), F.col(v))).alias(f"{v}__low") for v in values],
        *[F.max(F.when(F.col("iz") == F.col("high"), F.col(v))).alias(f"{v}__high") for v in values],
    )
    blended = {
        v: F.coalesce(
            (1 - F.col("share")) * F.col(f"{v}__low") + F.col("share") * F.col(f"{v}__high"),
            F.col(f"{v}__low"),
            F.col(f"{v}__high"),
        )
        for v in values
    }
    out = picked.select("volume_id", "iy", "ix", *[c.alias(v) for v, c in blended.items()])
    return out.filter(F.coalesce(*[F.col(v) for v in values]).isNotNull())


def column_and_surface(voxels: DataFrame, lattice: Lattice, elevation: str, field: str) -> DataFrame:
    """Column maximum of ``value``, with ``field`` on the beam surface of the volume's elevation beside it, in one aggregate.

    ``elevation`` is a column of the voxels.  The field's levels of a pixel, as many as the lattice has, travel in one row, so the
    surface (:func:`ppi`, linear) is worked out once a pixel, and nothing is joined.
    """
    levels = [F.max(F.when(F.col("iz") == i, F.col(field))).alias(f"__level{i}") for i in range(lattice.nz)]
    pixels = voxels.groupBy("volume_id", elevation, "iy", "ix").agg(F.max("value").alias("value"), *levels)
    target = geomath.beam_height(ground_distance(lattice), F.col(elevation))
    z_min, z_max = lattice.z_limits
    fraction = (target - z_min) / lattice.z_step
    column = F.array(*[F.col(f"__level{i}") for i in range(lattice.nz)])
    at = F.floor("__fraction").cast("int")
    low, high = F.get(column, at), F.get(column, F.least(at + 1, F.lit(lattice.nz - 1)))
    share = F.col("__fraction") - at
    inside = (F.col("__target") >= z_min) & (F.col("__target") <= z_max)
    placed = pixels.filter(F.col("value").isNotNull()).withColumns({"__target": target, "__fraction": fraction})
    blended = F.when(inside, F.coalesce((1 - share) * low + share * high, low, high))
    return placed.select("volume_id", "iy", "ix", "value", blended.alias(field))


def cappi(voxels: DataFrame, lattice: Lattice, altitude: float, interpolation: str = "linear") -> DataFrame:
    """Horizontal slice at an altitude; linear propagates a missing level."""
    z_min, z_max = lattice.z_limits
    if altitude < z_min or altitude > z_max:
        return voxels.filter(F.lit(False)).select("volume_id", "iy", "ix", "value")
    levels = [lattice.z_at(i) for i in range(lattice.nz)]

    def one(level: int) -> DataFrame:
        return voxels.filter((F.col("iz") == level) & F.col("value").isNotNull()).select(
            "volume_id", "iy", "ix", "value"
        )

    if interpolation == "nearest":
        return one(min(range(lattice.nz), key=lambda i: (abs(levels[i] - altitude), i)))
    if interpolation != "linear":
        raise ValueError(f"unknown interpolation: {interpolation}")
    for i, z in enumerate(levels):
        if abs(z - altitude) <= 1e-8 + 1e-6 * abs(altitude):
            return one(i)
    fraction = (altitude - z_min) / lattice.z_step
    low = int(fraction // 1)
    share = fraction - low
    both = voxels.filter(F.col("iz").isin(low, low + 1)).groupBy("volume_id", "iy", "ix").agg(
        F.max(F.when(F.col("iz") == low, F.col("value"))).alias("low"),
        F.max(F.when(F.col("iz") == low + 1, F.col("value"))).alias("high"),
    )
    value = (1 - share) * F.col("low") + share * F.col("high")
    return both.select("volume_id", "iy", "ix", value.alias("value")).filter(F.col("value").isNotNull())


def cross_section(voxels: DataFrame, lattice: Lattice, iy: int | None = None, ix: int | None = None) -> DataFrame:
    """Vertical plane at a row (x-z) or a column (y-z); the centre row by default."""
    if ix is not None:
        return voxels.filter(F.col("ix") == ix).select("volume_id", "iz", "iy", "value")
    row = lattice.ny // 2 if iy is None else iy
    return voxels.filter(F.col("iy") == row).select("volume_id", "iz", "ix", "value")


def level_slice(voxels: DataFrame, levels: list[int]) -> DataFrame:
    return voxels.filter(F.col("iz").isin(levels))


# --- pixel filters: failing pixels become ``fill`` (missing by default) ----


def mask_pixels(pixels: DataFrame, failing: Column, fill: float | None = None) -> DataFrame:
    """Replace the value of failing pixels; any boolean column will do."""
    kept = F.when(F.coalesce(failing, F.lit(False)), F.lit(fill).cast("double")).otherwise(F.col("value"))
    return pixels.withColumn("value", kept)


def mask_below(pixels: DataFrame, limit: float, fill: float | None = None) -> DataFrame:
    return mask_pixels(pixels, F.col("value") < limit, fill)


def mask_above(pixels: DataFrame, limit: float, fill: float | None = None) -> DataFrame:
    return mask_pixels(pixels, F.col("value") > limit, fill)


def mask_outside(pixels: DataFrame, low: float, high: float, fill: float | None = None) -> DataFrame:
    return mask_pixels(pixels, (F.col("value") < low) | (F.col("value") > high), fill)


def fill_missing(pixels: DataFrame, volumes: DataFrame, lattice: Lattice, fill: float) -> DataFrame:
    """Dense pixels of every volume with missing ones filled."""
    lines = volumes.select("volume_id").withColumn("iy", F.explode(F.sequence(F.lit(0), F.lit(lattice.ny - 1))))
    frame = spread(lines, "volume_id", "iy").withColumn("ix", F.explode(F.sequence(F.lit(0), F.lit(lattice.nx - 1))))
    dense = frame.join(pixels, ["volume_id", "iy", "ix"], "left")
    return dense.withColumn("value", F.coalesce("value", F.lit(fill)))


def geometry_stats(pairs: DataFrame, lattice: Lattice) -> DataFrame:
    """Points, pairs, mean neighbours per point and a size estimate per geometry."""
    points = lattice.nz * lattice.ny * lattice.nx
    # Index and weight of a pair, and one offset per point, at four bytes each.
    size = (F.col("pairs") * 8 + (points + 1) * 4).cast("bigint")
    return (
        pairs.groupBy("geometry_id")
        .agg(F.count(F.lit(1)).alias("pairs"))
        .select(
            "geometry_id",
            F.lit(points).cast("bigint").alias("points"),
            "pairs",
            (F.col("pairs") / points).alias("mean_neighbours"),
            size.alias("bytes"),
            F.lit(lattice.z_step).alias("z_step"),
        )
    )


def map_fit(pairs: DataFrame, sweeps: DataFrame) -> DataFrame:
    """Whether each volume has every gate its map refers to.

    Sizes come from the sweep table: gate rows leave out missing gates.
    """
    needed = pairs.groupBy("geometry_id").agg((F.max("gate_id") + 1).alias("needed"))
    held = sweeps.groupBy("volume_id", "geometry_id").agg(
        (F.sum("nrays") * F.max("ngates")).cast("bigint").alias("held")
    )
    fits = F.col("needed") <= F.col("held")
    return held.join(needed, "geometry_id").select(
        "volume_id", "geometry_id", "held", "needed", fits.alias("fits"),
        F.when(~fits, "map is for larger radar dimensions").alias("reason"),
    )


def apply_map(gates: DataFrame, pairs: DataFrame, sweeps: DataFrame) -> DataFrame:
    """Gate rows of fitting volumes joined to the map."""
    good = map_fit(pairs, sweeps).filter("fits").select("volume_id")
    return gates.join(good, "volume_id", "left_semi").join(pairs, ["geometry_id", "gate_id"])

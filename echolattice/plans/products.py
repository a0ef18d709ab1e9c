"""Composed products: from a gate table to two-dimensional products."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolattice.config import ColmaxThresholds, CoreThresholds, Lattice, TopThresholds
from echolattice.operators import detect, filters, gridding
from echolattice.session import stored
from echolattice.sources import gate_store


def filtered_voxels(gates: DataFrame, pairs: DataFrame, lattice: Lattice, field: str = "DBZH") -> DataFrame:
    """One field on the lattice after the column-maximum chain."""
    kept = filters.colmax_filter(gates).apply(gates)
    return gridding.grid_field(kept, pairs, lattice, field)


def colmax_product(
    gates: DataFrame,
    pairs: DataFrame,
    lattice: Lattice,
    field: str = "DBZH",
    floor_dbz: float | None = ColmaxThresholds.floor_dbz,
) -> DataFrame:
    """The highest value above each ground pixel, per volume, after quality control.

    ``floor_dbz=None`` gives the unfiltered twin, which keeps the gate chain and
    only leaves the final floor out.
    """
    pixels = gridding.column_aggregate(filtered_voxels(gates, pairs, lattice, field), lattice, "max")
    if floor_dbz is None:
        return pixels
    return gridding.mask_below(pixels, floor_dbz).filter(F.col("value").isNotNull())


def field_products(
    gates: DataFrame,
    pairs: DataFrame,
    lattice: Lattice,
    sweeps: DataFrame,
    fields: Sequence[str],
    filtered_fields: Sequence[str],
    raw_of: Mapping[str, str] | None = None,
) -> DataFrame:
    """Every field on the beam surface of its volume's lowest sweep, raw and filtered.

    All fields and both variants go through one join and one aggregation.  Stored gates carry the lowest elevation.
    ``raw_of`` names the raw reflectivity that stands in for a field's raw variant
    where the table has it.
    """
    wanted = field_variants(gates, fields, filtered_fields, raw_of)
    if gate_store.LOWEST not in gates.columns:
        gates = gate_store.with_lowest(gates, sweeps)
    voxels = gridding.grid_fields(gates, pairs, lattice, wanted, keep=[gate_store.LOWEST])
    return field_surface(voxels, lattice, tuple(wanted))


def field_variants(
    gates: DataFrame, fields: Sequence[str], filtered_fields: Sequence[str], raw_of: Mapping[str, str] | None = None
) -> dict[str, tuple[str, Column | None]]:
    """What :func:`gridding.grid_fields` is to make of every field, raw and filtered, by ``field__variant``."""
    have = set(gates.columns)
    bad = filters.field_filter(gates).excluded
    wanted: dict[str, tuple[str, Column | None]] = {}
    for name in fields:
        source = (raw_of or {}).get(name, name)
        source = source if source in have else name
        if source in have:
            wanted[f"{name}__raw"] = (source, None)
    for name in filtered_fields:
        if name in have:
            wanted[f"{name}__filtered"] = (name, bad)
    return wanted


def field_surface(voxels: DataFrame, lattice: Lattice, names: tuple[str, ...]) -> DataFrame:
    """Variants (``field__variant``) on the beam surface of the lowest sweep of their volume, which voxels carry."""
    surface = gridding.ppi(voxels.filter(F.col(gate_store.LOWEST).isNotNull()), lattice, F.col(gate_store.LOWEST), values=names)
    long = surface.unpivot(["volume_id", "iy", "ix"], list(names), "variant", "value")
    parts = F.split("variant", "__")
    return long.filter(F.col("value").isNotNull()).select(
        "volume_id", parts[0].alias("field"), (parts[1] == "filtered").alias("filtered"), "iy", "ix", "value"
    )


def one_gridding(
    gates: DataFrame, pairs: DataFrame, lattice: Lattice, fields: Sequence[str], filtered_fields: Sequence[str],
    raw_of: Mapping[str, str] | None = None, rhohv_hole: Column | None = None,
) -> DataFrame:
    """Voxels for all three products, gridded once and written by column; gates carry their volume's lowest elevation.

    Columns: the variants of all fields, ``colmax`` (filtered for the column maximum), ``value`` and, where there is RhoHV,
    ``rhohv`` for detection.
    """
    wanted = field_variants(gates, fields, filtered_fields, raw_of)
    wanted["colmax"] = ("DBZH", filters.colmax_filter(gates).excluded)
    wanted |= detection_variants(gates, rhohv_hole)
    return stored(gridding.grid_fields(gates, pairs, lattice, wanted, keep=[gate_store.LOWEST]), "voxels")


def products_of(
    voxels: DataFrame, lattice: Lattice, lowest: DataFrame | None, sites: DataFrame, floor_dbz: float = ColmaxThresholds.floor_dbz
) -> dict[str, DataFrame]:
    """Column maximum, fields and features from the voxels of :func:`one_gridding`; each reads the columns it needs."""
    places = ["volume_id", "voxel_id", "iz", "iy", "ix", gate_store.LOWEST]
    pixels = gridding.column_aggregate(voxels.select(*places, F.col("colmax").alias("value")), lattice, "max")
    variants = tuple(c for c in voxels.columns if "__" in c)
    detected = voxels.select(*places, *[c for c in ("value", "rhohv") if c in voxels.columns]).filter(F.coalesce(*[F.col(c) for c in ("value", "rhohv") if c in voxels.columns]).isNotNull())
    return {
        "colmax": gridding.mask_below(pixels, floor_dbz).filter(F.col("value").isNotNull()),
        "fields": field_surface(voxels, lattice, variants),
        "features": detected_features(detected, lattice, lowest, sites),
    }


def detection_voxels(
    gates: DataFrame, pairs: DataFrame, lattice: Lattice, rhohv_hole: Column | None = None
) -> DataFrame:
    """Reflectivity as measured (``value``), no gate filtered, with RhoHV beside it where the table has it.

    The lowest elevation that stored gates carry stays with the voxels.
    """
    keep = [c for c in (gate_store.LOWEST,) if c in gates.columns]
    return gridding.grid_fields(gates, pairs, lattice, detection_variants(gates, rhohv_hole), keep=keep)


def detection_variants(gates: DataFrame, rhohv_hole: Column | None = None) -> dict[str, tuple[str, Column | None]]:
    wanted: dict[str, tuple[str, Column | None]] = {"value": ("DBZH", None)}
    if "RHOHV" in gates.columns:
        wanted["rhohv"] = ("RHOHV", rhohv_hole)
    return wanted


def rhohv_surface(voxels: DataFrame, lattice: Lattice, lowest: DataFrame) -> DataFrame:
    """RhoHV on the beam surface of each volume's lowest sweep."""
    held = voxels.filter(F.col("rhohv").isNotNull()).join(lowest, "volume_id")
    surface = gridding.ppi(held, lattice, F.col("elevation"), values=("rhohv",))
    return surface.withColumnRenamed("rhohv", "value")


def cores_and_tops(
    voxels: DataFrame,
    lattice: Lattice,
    lowest: DataFrame | None,
    sites: DataFrame,
    core_limits: CoreThresholds = CoreThresholds(),
    top_limits: TopThresholds = TopThresholds(),
) -> DataFrame:
    """Cores and tops of every volume as features with longitude and latitude.

    ``voxels`` come from :func:`detection_voxels`; cores judge RhoHV on the beam
    surface of the lowest sweep (``lowest``: volume_id, elevation), or on the lowest level without one; where
    the volumes have no RhoHV both go on without its gate.  Column maximum,
    beam surface and tops all read the voxels, so these are stored once, by column: gates are
    scanned and joined to the map a single time, and each reader takes the columns and rows it needs.
    """
    return detected_features(stored(voxels, "voxels"), lattice, lowest, sites, core_limits, top_limits)


def detected_features(
    voxels: DataFrame, lattice: Lattice, lowest: DataFrame | None, sites: DataFrame,
    core_limits: CoreThresholds = CoreThresholds(), top_limits: TopThresholds = TopThresholds(),
) -> DataFrame:
    """:func:`cores_and_tops` from voxels that are stored already."""
    rhohv = "rhohv" if "rhohv" in voxels.columns else None
    surface: DataFrame | str | None = None
    if rhohv and lowest is not None and gate_store.LOWEST in voxels.columns:
        colmax, surface = gridding.column_and_surface(voxels, lattice, gate_store.LOWEST, rhohv), rhohv
    else:
        colmax = gridding.column_aggregate(voxels, lattice)
    if surface is None and rhohv and lowest is not None:
        surface = rhohv_surface(voxels, lattice, lowest)
    elif surface is None and rhohv:
        surface = gridding.level_slice(voxels.drop("value").withColumnRenamed("rhohv", "value"), [0])
    cores = detect.with_lonlat(detect.cores(colmax, lattice, surface, core_limits), sites)
    tops = detect.with_lonlat(detect.tops(voxels, lattice, rhohv, top_limits), sites)
    return detect.features(cores, tops)

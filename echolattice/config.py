"""Thresholds and lattice parameters as frozen values."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: operational thresholds --------------------------------
FIELDS = ("DBZH", "DBZV", "ZDR", "RHOHV", "PHIDP", "KDP", "VRAD", "WRAD", "CM")
FIELD_ALIASES = {
    "reflectivity": "DBZH",
    "cross_correlation_ratio": "RHOHV",
    "spectrum_width": "WRAD",
    "differential_reflectivity": "ZDR",
    "velocity": "VRAD",
    "clutter_map": "CM",
    "colmax": "COLMAX",
}
VOLUME_TYPES = {"0315": {"01": ["DBZH", "DBZV", "ZDR", "RHOHV", "PHIDP", "KDP"], "02": ["VRAD", "WRAD"]}}
LOCAL_ZONE = "America/Argentina/Cordoba"
RESUME_BUFFER_MINUTES = 60


def concrete_field(name: str) -> str:
    """The stored name of a field, given either its stored or its descriptive name."""
    return FIELD_ALIASES.get(name, name)


@dataclass(frozen=True)
class ColmaxThresholds:
    min_elevation: float = 0.65
    rhohv: float = 0.8
    wrad: float = 4.6
    zdr: float = 8.5
    floor_dbz: float = -3.0


@dataclass(frozen=True)
class QualityThresholds:
    rhohv: float = 0.55
    wrad: float = 4.6
    refl: float = -3.0
    zdr: float = 8.5
    keep_refl: float = 25.0
    clutter_rhohv: float = 0.85
    mean_rhohv: float = 0.85
    despeckle_metres: float = 19000.0


@dataclass(frozen=True)
class CoreThresholds:
    min_dbz: float = 52.0
    min_dbz_updraft: float = 56.0
    min_range_m: float = 12000.0
    dedup_radius_m: float = 8000.0
    rhohv: float = 0.85
    min_pixels: int = 2
    min_pixels_updraft: int = 5


@dataclass(frozen=True)
class TopThresholds:
    min_range_m: float = 25000.0
    min_altitude_m: float = 9000.0
    min_dbz: float = 20.0
    rhohv: float = 0.94
    dedup_radius_m: float = 17000.0
    min_pixels: int = 2


@dataclass(frozen=True)
class Lattice:
    """One Cartesian lattice and the rules that tie gates to its voxels."""

    nz: int
    ny: int
    nx: int
    z_limits: tuple[float, float]
    y_limits: tuple[float, float]
    x_limits: tuple[float, float]
    h_factor: float = 1.02
    nb: float = 1.45
    bsp: float = 1.2
    min_radius: float = 900.0
    toa: float = 15000.0
    blind_range_m: float = 0.0
    lowest_elevation: float | None = None
    max_neighbors: int | None = 1
    weighting: str = "nearest"

    @property
    def z_step(self) -> float:
        return (self.z_limits[1] - self.z_limits[0]) / (self.nz - 1) if self.nz > 1 else 1.0

    @property
    def y_step(self) -> float:
        return (self.y_limits[1] - self.y_limits[0]) / (self.ny - 1) if self.ny > 1 else 1.0

    @property
    def x_step(self) -> float:
        return (self.x_limits[1] - self.x_limits[0]) / (self.nx - 1) if self.nx > 1 else 1.0

    def z_at(self, iz: int) -> float:
        return self.z_limits[0] + iz * self.z_step

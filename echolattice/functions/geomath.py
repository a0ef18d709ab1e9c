"""Beam, gate and map geometry as column expressions.

Three earths are in use on purpose: 4/3 of 6 371 000 m for beams, 8.49e6 m for
the quick beam-top estimate, 6367 km for great circles.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS = 6371000.0
KE = 4.0 / 3.0
GREAT_CIRCLE_KM = 6367.0
BEAM_TOP_EARTH = 8.49e6
SPHERE_M = 6370997.0
MERCATOR_M = 6378137.0

Num = Column | float | int


def _c(value: Num) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def beam_height(distance: Num, elevation_deg: Num, site_altitude: Num = 0.0, ke: float = KE) -> Column:
    """Height of the beam centre over a ground distance, curved earth."""
    earth = ke * EARTH_RADIUS
    angle = F.radians(_c(elevation_deg))
    slant = _c(distance) / F.greatest(F.cos(angle), F.lit(0.01))
    return F.sqrt(slant * slant + earth * earth + 2 * slant * earth * F.sin(angle)) - earth + _c(site_altitude)


def beam_height_simple(distance: Num, elevation_deg: Num, site_altitude: Num = 0.0, ke: float = KE) -> Column:
    angle = F.radians(_c(elevation_deg))
    slant = _c(distance) / F.greatest(F.cos(angle), F.lit(0.01))
    return slant * F.sin(angle) + slant * slant / (2 * ke * EARTH_RADIUS) + _c(site_altitude)


def beam_height_flat(distance: Num, elevation_deg: Num, site_altitude: Num = 0.0) -> Column:
    return _c(distance) * F.tan(F.radians(_c(elevation_deg))) + _c(site_altitude)


def beam_height_diff(distance: Num, elevation_deg: Num, ke: float = KE) -> Column:
    return beam_height(distance, elevation_deg, ke=ke) - beam_height_flat(distance, elevation_deg)


def with_elevation_at_height(
    df: DataFrame, distance: Num, z_level: Num, output: str, site_altitude: Num = 0.0, ke: float = KE,
    curved: bool = True,
) -> DataFrame:
    """Add the angle (degrees) whose beam passes a level: flat start, five fixed-point steps.

    Each step is a projection of its own: one expression would repeat the angle of
    the step before several times and grow exponentially.
    """
    ground = F.greatest(_c(distance), F.lit(1.0))
    target, site = _c(z_level), _c(site_altitude)
    out = df.withColumn(output, F.atan((target - site) / ground))
    if curved:
        earth = ke * EARTH_RADIUS
        half_pi = math.pi / 2
        angle = F.col(output)
        for _ in range(5):
            slant = ground / F.greatest(F.cos(angle), F.lit(0.01))
            reached = F.sqrt(slant * slant + earth * earth + 2 * slant * earth * F.sin(angle)) - earth + site
            stepped = angle + (target - reached) / (slant + 1)
            out = out.withColumn(output, F.least(F.greatest(stepped, F.lit(-half_pi)), F.lit(half_pi)))
    return out.withColumn(output, F.degrees(output))


def beam_top_km(range_m: Num, elevation_deg: Num) -> Column:
    r = _c(range_m)
    return (r * F.sin(F.radians(_c(elevation_deg))) + r * r / (2 * BEAM_TOP_EARTH)) / 1000.0


def z_top_m(range_m: Num, elevation_deg: Num, round_to_km: float = 20.0, margin_km: float = 3.0) -> Column:
    """Top of the lattice rounded up (the rounded value, not the cap, is meant)."""
    top = (beam_top_km(range_m, elevation_deg) + margin_km) * 1000.0
    if round_to_km > 0:
        step = round_to_km * 1000.0
        top = F.ceil(top / step).cast("double") * step
    return top


def grid_resolution_xy(vol_nr: Column) -> Column:
    return F.when(vol_nr == "03", F.lit(300.0)).otherwise(F.lit(1000.0))


def points_up(span: Num, resolution: Num) -> Column:
    return F.ceil(_c(span) / _c(resolution)).cast("int") + 1


def points_down(span: Num, resolution: Num) -> Column:
    return F.floor(_c(span) / _c(resolution)).cast("int") + 1


def influence_radius_raw(x: Num, y: Num, z: Num, h_factor: Num, nb: Num, bsp: Num) -> Column:
    """Radius of influence before its lower bound."""
    widening = F.tan(_c(nb) * _c(bsp) * math.pi / 180.0)
    return _c(h_factor) * (_c(z) / 20.0) + F.sqrt(_c(x) * _c(x) + _c(y) * _c(y)) * widening


def influence_radius(x: Num, y: Num, z: Num, h_factor: Num, nb: Num, bsp: Num, min_radius: Num) -> Column:
    return F.greatest(influence_radius_raw(x, y, z, h_factor, nb, bsp), _c(min_radius))


def polar_to_xy(range_m: Column, azimuth_deg: Column) -> tuple[Column, Column]:
    """Slant-plane x and y, elevation ignored."""
    azimuth = F.radians(azimuth_deg)
    return range_m * F.sin(azimuth), range_m * F.cos(azimuth)


def gate_xyz(range_m: Column, azimuth_deg: Column, elevation_deg: Column) -> tuple[Column, Column, Column]:
    """Position of a gate about its radar, 4/3 earth."""
    earth = KE * EARTH_RADIUS
    elevation = F.radians(elevation_deg)
    azimuth = F.radians(azimuth_deg)
    z = F.sqrt(range_m * range_m + earth * earth + 2.0 * range_m * earth * F.sin(elevation)) - earth
    arc = earth * F.asin(range_m * F.cos(elevation) / (earth + z))
    return arc * F.sin(azimuth), arc * F.cos(azimuth), z


def haversine_km(lon1: Num, lat1: Num, lon2: Num, lat2: Num) -> Column:
    dlon = F.radians(_c(lon2)) - F.radians(_c(lon1))
    dlat = F.radians(_c(lat2)) - F.radians(_c(lat1))
    sin_lat = F.sin(dlat / 2)
    sin_lon = F.sin(dlon / 2)
    chord = sin_lat * sin_lat + F.cos(F.radians(_c(lat1))) * F.cos(F.radians(_c(lat2))) * sin_lon * sin_lon
    return GREAT_CIRCLE_KM * 2 * F.asin(F.sqrt(chord))


def bearing_range(lon_ref: Column, lat_ref: Column, lon: Column, lat: Column) -> tuple[Column, Column]:
    """Azimuth (degrees) and distance (m) of a point seen from a site.

    Law of cosines with a helper point 4.5 degrees north of the site; a point to
    the west is mirrored.  For a point on the site, which
    leaves no side to divide by, the cosine is clamped by its sign; without one it lies north.
    """
    north = lat_ref + 4.5
    a = haversine_km(lon, lat, lon_ref, north)
    b = haversine_km(lon_ref, lat_ref, lon_ref, north)
    c = haversine_km(lon_ref, lat_ref, lon, lat)
    over, under = c * c + b * b - a * a, 2 * b * c
    cosine = F.when(under != 0, over / under).otherwise(F.when(over < 0, -1.0).otherwise(1.0))
    angle = F.degrees(F.acos(F.least(F.greatest(cosine, F.lit(-1.0)), F.lit(1.0))))
    return F.when(lon_ref > lon, 360.0 - angle).otherwise(angle), c * 1000.0


def gate_dimensions(range_m: Column, gate_size: Num) -> tuple[Column, Column, Column]:
    """Beam width at the far and near edge of a gate, and its diagonal."""
    half_degree = math.pi / 360
    half = _c(gate_size) / 2
    far = (range_m + half) * math.tan(half_degree) * 2
    near = (range_m - half) * math.tan(half_degree) * 2
    return far, near, _c(gate_size) / math.cos(half_degree)


def xy_to_lonlat(x: Num, y: Num, site_lon: Num, site_lat: Num) -> tuple[Column, Column]:
    """Inverse azimuthal equidistant about the site, on a sphere.

    A sphere of 6 370 997 m stands in for the ellipsoid: at most about 0.3 % of
    the distance to the radar.
    """
    px, py = _c(x), _c(y)
    lon0, lat0 = _c(site_lon), F.radians(_c(site_lat))
    rho = F.sqrt(px * px + py * py)
    angle = rho / SPHERE_M
    safe = F.when(rho == 0, F.lit(1.0)).otherwise(rho)
    sine = F.cos(angle) * F.sin(lat0) + py * F.sin(angle) * F.cos(lat0) / safe
    lat = F.asin(F.least(F.greatest(sine, F.lit(-1.0)), F.lit(1.0)))
    east = px * F.sin(angle)
    ahead = safe * F.cos(lat0) * F.cos(angle) - py * F.sin(lat0) * F.sin(angle)
    lon = lon0 + F.degrees(F.atan2(east, ahead))
    return (
        F.when(rho == 0, lon0).otherwise(lon),
        F.when(rho == 0, _c(site_lat)).otherwise(F.degrees(lat)),
    )


def lonlat_to_mercator(lon: Num, lat: Num) -> tuple[Column, Column]:
    return (
        F.radians(_c(lon)) * MERCATOR_M,
        F.log(F.tan(F.lit(math.pi / 4) + F.radians(_c(lat)) / 2)) * MERCATOR_M,
    )


def nearest_ray(azimuth: Column, spacing: Num, nrays: Num) -> Column:
    """Index of the nearest ray, circular; the next one only if strictly nearer."""
    step = azimuth / _c(spacing)
    low = F.floor(step)
    return ((low + F.when(step - low > 0.5, 1).otherwise(0)) % _c(nrays)).cast("int")


def nearest_gate(distance: Column, first: Num, size: Num, ngates: Num) -> Column:
    """Index of the nearest gate; NULL before the first or past the last gate."""
    step = (distance - _c(first)) / _c(size)
    low = F.floor(step)
    index = low + F.when(step - low > 0.5, 1).otherwise(0)
    return F.when((step >= 0) & (step <= _c(ngates) - 1), index.cast("int"))

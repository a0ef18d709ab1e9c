"""Geometry function queries over observed gates, sites and stations."""

from __future__ import annotations

from pyspark.sql import functions as F

from echolattice.functions import geomath
from echolattice.operators import gridding, stations
from echolattice.session import spread
from workload import tables
from workload.registry import register
from workload.sqltables import KR, query

SLANT = "(range_m/greatest(cos(radians(elevation)), 0.01))"
CURVED = f"(sqrt({SLANT}*{SLANT} + {KR}*{KR} + 2*{SLANT}*{KR}*sin(radians(elevation))) - {KR})"


def r(value, digits=3):
    return F.round(value, digits)


def _per_gate(name: str, expression, sql: str) -> None:
    @register(name, query(("gates",), f"SELECT volume_id, gate_id, {sql} AS value FROM gates"))
    def run(spark, sf):
        return tables.gates(spark, sf).select("volume_id", "gate_id", expression().alias("value"))


_per_gate("beam_height", lambda: r(geomath.beam_height(F.col("range_m"), F.col("elevation"), 480.0)),
          f"round({CURVED} + 480, 3)")
_per_gate("beam_height_simple", lambda: r(geomath.beam_height_simple(F.col("range_m"), F.col("elevation"), 480.0)),
          f"round({SLANT}*sin(radians(elevation)) + {SLANT}*{SLANT}/(2*{KR}) + 480, 3)")
_per_gate("beam_height_flat", lambda: r(geomath.beam_height_flat(F.col("range_m"), F.col("elevation"), 480.0)),
          "round(range_m*tan(radians(elevation)) + 480, 3)")
_per_gate("beam_top_km", lambda: r(geomath.beam_top_km(F.col("range_m"), F.col("elevation")), 6),
          "round((range_m*sin(radians(elevation)) + range_m*range_m/(2*8.49e6::DOUBLE))/1000, 6)")


@register("beam_height_diff", query(("gates",), f"""SELECT volume_id, iy, ix,
    round((sqrt(s*s + {KR}*{KR} + 2*s*{KR}*sin(radians(e))) - {KR}) - d*tan(radians(e)), 3) AS value
    FROM (SELECT *, d/greatest(cos(radians(e)), 0.01) AS s FROM (
      SELECT volume_id, e, iy, ix, sqrt((-240000.0::DOUBLE + ix*12000.0::DOUBLE)*(-240000.0::DOUBLE + ix*12000.0::DOUBLE)
           + (-240000.0::DOUBLE + iy*12000.0::DOUBLE)*(-240000.0::DOUBLE + iy*12000.0::DOUBLE)) AS d
      FROM (SELECT volume_id, min(elevation) AS e FROM gates GROUP BY 1) v,
           (SELECT CAST(unnest(range(41)) AS INT) AS iy) a, (SELECT CAST(unnest(range(41)) AS INT) AS ix) b) q) z"""))
def beam_height_diff(spark, sf):
    lowest = tables.gates(spark, sf).groupBy("volume_id").agg(F.min("elevation").alias("elevation"))
    lat = tables.LATTICE
    lines = lowest.withColumn("iy", F.explode(F.sequence(F.lit(0), F.lit(lat.ny - 1))))
    frame = spread(lines, "volume_id", "iy").withColumn("ix", F.explode(F.sequence(F.lit(0), F.lit(lat.nx - 1))))
    gap = geomath.beam_height_diff(gridding.ground_distance(lat), F.col("elevation"))
    return frame.select("volume_id", "iy", "ix", r(gap).alias("value"))


def _step(angle: str) -> str:
    s = f"(g/greatest(cos({angle}), 0.01))"
    h = f"(sqrt({s}*{s} + {KR}*{KR} + 2*{s}*{KR}*sin({angle})) - {KR})"
    return f"least(greatest({angle} + (6000 - {h})/({s} + 1), -pi()/2), pi()/2)"


@register("elevation_at_z", query(("gates",), f"""SELECT volume_id, gate_id, round(degrees({_step('a4')}), 6) AS value
    FROM (SELECT *, {_step('a3')} AS a4 FROM (SELECT *, {_step('a2')} AS a3 FROM (SELECT *, {_step('a1')} AS a2
    FROM (SELECT *, {_step('a0')} AS a1 FROM (SELECT *, greatest(range_m, 1) AS g,
      atan(6000/greatest(range_m, 1)) AS a0 FROM gates) z0) z1) z2) z3) z4"""))  # fmt: skip
def elevation_at_z(spark, sf):
    out = geomath.with_elevation_at_height(tables.gates(spark, sf), F.col("range_m"), 6000.0, "value")
    return out.select("volume_id", "gate_id", r(F.col("value"), 6).alias("value"))


@register("z_limits", query(("gates",), """SELECT volume_id, 0.0::DOUBLE AS z_min, ceil(((reach*sin(radians(e)) +
    reach*reach/(2*8.49e6::DOUBLE))/1000 + 3)*1000/20000)*20000 AS z_top, e AS elevation
    FROM (SELECT volume_id, max(range_m) AS reach, max(elevation) AS e FROM gates GROUP BY 1) q"""))  # fmt: skip
def z_limits(spark, sf):
    seen = tables.gates(spark, sf).groupBy("volume_id").agg(
        F.max("range_m").alias("reach"), F.max("elevation").alias("elevation")
    )
    top = geomath.z_top_m(F.col("reach"), F.col("elevation"))
    return seen.select("volume_id", F.lit(0.0).alias("z_min"), top.alias("z_top"), "elevation")


@register("grid_spec", query(("gates",), """SELECT volume_id, CASE WHEN volume_id % 4 = 3 THEN 300.0::DOUBLE
    ELSE 1000.0::DOUBLE END AS resolution, CAST(ceil(15000.0::DOUBLE/600) + 1 AS INT) AS nz,
    CAST(floor(2*reach/resolution) + 1 AS INT) AS ny, CAST(floor(2*reach/resolution) + 1 AS INT) AS nx
    FROM (SELECT volume_id, max(range_m) AS reach FROM gates GROUP BY 1) q"""))  # fmt: skip
def grid_spec(spark, sf):
    seen = tables.gates(spark, sf).groupBy("volume_id").agg(F.max("range_m").alias("reach"))
    vol_nr = F.lpad((F.col("volume_id") % 4).cast("string"), 2, "0")
    sized = seen.withColumn("resolution", geomath.grid_resolution_xy(vol_nr))
    across = geomath.points_down(2 * F.col("reach"), F.col("resolution"))
    return sized.select(
        "volume_id", "resolution", geomath.points_up(15000.0, 600.0).alias("nz"), across.alias("ny"), across.alias("nx")
    )


@register("roi", query(("gxyz",), """SELECT volume_id, gate_id, round(greatest(1.02::DOUBLE*(z/20) +
    sqrt(x*x + y*y)*tan(1.45::DOUBLE*1.2::DOUBLE*pi()/180), 900), 3) AS value FROM gxyz"""))  # fmt: skip
def roi(spark, sf):
    placed = tables.with_xyz(tables.gates(spark, sf))
    radius = geomath.influence_radius(F.col("x"), F.col("y"), F.col("z"), 1.02, 1.45, 1.2, 900.0)
    return placed.select("volume_id", "gate_id", r(radius).alias("value"))


@register("polar_to_xy", query(("gates",), """SELECT volume_id, gate_id, round(range_m*sin(radians(azimuth)), 3) AS x,
    round(range_m*cos(radians(azimuth)), 3) AS y FROM gates"""))  # fmt: skip
def polar_to_xy(spark, sf):
    x, y = geomath.polar_to_xy(F.col("range_m"), F.col("azimuth"))
    return tables.gates(spark, sf).select("volume_id", "gate_id", r(x).alias("x"), r(y).alias("y"))


@register("gate_xyz", query(("gxyz",), """SELECT volume_id, gate_id, round(x, 3) AS x, round(y, 3) AS y,
    round(z, 3) AS z FROM gxyz"""))  # fmt: skip
def gate_xyz(spark, sf):
    placed = tables.with_xyz(tables.gates(spark, sf))
    return placed.select("volume_id", "gate_id", *[r(F.col(c)).alias(c) for c in ("x", "y", "z")])


_per_gate_dimensions = """SELECT volume_id, gate_id, round((range_m + 3000)*tan(pi()/360)*2, 6) AS far_m,
    round((range_m - 3000)*tan(pi()/360)*2, 6) AS near_m, round(6000/cos(pi()/360), 6) AS diagonal_m FROM gates"""


@register("gate_dimensions", query(("gates",), _per_gate_dimensions))
def gate_dimensions(spark, sf):
    far, near, diagonal = geomath.gate_dimensions(F.col("range_m"), float(tables.GATE_SIZE))
    return tables.gates(spark, sf).select(
        "volume_id", "gate_id", r(far, 6).alias("far_m"), r(near, 6).alias("near_m"), r(diagonal, 6).alias("diagonal_m")
    )


def _stations(spark, sf):
    """Stations on the map, placed by customer key."""
    key = F.col("c_custkey")
    return tables.read(spark, sf, "customer").select(
        key.alias("station_id"), (key % 997 * 0.008 - 68.0).alias("lon"), (key % 991 * 0.007 - 35.0).alias("lat")
    )


def _radars(spark, sf):
    scan = tables.sweeps(spark, sf).filter(F.col("sweep") == 0).drop("geometry_id")
    site = tables.sites(spark, sf).join(scan, "volume_id")
    radar = tables.radar_of(F.col("volume_id")).alias("radar")
    return site.select(radar, "site_lon", "site_lat", "nrays", "ngates", "gate_size", "gate_offset").distinct()


_STATIONS = """(SELECT c_custkey AS station_id, (c_custkey % 997)*0.008::DOUBLE - 68.0::DOUBLE AS lon,
    (c_custkey % 991)*0.007::DOUBLE - 35.0::DOUBLE AS lat FROM customer) st,
    (SELECT DISTINCT 'RAD' || CAST(volume_id % 4 + 1 AS VARCHAR) AS radar, site_lon, site_lat FROM sites) ra"""


def _hav(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    dx, dy = f"(radians({lon2}) - radians({lon1}))", f"(radians({lat2}) - radians({lat1}))"
    return (
        f"(6367.0::DOUBLE*2*asin(sqrt(sin({dy}/2)*sin({dy}/2) + "
        f"cos(radians({lat1}))*cos(radians({lat2}))*sin({dx}/2)*sin({dx}/2))))"
    )


_NEAR = f"""(SELECT *, CASE WHEN site_lon > lon THEN 360 - g ELSE g END AS bearing FROM (
    SELECT *, degrees(acos(least(greatest((c*c + b*b - a*a)/(2*b*c), -1), 1))) AS g FROM (
      SELECT station_id, lon, lat, radar, site_lon, site_lat,
        {_hav('lon', 'lat', 'site_lon', '(site_lat + 4.5::DOUBLE)')} AS a,
        {_hav('site_lon', 'site_lat', 'site_lon', '(site_lat + 4.5::DOUBLE)')} AS b,
        {_hav('site_lon', 'site_lat', 'lon', 'lat')} AS c
      FROM {_STATIONS}) h) k)"""


@register("haversine_km", query(("sites",), f"""SELECT station_id, radar, round(c, 6) AS km FROM {_NEAR} n
    WHERE c*1000 < 240000"""))  # fmt: skip
def haversine_km(spark, sf):
    near = stations.stations_in_reach(_stations(spark, sf), _radars(spark, sf))
    km = geomath.haversine_km(F.col("site_lon"), F.col("site_lat"), F.col("lon"), F.col("lat"))
    return near.select("station_id", "radar", r(km, 6).alias("km"))


@register("bearing_range", query(("sites",), f"""SELECT station_id, radar, round(bearing, 5) AS bearing,
    round(c*1000, 3) AS distance_m FROM {_NEAR} n WHERE c*1000 < 240000"""))  # fmt: skip
def bearing_range(spark, sf):
    near = stations.stations_in_reach(_stations(spark, sf), _radars(spark, sf))
    return near.select("station_id", "radar", r(F.col("bearing"), 5).alias("bearing"), r(F.col("distance_m")).alias("distance_m"))


@register("nearest_gate", query(("sites",), f"""SELECT station_id, radar,
    CAST((floor(bearing/10) + CASE WHEN bearing/10 - floor(bearing/10) > 0.5 THEN 1 ELSE 0 END) % 36 AS INT) AS ray,
    CASE WHEN s >= 0 AND s <= 39 THEN CAST(floor(s) + CASE WHEN s - floor(s) > 0.5 THEN 1 ELSE 0 END AS INT) END AS gate
    FROM (SELECT *, (c*1000 - 3000)/6000 AS s FROM {_NEAR} n WHERE c*1000 < 240000) q"""))  # fmt: skip
def nearest_gate(spark, sf):
    near = stations.stations_in_reach(_stations(spark, sf), _radars(spark, sf))
    return near.select("station_id", "radar", "ray", "gate")


def lonlat_sql(x: str, y: str) -> tuple[str, str]:
    rho = f"sqrt({x}*{x} + {y}*{y})"
    t = f"({rho}/6370997.0::DOUBLE)"
    la = "radians(site_lat)"
    lat = (
        f"CASE WHEN {rho} = 0 THEN site_lat ELSE degrees(asin(least(greatest(cos({t})*sin({la}) + "
        f"{y}*sin({t})*cos({la})/{rho}, -1), 1))) END"
    )
    lon = (
        f"CASE WHEN {rho} = 0 THEN site_lon ELSE site_lon + degrees(atan2({x}*sin({t}), "
        f"{rho}*cos({la})*cos({t}) - {y}*sin({la})*sin({t}))) END"
    )
    return lon, lat


_LON, _LAT = lonlat_sql("x", "y")


@register("gate_latlon", query(("gxyz", "sites"), f"""SELECT volume_id, gate_id, round({_LON}, 6) AS lon,
    round({_LAT}, 6) AS lat FROM gxyz JOIN sites USING (volume_id) WHERE DBZH > 45"""))  # fmt: skip
def gate_latlon(spark, sf):
    """Position on the map of listed (ray, gate) cells."""
    wanted = tables.with_xyz(tables.gates(spark, sf).filter(F.col("DBZH") > 45))
    placed = wanted.join(tables.sites(spark, sf), "volume_id")
    lon, lat = geomath.xy_to_lonlat(F.col("x"), F.col("y"), F.col("site_lon"), F.col("site_lat"))
    return placed.select("volume_id", "gate_id", r(lon, 6).alias("lon"), r(lat, 6).alias("lat"))


_CLON, _CLAT = lonlat_sql("x", "y")
BOUNDS = f"""(SELECT volume_id, min(lon) AS west, min(lat) AS south, max(lon) AS east, max(lat) AS north FROM (
    SELECT volume_id, {_CLON} AS lon, {_CLAT} AS lat FROM sites,
      (VALUES (-240000.0::DOUBLE, -240000.0::DOUBLE), (-240000.0::DOUBLE, 240000.0::DOUBLE),
              (240000.0::DOUBLE, -240000.0::DOUBLE), (240000.0::DOUBLE, 240000.0::DOUBLE)) k(x, y)) q GROUP BY 1)"""


def product_bounds_of(spark, sf):
    lat = tables.LATTICE
    corners = [
        geomath.xy_to_lonlat(x, y, F.col("site_lon"), F.col("site_lat")) for x in lat.x_limits for y in lat.y_limits
    ]
    lons, lats = [c[0] for c in corners], [c[1] for c in corners]
    return tables.sites(spark, sf).select(
        "volume_id", F.least(*lons).alias("west"), F.least(*lats).alias("south"),
        F.greatest(*lons).alias("east"), F.greatest(*lats).alias("north"),
    )


@register("product_bounds", query(("sites",), f"""SELECT volume_id, round(west, 6) AS west, round(south, 6) AS south,
    round(east, 6) AS east, round(north, 6) AS north, round(radians(west)*6378137, 2) AS west_m,
    round(ln(tan(pi()/4 + radians(south)/2))*6378137, 2) AS south_m, round(radians(east)*6378137, 2) AS east_m,
    round(ln(tan(pi()/4 + radians(north)/2))*6378137, 2) AS north_m FROM {BOUNDS} b"""))  # fmt: skip
def product_bounds(spark, sf):
    box = product_bounds_of(spark, sf)
    west, south = geomath.lonlat_to_mercator(F.col("west"), F.col("south"))
    east, north = geomath.lonlat_to_mercator(F.col("east"), F.col("north"))
    return box.select(
        "volume_id", *[r(F.col(c), 6).alias(c) for c in ("west", "south", "east", "north")],
        r(west, 2).alias("west_m"), r(south, 2).alias("south_m"), r(east, 2).alias("east_m"), r(north, 2).alias("north_m"),
    )

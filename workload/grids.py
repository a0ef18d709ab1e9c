"""Map, gridding and grid product queries."""

from __future__ import annotations

import uuid
from dataclasses import replace

import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from echolattice.operators import filters, gridding, neighbours, polar
from echolattice.plans import products
from echolattice.session import shared_folder, stored
from echolattice.sources import gate_store, geometry_store, map_cache
from workload import tables
from workload.registry import register
from workload.sqltables import KR, query, surface

LATTICE = tables.LATTICE


_STORED: dict[tuple, str] = {}


def build_geometry(spark, sf, lattice=LATTICE):
    """The map of every radar, shared by its volumes."""
    scans = tables.scans(spark, sf)
    return neighbours.geometry_pairs(tables.scan_gates(scans), scans.select("geometry_id").distinct(), lattice)


def _kept(spark, key: tuple, write):
    """A table written once per application, in the shared folder, and read by every product after that."""
    key = (spark.sparkContext.applicationId, *key)
    if key in _STORED:
        try:
            name, path = _STORED[key]
            spark.read.parquet(path)
            return spark.table(name)
        except AnalysisException:
            _STORED.pop(key)
    name = f"kept_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}"
    write(name, path)
    _STORED[key] = name, path
    return spark.table(name)


def buckets(spark, sf):
    """Buckets of gates and maps, by the number of measurements (which Parquet's footers tell)."""
    return gate_store.buckets_for(tables.read(spark, sf, "lineitem").count())


def geometry(spark, sf, lattice=LATTICE):
    """The same map from the store, in buckets."""
    return _kept(spark, ("map", sf, repr(lattice)), lambda name, path: geometry_store.save_bucketed(build_geometry(spark, sf, lattice), name, buckets(spark, sf), path))


def gates(spark, sf):
    """Gates as ingest leaves them: in the buckets of their map, with the lowest elevation of their volume."""
    return _kept(spark, ("gates", sf), lambda name, path: gate_store.save_gates(placed_gates(spark, sf), name, path, buckets(spark, sf), placed=True))


def placed_gates(spark, sf):
    """Gates in the store's buckets, exchanged once, as measurements: sweeps, stored, are known to be few, so their join moves no gate."""
    sweeps = stored(tables.sweeps(spark, sf), "sweeps")
    return gate_store.with_lowest(tables.gates(spark, sf, buckets(spark, sf)), sweeps)


def _per_volume(spark, sf, search):
    """A map for every volume, searched once for all volumes of equal scans."""
    scans = tables.volume_scans(spark, sf)
    shared = neighbours.shared_scans(scans)
    own = scans.join(shared.filter("geometry_id = shared_id").select("geometry_id"), "geometry_id", "left_semi")
    return neighbours.for_all(shared, search(tables.scan_gates(own), own.select("geometry_id").distinct()))


def _volume_pairs(spark, sf, reduce):
    """What ``reduce`` makes of the pairs of a scan, for every volume: the volumes share the work on their scan."""
    return _per_volume(spark, sf, lambda gates, ids: reduce(neighbours.neighbours(gates, ids, LATTICE)))


def _volume_map(spark, sf, lattice=LATTICE):
    return _per_volume(spark, sf, lambda gates, ids: neighbours.geometry_pairs(gates, ids, lattice))


@register("neighbours", query(("near", "vol"), """SELECT volume_id AS geometry_id, voxel_id, n, gate_sum FROM vol,
    (SELECT voxel_id, count(*) AS n, CAST(sum(gate_id) AS BIGINT) AS gate_sum FROM near GROUP BY 1) m"""))  # fmt: skip
def neighbours_(spark, sf):
    return _volume_pairs(spark, sf, lambda pairs: pairs.groupBy("geometry_id", "voxel_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("gate_id").alias("gate_sum")
    ))


@register("knn_gates", query(("near", "vol"), """SELECT volume_id AS geometry_id, voxel_id, gate_id, rank FROM vol,
    (SELECT voxel_id, gate_id, CAST(row_number() OVER (PARTITION BY voxel_id ORDER BY floor(sqrt(d2)*262144), gate_id) AS INT)
       AS rank FROM near QUALIFY rank <= 3) m"""))  # fmt: skip
def knn_gates(spark, sf):
    return _volume_pairs(spark, sf, lambda pairs: neighbours.knn_gates(pairs, 3).select("geometry_id", "voxel_id", "gate_id", "rank"))


_W = {
    "barnes": "exp(-d2/(2*(roi/2)*(roi/2)))",
    "barnes2": "exp(-4*d2/(roi*roi)) + 1e-5",
    "cressman": "least(greatest((roi*roi - d2)/(roi*roi + d2 + 1e-12), 0), 1)",
}


def _weights(kind: str) -> None:
    @register(f"neighbour_weights_{kind}", query(("near", "vol"), f"""SELECT volume_id AS geometry_id, voxel_id,
        round(total, 5) AS total, round(largest, 6) AS largest FROM vol, (SELECT voxel_id, sum(w) AS total,
        max(w) AS largest FROM (SELECT voxel_id, {_W[kind]} AS w FROM near) q GROUP BY 1) m"""))  # fmt: skip
    def run(spark, sf):
        return _volume_pairs(spark, sf, lambda pairs: neighbours.neighbour_weights(pairs, kind.upper()).groupBy("geometry_id", "voxel_id").agg(
            F.round(F.sum("weight"), 5).alias("total"), F.round(F.max("weight"), 6).alias("largest")
        ))


for _kind in _W:
    _weights(_kind)


@register("neighbour_weights_nearest", query(("near", "map1", "vol"), """SELECT volume_id AS geometry_id, voxel_id,
    gate_id, n FROM vol, (SELECT voxel_id, gate_id, n FROM map1 JOIN (SELECT voxel_id, count(*) AS n FROM near
    GROUP BY 1) c USING (voxel_id)) m"""))  # fmt: skip
def neighbour_weights_nearest(spark, sf):
    return _volume_pairs(spark, sf, lambda pairs: neighbours.neighbour_weights(pairs, "nearest").groupBy("geometry_id", "voxel_id").agg(
        F.max(F.when(F.col("weight") == 1, F.col("gate_id"))).alias("gate_id"), F.count(F.lit(1)).alias("n")
    ))


@register("geometry_build", query(("map1", "vol"), """SELECT volume_id AS geometry_id, voxel_id, gate_id,
    1.0::DOUBLE AS weight FROM vol, map1"""))  # fmt: skip
def geometry_build(spark, sf):
    return _volume_map(spark, sf)


@register("geometry_overrides", query(("scan_xyz", "vol"), f"""SELECT * FROM (
    WITH spec AS (SELECT volume_id AS geometry_id, CASE WHEN volume_id % 2 = 1 THEN 9000.0::DOUBLE ELSE 6000.0::DOUBLE END AS mr,
                         CASE WHEN volume_id % 2 = 1 THEN 4.0::DOUBLE ELSE 8.0::DOUBLE END AS nb FROM vol),
    v AS (SELECT * FROM (SELECT s.geometry_id, CAST((iz*41 + iy)*41 + ix AS BIGINT) AS voxel_id, x, y, z,
            greatest(1.02::DOUBLE*(z/20.0::DOUBLE) + sqrt(x*x + y*y)*tan(nb*1.2::DOUBLE*pi()/180.0::DOUBLE), mr) AS roi,
            sqrt(x*x + y*y)/greatest(cos(radians(0.5::DOUBLE)), 0.01) AS s
          FROM spec s, (SELECT iz, iy, ix, iz*3000.0::DOUBLE AS z, -240000.0::DOUBLE + iy*12000.0::DOUBLE AS y,
            -240000.0::DOUBLE + ix*12000.0::DOUBLE AS x FROM (SELECT unnest(range(6)) AS iz) a,
            (SELECT unnest(range(41)) AS iy) b, (SELECT unnest(range(41)) AS ix) c) l) q
          WHERE NOT (sqrt(x*x + y*y + z*z) <= 3000)
            AND NOT (z < sqrt(s*s + {KR}*{KR} + 2*s*{KR}*sin(radians(0.5::DOUBLE))) - {KR} - 2400)),
    p AS (SELECT v.geometry_id, v.voxel_id, g.gate_id, (g.x - v.x)*(g.x - v.x) + (g.y - v.y)*(g.y - v.y)
            + (g.z - v.z)*(g.z - v.z) AS d2, v.roi FROM v JOIN scan_xyz g
          ON (g.x - v.x)*(g.x - v.x) + (g.y - v.y)*(g.y - v.y) + (g.z - v.z)*(g.z - v.z) < v.roi*v.roi
          WHERE g.z <= 15000)
    SELECT geometry_id, voxel_id, arg_min(gate_id, (floor(sqrt(d2)*262144), gate_id)) AS gate_id FROM p GROUP BY 1, 2) z"""))
def geometry_overrides(spark, sf):
    """Each geometry with its own radius and beam parameters over the defaults."""
    odd = F.col("geometry_id") % 2 == 1
    scans = tables.volume_scans(spark, sf).withColumns({
        "min_radius": F.when(odd, 9000.0).otherwise(6000.0), "nb": F.when(odd, 4.0).otherwise(8.0)
    })
    specs = scans.select("geometry_id", "min_radius", "nb").distinct()
    return neighbours.geometry_pairs(tables.scan_gates(scans), specs, LATTICE).drop("weight")


_ODD_SPEC = """v AS (SELECT CAST((iz*41 + iy)*41 + ix AS BIGINT) AS voxel_id, x, y, z,
            greatest(1.02::DOUBLE*(z/20.0::DOUBLE) + sqrt(x*x + y*y)*tan(4.0::DOUBLE*1.2::DOUBLE*pi()/180.0::DOUBLE), 9000.0::DOUBLE) AS roi,
            sqrt(x*x + y*y)/greatest(cos(radians(0.5::DOUBLE)), 0.01) AS s
          FROM (SELECT iz, iy, ix, iz*3000.0::DOUBLE AS z, -240000.0::DOUBLE + iy*12000.0::DOUBLE AS y,
            -240000.0::DOUBLE + ix*12000.0::DOUBLE AS x FROM (SELECT unnest(range(6)) AS iz) a,
            (SELECT unnest(range(41)) AS iy) b, (SELECT unnest(range(41)) AS ix) c) l)"""


@register("geometry_cache", query(("scan_xyz", "map1", "vol"), f"""SELECT * FROM (WITH {_ODD_SPEC},
    odd AS (SELECT v.voxel_id, arg_min(g.gate_id, (floor(sqrt((g.x - v.x)*(g.x - v.x) + (g.y - v.y)*(g.y - v.y) + (g.z - v.z)*(g.z - v.z))*262144), g.gate_id)) AS gate_id
      FROM v JOIN scan_xyz g ON (g.x - v.x)*(g.x - v.x) + (g.y - v.y)*(g.y - v.y) + (g.z - v.z)*(g.z - v.z) < v.roi*v.roi
      WHERE g.z <= 15000 AND NOT (sqrt(v.x*v.x + v.y*v.y + v.z*v.z) <= 3000)
        AND NOT (v.z < sqrt(s*s + {KR}*{KR} + 2*s*{KR}*sin(radians(0.5::DOUBLE))) - {KR} - 2400) GROUP BY 1)
    SELECT volume_id AS geometry_id, 'RAD' || CAST(volume_id % 4 + 1 AS VARCHAR) || '_0315_01' AS named, CAST(volume_id % 2 AS INT) AS batch,
      CASE WHEN volume_id % 2 = 1 THEN o.n ELSE m.n END AS pairs, CASE WHEN volume_id % 2 = 1 THEN o.g ELSE m.g END AS gate_sum
    FROM vol, (SELECT count(*) AS n, CAST(sum(gate_id) AS BIGINT) AS g FROM map1) m, (SELECT count(*) AS n, CAST(sum(gate_id) AS BIGINT) AS g FROM odd) o) z"""))
def geometry_cache(spark, sf):
    """Asked for the maps of some volumes, then of all: the second call searches one map, that of volumes with other parameters."""
    path = f"{shared_folder(spark)}/cache-{uuid.uuid4().hex}"
    odd = F.col("geometry_id") % 2 == 1
    scans = tables.volume_scans(spark, sf).withColumns({
        "radar": tables.radar_of(F.col("geometry_id")), "strategy": F.lit("0315"), "vol_nr": F.lit("01"),
        "min_radius": F.when(odd, 9000.0).otherwise(6000.0), "nb": F.when(odd, 4.0).otherwise(8.0),
    })

    def search(own):
        specs = own.select("geometry_id", "min_radius", "nb").distinct()
        return neighbours.geometry_pairs(tables.scan_gates(own.drop("radar", "strategy", "vol_nr")), specs, LATTICE)

    map_cache.ensure(scans.filter(~odd), LATTICE, path, search)
    wanted = map_cache.ensure(scans, LATTICE, path, search)
    held = map_cache.load(spark, path, wanted).groupBy("geometry_id", "batch").agg(F.count(F.lit(1)).alias("pairs"), F.sum("gate_id").alias("gate_sum"))
    named = wanted.select("geometry_id", F.regexp_extract("map_key", "^(.*)_RES", 1).alias("named"))
    return held.join(named, "geometry_id")


@register("geometry_stats", query(("map1", "vol"), """SELECT volume_id AS geometry_id, CAST(10086 AS BIGINT) AS points,
    n AS pairs, n/10086.0::DOUBLE AS mean_neighbours, CAST(n*8 + 10087*4 AS BIGINT) AS bytes, 3000.0::DOUBLE AS z_step
    FROM vol, (SELECT count(*) AS n FROM map1) m"""))  # fmt: skip
def geometry_stats(spark, sf):
    return gridding.geometry_stats(_volume_map(spark, sf), LATTICE)


_FIT = """SELECT s.volume_id, s.geometry_id, held, needed, needed <= held AS fits,
    CASE WHEN needed > held THEN 'map is for larger radar dimensions' END AS reason
    FROM (SELECT volume_id, geometry_id, CAST(sum(nrays)*max(ngates) AS BIGINT) AS held FROM sweeps
          WHERE NOT (volume_id % 4 = 3 AND sweep >= 5) GROUP BY 1, 2) s,
         (SELECT max(gate_id) + 1 AS needed FROM map1) m"""


def _short_sweeps(spark, sf):
    """Sweep tables with some volumes lacking the upper sweeps."""
    return tables.sweeps(spark, sf).filter(~((F.col("volume_id") % 4 == 3) & (F.col("sweep") >= 5)))


@register("map_fit", query(("sweeps", "map1"), _FIT))
def map_fit(spark, sf):
    return gridding.map_fit(geometry(spark, sf), _short_sweeps(spark, sf))


@register("apply_map_join", query(("sweeps", "map1", "gates"), f"""SELECT g.volume_id, m.voxel_id, g.gate_id, g.DBZH
    FROM gates g JOIN map1 m USING (gate_id) SEMI JOIN (SELECT * FROM ({_FIT}) f WHERE fits) f
    ON f.volume_id = g.volume_id"""))  # fmt: skip
def apply_map_join(spark, sf):
    joined = gridding.apply_map(gates(spark, sf), geometry(spark, sf), _short_sweeps(spark, sf))
    return joined.select("volume_id", "voxel_id", "gate_id", "DBZH")


WIDE = replace(LATTICE, max_neighbors=None, weighting="barnes2")
FOUR = replace(LATTICE, max_neighbors=4, weighting="cressman")


@register("grid_field", query(("grid",), """SELECT volume_id, voxel_id, iz, iy, ix, DBZH AS value FROM grid
    WHERE NOT RHOHV < 0.8"""))  # fmt: skip
def grid_field(spark, sf):
    own = gates(spark, sf)
    bad = filters.GateFilter.on(own).below("RHOHV", 0.8).excluded
    return gridding.grid_field(own, geometry(spark, sf), LATTICE, "DBZH", bad)


@register("grid_field_barnes2", query(("near", "gates"), """SELECT volume_id, voxel_id,
    round(sum(w*DBZH)/sum(w), 4) AS value FROM gates JOIN (SELECT voxel_id, gate_id,
    exp(-4*d2/(roi*roi)) + 1e-5 AS w FROM near) m USING (gate_id) GROUP BY 1, 2"""))  # fmt: skip
def grid_field_barnes2(spark, sf):
    voxels = gridding.grid_field(gates(spark, sf), geometry(spark, sf, WIDE), WIDE, "DBZH")
    return voxels.select("volume_id", "voxel_id", F.round("value", 4).alias("value"))


@register("grid_fields", query(("near", "gates"), """SELECT volume_id, voxel_id,
    round(sum(w*DBZH) FILTER (NOT RHOHV < 0.8)/sum(w) FILTER (NOT RHOHV < 0.8) + 1e-8, 4) AS DBZH,
    round(sum(w*ZDR)/sum(w) + 1e-8, 4) AS ZDR,
    round(sum(w*WRAD) FILTER (NOT WRAD > 4)/sum(w) FILTER (NOT WRAD > 4) + 1e-8, 4) AS WRAD
    FROM gates JOIN (SELECT voxel_id, gate_id, least(greatest((roi*roi - d2)/(roi*roi + d2 + 1e-12), 0), 1) AS w
      FROM near QUALIFY row_number() OVER (PARTITION BY voxel_id ORDER BY floor(sqrt(d2)*262144), gate_id) <= 4) m USING (gate_id)
    GROUP BY 1, 2 HAVING sum(w) > 0"""))  # fmt: skip
def grid_fields(spark, sf):
    own = gates(spark, sf)
    wanted = {
        "DBZH": ("DBZH", F.col("RHOHV") < 0.8), "ZDR": ("ZDR", None), "WRAD": ("WRAD", F.col("WRAD") > 4),
    }
    voxels = gridding.grid_fields(own, geometry(spark, sf, FOUR), FOUR, wanted)
    return voxels.select("volume_id", "voxel_id", *[F.round(F.col(c) + 1e-8, 4).alias(c) for c in wanted])


def filtered_voxels(spark, sf):
    return products.filtered_voxels(gates(spark, sf), geometry(spark, sf), LATTICE)


def _column(name: str, how: str, sql: str, where: str = "true", **bounds) -> None:
    @register(name, query(("vox",), f"SELECT volume_id, iy, ix, {sql} AS value FROM vox WHERE {where} GROUP BY 1, 2, 3"))
    def run(spark, sf):
        out = gridding.column_aggregate(filtered_voxels(spark, sf), LATTICE, how, **bounds)
        return out.withColumn("value", F.round("value", 6)) if how == "mean" else out


_column("column_max", "max", "max(value)")
_column("column_min", "min", "min(value)", "iz BETWEEN 1 AND 3", z_min_idx=1, z_max_idx=3)
_column("column_mean", "mean", "round(avg(value), 6)", "iz BETWEEN 1 AND 4", z_min_alt=2000.0, z_max_alt=12000.0)


@register("ppi", query(("vox",), "SELECT volume_id, iy, ix, round(value, 6) AS value FROM (" + surface("vox", "3.5::DOUBLE") + ") s"))
def ppi(spark, sf):
    out = gridding.ppi(filtered_voxels(spark, sf), LATTICE, 3.5)
    return out.withColumn("value", F.round("value", 6))


@register("ppi_flat", query(("vox",), "SELECT volume_id, iy, ix, round(value, 6) AS value FROM (" + surface("vox", "2.0::DOUBLE", curved=False) + ") s"))
def ppi_flat(spark, sf):
    out = gridding.ppi(filtered_voxels(spark, sf), LATTICE, 2.0, curved=False)
    return out.withColumn("value", F.round("value", 6))


@register("ppi_nearest", query(("vox",), f"""SELECT volume_id, iy, ix, value FROM (SELECT *,
    d/greatest(cos(radians(3.5::DOUBLE)), 0.01) AS s FROM (SELECT *,
    sqrt((-240000.0::DOUBLE + ix*12000.0::DOUBLE)*(-240000.0::DOUBLE + ix*12000.0::DOUBLE)
       + (-240000.0::DOUBLE + iy*12000.0::DOUBLE)*(-240000.0::DOUBLE + iy*12000.0::DOUBLE)) AS d FROM vox) q) z
    WHERE iz = round_even((sqrt(s*s + {KR}*{KR} + 2*s*{KR}*sin(radians(3.5::DOUBLE))) - {KR})/3000, 0)"""))
def ppi_nearest(spark, sf):
    return gridding.ppi(filtered_voxels(spark, sf), LATTICE, 3.5, "nearest")


@register("cappi", query(("vox",), """SELECT volume_id, iy, ix, round(0.5::DOUBLE*a + 0.5::DOUBLE*b, 6) AS value FROM (
    SELECT volume_id, iy, ix, max(value) FILTER (iz = 1) AS a, max(value) FILTER (iz = 2) AS b FROM vox
    GROUP BY 1, 2, 3) q WHERE a IS NOT NULL AND b IS NOT NULL"""))  # fmt: skip
def cappi(spark, sf):
    return gridding.cappi(filtered_voxels(spark, sf), LATTICE, 4500.0).withColumn("value", F.round("value", 6))


@register("cappi_exact", query(("vox",), "SELECT volume_id, iy, ix, value FROM vox WHERE iz = 2"))
def cappi_exact(spark, sf):
    return gridding.cappi(filtered_voxels(spark, sf), LATTICE, 6000.0)


@register("cappi_nearest", query(("vox",), "SELECT volume_id, iy, ix, value FROM vox WHERE iz = 1"))
def cappi_nearest(spark, sf):
    return gridding.cappi(filtered_voxels(spark, sf), LATTICE, 4500.0, "nearest")


@register("cross_section", query(("vox",), "SELECT volume_id, iz, ix, value FROM vox WHERE iy = 20"))
def cross_section(spark, sf):
    return gridding.cross_section(filtered_voxels(spark, sf), LATTICE)


@register("cross_section_y", query(("vox",), "SELECT volume_id, iz, iy, value FROM vox WHERE ix = 11"))
def cross_section_y(spark, sf):
    return gridding.cross_section(filtered_voxels(spark, sf), LATTICE, ix=11)


@register("level_slice", query(("vox",), "SELECT volume_id, iz, iy, ix, value FROM vox WHERE iz IN (1, 3)"))
def level_slice(spark, sf):
    return gridding.level_slice(filtered_voxels(spark, sf), [1, 3]).select("volume_id", "iz", "iy", "ix", "value")


def colmax(spark, sf):
    return products.colmax_product(gates(spark, sf), geometry(spark, sf), LATTICE)


@register("colmax_product", query(("colmax",), "SELECT volume_id, iy, ix, value FROM colmax"))
def colmax_product(spark, sf):
    return colmax(spark, sf)


@register("colmax_unfloored", query(("vox",), "SELECT volume_id, iy, ix, max(value) AS value FROM vox GROUP BY 1, 2, 3"))
def colmax_unfloored(spark, sf):
    return products.colmax_product(gates(spark, sf), geometry(spark, sf), LATTICE, floor_dbz=None)


def _variant(field: str, filtered: bool) -> str:
    rule = "NOT (RHOHV < 0.55 OR WRAD > 4.6 OR DBZH < -3 OR ZDR > 8.5)" if filtered else "true"
    source = f"(SELECT volume_id, iz, iy, ix, {field} AS value FROM grid WHERE {rule})"
    inner = surface(source, "0.5::DOUBLE")
    return f"SELECT volume_id, '{field}' AS field, {str(filtered).lower()} AS filtered, iy, ix, round(value, 6) AS value FROM ({inner}) s"


@register("field_products", query(("grid",), " UNION ALL ".join(
    [_variant(f, False) for f in ("DBZH", "ZDR", "RHOHV", "VRAD", "WRAD", "KDP")]
    + [_variant(f, True) for f in ("DBZH", "ZDR", "KDP")])))
def field_products(spark, sf):
    return field_products_of(spark, sf, gates(spark, sf))


#: Fields shown raw, those shown filtered, and the raw reflectivity that stands in where a table has it.
SHOWN = ["DBZH", "ZDR", "RHOHV", "VRAD", "WRAD", "KDP"], ["DBZH", "ZDR", "KDP"], {"DBZH": "TH"}


def field_products_of(spark, sf, own):
    out = products.field_products(
        own, geometry(spark, sf), LATTICE, tables.sweeps(spark, sf),
        *SHOWN,
    )
    return out.withColumn("value", F.round("value", 6))


# --- pixel filters ----------------------------------------------------------


def _pixels(name: str, change, sql: str) -> None:
    @register(name, query(("colmax",), f"SELECT volume_id, iy, ix, {sql} AS value FROM colmax"))
    def run(spark, sf):
        return change(colmax(spark, sf))


_pixels("grid_below", lambda p: gridding.mask_below(p, 20.0), "CASE WHEN NOT value < 20 THEN value END")
_pixels("grid_above", lambda p: gridding.mask_above(p, 50.0, -99.0), "CASE WHEN value > 50 THEN -99.0::DOUBLE ELSE value END")
_pixels("grid_outside", lambda p: gridding.mask_outside(p, 10.0, 55.0), "CASE WHEN NOT (value < 10 OR value > 55) THEN value END")
_pixels("grid_custom", lambda p: gridding.mask_pixels(p, (F.col("ix") + F.col("iy")) % 2 == 0, 0.0),
        "CASE WHEN (ix + iy) % 2 = 0 THEN 0.0::DOUBLE ELSE value END")


@register("grid_vectorised", query(("colmax",), """SELECT volume_id, iy, ix, CASE WHEN abs(value - 30) > 15 THEN -1.0::DOUBLE ELSE value END AS value
    FROM colmax"""))  # fmt: skip
def grid_vectorised(spark, sf):
    """A predicate over Arrow arrays of pixels."""
    far = filters.vectorised(lambda v: pc.greater(pc.abs(pc.subtract(v, 30.0)), 15.0))
    return gridding.mask_pixels(colmax(spark, sf), far(F.col("value")), -1.0)


@register("grid_invalid", query(("colmax", "vol"), """SELECT v.volume_id, y.iy, x.ix, coalesce(value, -99.0::DOUBLE) AS value
    FROM vol v, (SELECT CAST(unnest(range(41)) AS INT) AS iy) y, (SELECT CAST(unnest(range(41)) AS INT) AS ix) x
    LEFT JOIN colmax c ON c.volume_id = v.volume_id AND c.iy = y.iy AND c.ix = x.ix"""))  # fmt: skip
def grid_invalid(spark, sf):
    volumes = tables.sweeps(spark, sf).select("volume_id").distinct()
    return gridding.fill_missing(colmax(spark, sf), volumes, LATTICE, -99.0)


# --- polar products ---------------------------------------------------------

_LINKS = f"""SELECT geometry_id, sweep, min(gate) AS gate, ref_gate FROM (
    SELECT a.geometry_id, r.gate AS ref_gate, a.sweep, a.gate, a.z FROM S a
    JOIN S r ON r.geometry_id = a.geometry_id AND r.sweep = 1 AND a.gate >= r.gate
      AND a.s > r.s - (SELECT (max(s) - min(s))/2 FROM S h WHERE h.geometry_id = r.geometry_id AND h.sweep = 1
                       AND h.gate <= 1)) q
    GROUP BY geometry_id, sweep, ref_gate HAVING arg_min(z, gate) + 480 <= 20000"""
_SCAN = f"""(SELECT *, {KR}*asin(r*cos(radians(elevation))/({KR} + z)) AS s FROM (SELECT geometry_id, sweep, elevation,
    CAST(gate AS INT) AS gate, r, sqrt(r*r + {KR}*{KR} + 2.0::DOUBLE*r*{KR}*sin(radians(elevation))) - {KR} AS z
    FROM (SELECT DISTINCT KEY AS geometry_id, sweep, elevation, gate, 3000 + gate*6000.0::DOUBLE AS r
          FROM sweeps, (SELECT unnest(range(40)) AS gate) g WHERE elevation >= 0.65) a) b)"""


def _links_sql(key: str) -> str:
    return f"SELECT * FROM (WITH S AS {_SCAN.replace('KEY', key)} {_LINKS}) z"


@register("vertical_link", query(("sweeps",), _links_sql("volume_id")))
def vertical_link(spark, sf):
    scans = tables.volume_scans(spark, sf)
    links = polar.vertical_link(scans, above=0.65, site_altitude=tables.SITE_ALTITUDE)
    return links.select("geometry_id", "sweep", "gate", "ref_gate")


def _polar(spark, sf, gates):
    links = polar.vertical_link(tables.scans(spark, sf), above=0.65, site_altitude=tables.SITE_ALTITUDE)
    return polar.polar_colmax(gates, links)


_POLAR = """SELECT g.volume_id, g.ray, l.ref_gate AS gate, max(DBZH) AS value FROM gates g
    JOIN ({links}) l ON l.geometry_id = g.geometry_id AND l.sweep = g.sweep AND l.gate = g.gate {where}
    GROUP BY 1, 2, 3"""


@register("polar_colmax", query(("sweeps", "gates"), _POLAR.format(links=_links_sql("geometry_id"), where="")))
def polar_colmax(spark, sf):
    return _polar(spark, sf, tables.gates(spark, sf))


@register("filtered_polar_colmax", query(("sweeps", "gates"), _POLAR.format(links=_links_sql("geometry_id"),
    where="WHERE NOT (DBZH < 5 OR RHOHV < 0.8 OR ZDR > 8.5 OR WRAD > 4.6)")))
def filtered_polar_colmax(spark, sf):
    gates = tables.gates(spark, sf)
    for source, low, high in (("DBZH", 5.0, None), ("RHOHV", 0.8, None), ("ZDR", None, 8.5), ("WRAD", None, 4.6)):
        gates = filters.mask_by_source(gates, source, ["DBZH"], below=low, above=high)
    return _polar(spark, sf, gates)

"""Labelling and detection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from echolattice.operators import components as labels
from echolattice.operators import detect, gridding, volumes
from echolattice.plans import products
from echolattice.sources import gate_store
from workload import grids, tables
from workload.registry import register
from workload.scalars import lonlat_sql
from workload.sqltables import components, query, surface, table

LATTICE = tables.LATTICE
XY = "avg(-240000.0::DOUBLE + (s.p % 41)*12000.0::DOUBLE) AS x_m, avg(-240000.0::DOUBLE + (s.p // 41)*12000.0::DOUBLE) AS y_m"

table("strong", ("colmax",), "SELECT volume_id AS img, iy AS r, ix AS c, value FROM colmax WHERE value >= 52")
components("strong_lab", "strong", 41)

table("dvox", ("map1", "gates"), """
  SELECT g.volume_id, m.voxel_id, CAST(m.voxel_id // 1681 AS INT) AS iz, CAST((m.voxel_id % 1681) // 41 AS INT) AS iy,
         CAST(m.voxel_id % 41 AS INT) AS ix,
         DBZH AS value,
         CASE WHEN NOT gate % 9 = 0 THEN RHOHV END AS rhohv
  FROM gates g JOIN map1 m USING (gate_id)""")
table("strong_raw", ("dvox",), """SELECT volume_id AS img, iy AS r, ix AS c, max(value) AS value FROM dvox
  WHERE value IS NOT NULL GROUP BY 1, 2, 3 HAVING max(value) >= 52""")
components("strong_raw_lab", "strong_raw", 41)
table("rho_ppi", ("dvox",), surface("(SELECT * FROM dvox WHERE rhohv IS NOT NULL) g", "0.5::DOUBLE", "rhohv"))

BLOBS = """
  SELECT s.img AS volume_id, CAST(label AS BIGINT) AS label, count(*) AS pixel_count, """ + XY + """, avg(m.value) AS mean_dbz,
         max(m.value) AS max_dbz, CASE WHEN count(q.value) = count(*) THEN round(avg(q.value), 6) END AS mean_rhohv
  FROM {0}_lab s JOIN {0} m ON m.img = s.img AND m.r*41 + m.c = s.p
  LEFT JOIN rho_ppi q ON q.volume_id = s.img AND q.iy*41 + q.ix = s.p GROUP BY 1, 2"""
table("blobs", ("strong", "strong_lab", "rho_ppi"), BLOBS.format("strong"))
table("raw_blobs", ("strong_raw", "strong_raw_lab", "rho_ppi"), BLOBS.format("strong_raw"))

CORE_CAND = """
  SELECT *, sqrt(x_m*x_m + y_m*y_m) AS range_m,
         row_number() OVER (PARTITION BY volume_id ORDER BY round(mean_dbz, 5) DESC, label) AS rk
  FROM raw_blobs WHERE pixel_count > 1 AND sqrt(x_m*x_m + y_m*y_m) >= 12000
    AND ({0} OR (max_dbz > 56 AND pixel_count > 5))"""
table("core_cand", ("raw_blobs",), CORE_CAND.format("(pixel_count > 2 AND coalesce(mean_rhohv > 0.85, false))"))
table("core_cand_bare", ("raw_blobs",), CORE_CAND.format("false"))


def dedup(name: str, candidates: str, radius: float) -> None:
    """Register ``name`` (volume_id, rk): sequential greedy choice over ranked candidates."""
    table(f"{name}_fold", (candidates,), f"""
      SELECT DISTINCT volume_id, 0::BIGINT, CAST([] AS STRUCT(x DOUBLE, y DOUBLE, rk BIGINT)[]) FROM {candidates}
      UNION ALL
      SELECT f.volume_id, f.rk + 1, CASE WHEN len(list_filter(f.kept, lambda k: sqrt((k.x - c.x_m)*(k.x - c.x_m)
               + (k.y - c.y_m)*(k.y - c.y_m)) < {radius})) > 0 THEN f.kept
             ELSE list_append(f.kept, {{'x': c.x_m, 'y': c.y_m, 'rk': c.rk}}) END
      FROM {name}_fold f JOIN {candidates} c ON c.volume_id = f.volume_id AND c.rk = f.rk + 1""",
          head=f"{name}_fold(volume_id, rk, kept) AS")
    table(name, (f"{name}_fold",), f"""
      SELECT volume_id, unnest(kept).rk AS rk FROM (SELECT volume_id, arg_max(kept, rk) AS kept FROM {name}_fold
      GROUP BY 1) f""")  # fmt: skip


dedup("core_keep", "core_cand", 8000.0)
dedup("core_keep_bare", "core_cand_bare", 8000.0)
dedup("core_keep_wide", "core_cand", 60000.0)

table("high", ("dvox",), """
  SELECT volume_id*10 + iz AS img, iy AS r, ix AS c, value, rhohv FROM dvox WHERE value >= 20
    AND sqrt((-240000.0::DOUBLE + ix*12000.0::DOUBLE)*(-240000.0::DOUBLE + ix*12000.0::DOUBLE)
           + (-240000.0::DOUBLE + iy*12000.0::DOUBLE)*(-240000.0::DOUBLE + iy*12000.0::DOUBLE)) >= 25000""")
components("high_lab", "high", 41)
TOP_CAND = f"""
  SELECT *, row_number() OVER (PARTITION BY volume_id ORDER BY altitude_m DESC, level_index, label) AS rk,
         round_even(altitude_m/1000, 1) AS altitude_km
  FROM (SELECT *, sqrt(x_m*x_m + y_m*y_m) AS range_m, level_index*3000.0::DOUBLE AS altitude_m FROM (
    SELECT s.img // 10 AS volume_id, CAST(s.img % 10 AS INT) AS level_index, CAST(label AS BIGINT) AS label,
           count(*) AS pixel_count, {XY},
           CASE WHEN count(m.rhohv) = count(*) THEN round(avg(m.rhohv), 6) END AS mean_rhohv
    FROM high_lab s JOIN high m ON m.img = s.img AND m.r*41 + m.c = s.p GROUP BY 1, 2, 3) b) z
  WHERE pixel_count > 2 AND altitude_m > 9000 AND range_m >= 25000"""
table("top_cand", ("high", "high_lab"), TOP_CAND + " AND coalesce(mean_rhohv > 0.94, true)")
table("top_cand_bare", ("high", "high_lab"), TOP_CAND)
dedup("top_keep_bare", "top_cand_bare", 17000.0)
dedup("top_keep", "top_cand", 17000.0)


def detection_voxels(spark, sf, gates=None):
    gates = grids.gates(spark, sf) if gates is None else gates
    return products.detection_voxels(gates, grids.geometry(spark, sf), LATTICE, rhohv_hole=F.col("gate") % 9 == 0)


def _lowest(spark, sf):
    return volumes.lowest_sweep(tables.sweeps(spark, sf)).select("volume_id", "elevation")


def _colmax_and_rhohv(spark, sf):
    """Both in one table, from one pass over the voxels; stored gates carry the lowest elevation of their volume."""
    return gridding.column_and_surface(detection_voxels(spark, sf), LATTICE, gate_store.LOWEST, "rhohv"), "rhohv"


@register("label_components", query(("strong_lab",), """SELECT img AS volume_id, CAST(p // 41 AS INT) AS iy,
    CAST(p % 41 AS INT) AS ix, CAST(label AS BIGINT) AS label FROM strong_lab"""))  # fmt: skip
def label_components(spark, sf):
    mask = grids.colmax(spark, sf).filter(F.col("value") >= 52)
    return labels.label_components(mask, ["volume_id"], LATTICE.ny, LATTICE.nx)


@register("label_components_rounds", query(("strong_lab",), """SELECT img AS volume_id, CAST(p // 41 AS INT) AS iy,
    CAST(p % 41 AS INT) AS ix, CAST(label AS BIGINT) AS label FROM strong_lab"""))  # fmt: skip
def label_components_rounds(spark, sf):
    """The form for images too large for one task."""
    mask = grids.colmax(spark, sf).filter(F.col("value") >= 52)
    return labels.label_components(mask, ["volume_id"], LATTICE.ny, LATTICE.nx, rounds=True, tile=7)


_BLOB = "volume_id, label, pixel_count, round(x_m, 4) AS x_m, round(y_m, 4) AS y_m, round(mean_dbz + 1e-6, 4) AS mean_dbz, max_dbz"


def rounded(df):
    return df.withColumns({
        c: F.round(F.col(c) + (1e-6 if c == "mean_dbz" else 0.0), 4)
        for c in ("x_m", "y_m", "mean_dbz", "range_m", "lon", "lat") if c in df.columns
    })


@register("blob_stats", query(("blobs",), f"SELECT {_BLOB}, round(sqrt(x_m*x_m + y_m*y_m), 4) AS range_m FROM blobs"))
def blob_stats(spark, sf):
    found = detect.blob_stats(grids.colmax(spark, sf).filter(F.col("value") >= 52), LATTICE)
    return rounded(found).drop("mean_rhohv", "known_rhohv")


@register("core_candidates", query(("core_cand",), f"SELECT {_BLOB}, round(range_m, 4) AS range_m FROM core_cand"))
def core_candidates(spark, sf):
    colmax, rhohv = _colmax_and_rhohv(spark, sf)
    return rounded(detect.core_candidates(colmax, LATTICE, rhohv))


@register("cores", query(("core_cand", "core_keep"),
          f"SELECT {_BLOB}, round(range_m, 4) AS range_m FROM core_cand JOIN core_keep USING (volume_id, rk)"))
def cores(spark, sf):
    colmax, rhohv = _colmax_and_rhohv(spark, sf)
    return rounded(detect.cores(colmax, LATTICE, rhohv))


def _ranked(spark, sf):
    colmax, rhohv = _colmax_and_rhohv(spark, sf)
    found = detect.core_candidates(colmax, LATTICE, rhohv)
    return found.withColumns({"strength": F.round("mean_dbz", 5), "tie": F.col("label")})


_WIDE = query(("core_cand", "core_keep_wide"),
              "SELECT volume_id, label FROM core_cand JOIN core_keep_wide USING (volume_id, rk)")


@register("greedy_dedup", _WIDE)
def greedy_dedup(spark, sf):
    """A wide radius, so that chains of candidates matter."""
    return detect.greedy_dedup(_ranked(spark, sf), 60000.0).select("volume_id", "label")


@register("greedy_dedup_rounds", _WIDE)
def greedy_dedup_rounds(spark, sf):
    """The form for groups too large to fold."""
    return detect.greedy_dedup(_ranked(spark, sf), 60000.0, rounds=True).select("volume_id", "label")


_TOP = """volume_id, level_index, label, round(x_m, 4) AS x_m, round(y_m, 4) AS y_m, altitude_m, altitude_km,
    pixel_count, round(range_m, 4) AS range_m"""


@register("top_candidates", query(("top_cand",), f"SELECT {_TOP} FROM top_cand"))
def top_candidates(spark, sf):
    return rounded(detect.top_candidates(detection_voxels(spark, sf), LATTICE, "rhohv"))


@register("tops", query(("top_cand", "top_keep"), f"SELECT {_TOP} FROM top_cand JOIN top_keep USING (volume_id, rk)"))
def tops(spark, sf):
    return rounded(detect.tops(detection_voxels(spark, sf), LATTICE, "rhohv"))


# Levels that follow the ground: each column of voxels lies ten metres higher than the one before.
table("slanted", ("high", "high_lab"), f"""
  SELECT *, row_number() OVER (PARTITION BY volume_id ORDER BY round(altitude_m, 5) DESC, level_index, label) AS rk
  FROM (SELECT *, sqrt(x_m*x_m + y_m*y_m) AS range_m FROM (
    SELECT s.img // 10 AS volume_id, CAST(s.img % 10 AS INT) AS level_index, CAST(label AS BIGINT) AS label, count(*) AS pixel_count, {XY},
           avg((s.img % 10)*3000.0::DOUBLE + (s.p % 41)*10.0::DOUBLE) AS altitude_m,
           CASE WHEN count(m.rhohv) = count(*) THEN round(avg(m.rhohv), 6) END AS mean_rhohv
    FROM high_lab s JOIN high m ON m.img = s.img AND m.r*41 + m.c = s.p GROUP BY 1, 2, 3) b) z
  WHERE pixel_count > 2 AND altitude_m > 9000 AND range_m >= 25000 AND coalesce(mean_rhohv > 0.94, true)""")
dedup("slanted_keep", "slanted", 17000.0)


@register("tops_on_slanted_levels", query(("slanted", "slanted_keep"), """SELECT volume_id, level_index, label, round(x_m, 4) AS x_m,
    round(y_m, 4) AS y_m, round(altitude_m, 4) AS altitude_m, pixel_count FROM slanted JOIN slanted_keep USING (volume_id, rk)"""))
def tops_on_slanted_levels(spark, sf):
    """Heights per voxel instead of one per level."""
    voxels = detection_voxels(spark, sf).withColumn("height", F.col("iz") * 3000.0 + F.col("ix") * 10.0)
    found = rounded(detect.tops(voxels, LATTICE, "rhohv", altitude="height")).withColumn("altitude_m", F.round("altitude_m", 4))
    return found.select("volume_id", "level_index", "label", "x_m", "y_m", "altitude_m", "pixel_count")


_LON, _LAT = lonlat_sql("x_m", "y_m")
FEATURES = f"""SELECT volume_id, kind, level_index, label, round(x_m, 4) AS x_m, round(y_m, 4) AS y_m,
    round({_LON}, 4) AS lon, round({_LAT}, 4) AS lat, intensity_dbz, altitude_m, pixel_count
    FROM (SELECT volume_id, 'core' AS kind, CAST(-1 AS INT) AS level_index, label, x_m, y_m,
            CAST(floor(mean_dbz) AS INT) AS intensity_dbz, CAST(NULL AS INT) AS altitude_m, pixel_count
          FROM core_cand JOIN core_keep USING (volume_id, rk) UNION ALL
          SELECT volume_id, 'top', level_index, label, x_m, y_m, NULL, CAST(altitude_m AS INT), pixel_count
          FROM top_cand JOIN top_keep USING (volume_id, rk)) f JOIN sites USING (volume_id)"""
BARE_TABLES = ("core_cand_bare", "core_keep_bare", "top_cand_bare", "top_keep_bare", "sites")
FEATURE_TABLES = ("core_cand", "core_keep", "top_cand", "top_keep", "sites")


def features(spark, sf, gates=None):
    return products.cores_and_tops(
        detection_voxels(spark, sf, gates), LATTICE, _lowest(spark, sf), tables.sites(spark, sf)
    )


@register("cores_and_tops", query(FEATURE_TABLES, FEATURES))
def cores_and_tops(spark, sf):
    return rounded(features(spark, sf))


@register("cores_and_tops_without_rhohv", query(BARE_TABLES, FEATURES.replace("core_cand", "core_cand_bare")
          .replace("core_keep", "core_keep_bare").replace("top_cand", "top_cand_bare").replace("top_keep", "top_keep_bare")))
def cores_and_tops_without_rhohv(spark, sf):
    """Volumes whose files have no RhoHV: neither cores nor tops are judged by it."""
    voxels = products.detection_voxels(tables.gates(spark, sf).drop("RHOHV"), grids.geometry(spark, sf), LATTICE)
    return rounded(products.cores_and_tops(voxels, LATTICE, _lowest(spark, sf), tables.sites(spark, sf)))

"""Queries that assemble volumes and state facts about them."""

from __future__ import annotations

from pyspark.sql import functions as F

from echolattice.functions.missing import mask_invalid as masked
from echolattice.operators import volumes
from workload import tables
from workload.registry import register
from workload.sqltables import query


@register("validate_sweeps", query(("raw_sweeps",), """SELECT volume_id, drift, reason IS NULL AS valid, reason FROM (
    SELECT volume_id, CAST(max(abs(gate_offset - f)) AS INT) AS drift,
      CASE WHEN count(DISTINCT nrays) > 1 THEN 'ray count differs'
           WHEN count(DISTINCT gate_size) > 1 THEN 'gate size differs'
           WHEN max(abs(gate_offset - f)) > any_value(f)//2 THEN 'gate offset drifts' END AS reason
    FROM (SELECT *, first_value(gate_offset) OVER (PARTITION BY volume_id ORDER BY sweep) AS f FROM raw_sweeps) q
    GROUP BY volume_id) z"""))  # fmt: skip
def validate_sweeps(spark, sf):
    return volumes.validate_sweeps(tables.raw_sweeps(spark, sf))


@register("uniformize_sweeps", query(("raw_sweeps", "gates"), """SELECT c.volume_id, c.sweep, c.ray, c.gate, g.DBZH
    FROM (SELECT s.volume_id, s.sweep, CAST(r AS INT) AS ray, CAST(unnest(range(w)) AS INT) AS gate
          FROM (SELECT volume_id, sweep, unnest(range(nrays)) AS r, max(ngates) OVER (PARTITION BY volume_id) AS w
                FROM raw_sweeps) s) c
    LEFT JOIN gates g USING (volume_id, sweep, ray, gate)"""))  # fmt: skip
def uniformize_sweeps(spark, sf):
    return volumes.uniform_gates(tables.raw_sweeps(spark, sf), tables.gates(spark, sf), ["DBZH"])


@register("assemble_volume", query(("raw_sweeps", "gates"), """SELECT g.volume_id, g.gate_id, g.DBZH,
    CAST(f + g.ray AS INT) AS volume_ray FROM gates g JOIN (SELECT volume_id, sweep, coalesce(sum(nrays) OVER (
      PARTITION BY volume_id ORDER BY sweep ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS f
      FROM raw_sweeps) s USING (volume_id, sweep)"""))  # fmt: skip
def assemble_volume(spark, sf):
    stacked = volumes.assemble_volume(tables.raw_sweeps(spark, sf), tables.gates(spark, sf))
    return stacked.select("volume_id", "gate_id", "DBZH", "volume_ray")


@register("align_fields", query(("alignment", "long_values"), """SELECT volume_id, field, sweep, ray,
    gate + shift AS gate, value FROM long_values JOIN alignment USING (volume_id, field) WHERE reason IS NULL"""))
def align_fields(spark, sf):
    return volumes.align_fields(tables.field_scans(spark, sf), tables.long_values(spark, sf))


@register("align_rejects", query(("alignment",), "SELECT * FROM alignment"))
def align_rejects(spark, sf):
    return volumes.field_alignment(tables.field_scans(spark, sf))


@register("pivot_fields", query(("gates",), "SELECT volume_id, sweep, ray, gate, DBZH, DBZV, ZDR, RHOHV FROM gates"))
def pivot_fields(spark, sf):
    return volumes.pivot_fields(tables.long_values(spark, sf), tables.LONG_FIELDS)


@register("ray_geometry", query(("gates", "raw_sweeps"), """SELECT volume_id, gate_id, s.elevation,
    CAST(gate_offset + gate_size*gate AS DOUBLE) AS range_m, CAST(ray AS DOUBLE) AS azimuth
    FROM gates g JOIN raw_sweeps s USING (volume_id, sweep)"""))  # fmt: skip
def ray_geometry(spark, sf):
    return volumes.ray_geometry(tables.gates(spark, sf), tables.raw_sweeps(spark, sf))


@register("mask_invalid", query(("gates",), """SELECT volume_id, gate_id,
    CASE WHEN gate % 13 = 0 OR gate % 17 = 0 THEN NULL ELSE DBZH END AS DBZH, ZDR FROM gates"""))  # fmt: skip
def mask_invalid(spark, sf):
    dirty = tables.gates(spark, sf).withColumn(
        "DBZH",
        F.when(F.col("gate") % 13 == 0, float("nan"))
        .when(F.col("gate") % 17 == 0, -1.797693134862315708e308)
        .otherwise(F.col("DBZH")),
    )
    return masked(dirty, ["DBZH", "ZDR"]).select("volume_id", "gate_id", "DBZH", "ZDR")


@register("derive_zdr", query(("gates",), """SELECT volume_id, gate_id, CASE WHEN volume_id % 3 = 1 THEN DBZH - DBZV
    WHEN gate % 5 = 0 THEN NULL ELSE ZDR END AS ZDR FROM gates"""))  # fmt: skip
def derive_zdr(spark, sf):
    absent = (F.col("volume_id") % 3 == 1) | (F.col("gate") % 5 == 0)
    partial = tables.gates(spark, sf).withColumn("ZDR", F.when(~absent, F.col("ZDR")))
    return volumes.derive_zdr(partial).select("volume_id", "gate_id", "ZDR")


@register("rename_fields", query(("gates",), "SELECT volume_id, gate_id, DBZH AS TH, DBZV AS TV, ZDR AS TDR FROM gates"))
def rename_fields(spark, sf):
    return volumes.rename_fields(tables.gates(spark, sf)).select("volume_id", "gate_id", "TH", "TV", "TDR")


_DICTIONARY = ", ".join(
    f"('{f}', '{long}', '{short}', '{unit}')" for f, lang, long, short, unit in volumes.FIELD_DICTIONARY if lang == "en"
)


@register("field_dictionary", query(("presence",), f"""SELECT p.volume_id, p.field, long_name, short_name, units
    FROM presence p JOIN (VALUES {_DICTIONARY}) d(field, long_name, short_name, units) USING (field)"""))  # fmt: skip
def field_dictionary(spark, sf):
    return volumes.describe_fields(tables.field_presence(spark, sf), "en")


@register("reflectivity_fields", query(("presence",), """SELECT volume_id,
    CASE WHEN bool_or(field = 'TH') AND NOT bool_or(field = 'DBZH') THEN 'TH' ELSE 'DBZH' END AS h_field,
    CASE WHEN bool_or(field = 'TH') THEN 'TH' ELSE 'DBZH' END AS h_field_raw,
    CASE WHEN bool_or(field = 'TV') AND NOT bool_or(field = 'DBZV') THEN 'TV' ELSE 'DBZV' END AS v_field,
    CASE WHEN bool_or(field = 'TV') THEN 'TV' ELSE 'DBZV' END AS v_field_raw FROM presence GROUP BY volume_id"""))
def reflectivity_fields(spark, sf):
    return volumes.reflectivity_fields(volumes.field_sets(tables.field_presence(spark, sf)))


@register("missing_fields", query(("presence",), """SELECT volume_id,
    coalesce(string_agg(e.field, ',' ORDER BY e.field) FILTER (p.field IS NULL), '') AS missing,
    coalesce(string_agg(e.field, ',' ORDER BY e.field) FILTER (p.field IS NOT NULL), '') AS available
    FROM (SELECT * FROM (SELECT DISTINCT volume_id FROM presence) v,
          (VALUES ('DBZH'), ('DBZV'), ('ZDR'), ('RHOHV'), ('KDP')) f(field)) e
    LEFT JOIN presence p USING (volume_id, field) GROUP BY volume_id"""))  # fmt: skip
def missing_fields(spark, sf):
    found = volumes.missing_fields(volumes.field_sets(tables.field_presence(spark, sf)), tables.EXPECTED)
    return found.withColumns({c: F.array_join(c, ",") for c in ("missing", "available")})


@register("volume_info", query(("raw_sweeps", "sites"), """SELECT volume_id, count(*) AS nsweeps,
    CAST(sum(nrays) AS BIGINT) AS nrays, max(ngates) AS ngates, CAST(sum(nrays)*max(ngates) AS BIGINT) AS total_gates,
    CAST(min(gate_offset) AS DOUBLE) AS range_min_m,
    CAST(max(gate_offset + gate_size*(ngates - 1)) AS DOUBLE) AS range_max_m,
    any_value(site_lon) AS site_lon, any_value(site_lat) AS site_lat
    FROM raw_sweeps JOIN sites USING (volume_id) GROUP BY volume_id"""))  # fmt: skip
def volume_info(spark, sf):
    return volumes.volume_info(tables.raw_sweeps(spark, sf)).join(tables.sites(spark, sf), "volume_id")


@register("blind_range", query(("raw_sweeps",), """SELECT volume_id,
    greatest(0.0::DOUBLE, arg_min(gate_offset, sweep) + 250.0::DOUBLE) AS blind_range_m,
    ceil(max(gate_offset + gate_size*(ngates - 1))/20000.0::DOUBLE)*20000.0::DOUBLE AS max_range_m
    FROM raw_sweeps GROUP BY volume_id"""))  # fmt: skip
def blind_range(spark, sf):
    return volumes.blind_and_max_range(tables.raw_sweeps(spark, sf), margin_m=250.0)


@register("lowest_sweep", query(("raw_sweeps",), """SELECT volume_id, arg_min(sweep, (elevation, sweep)) AS sweep,
    min(elevation) AS elevation FROM raw_sweeps GROUP BY volume_id"""))  # fmt: skip
def lowest_sweep(spark, sf):
    return volumes.lowest_sweep(tables.raw_sweeps(spark, sf))


@register("sweep_below", query(("raw_sweeps", "gates"), """SELECT volume_id, sweep, gate_id, DBZH FROM gates
    JOIN (SELECT volume_id, min(sweep) AS sweep FROM raw_sweeps WHERE elevation < 3.6 GROUP BY 1) s
    USING (volume_id, sweep)"""))  # fmt: skip
def sweep_below(spark, sf):
    chosen = volumes.first_sweep_below(tables.raw_sweeps(spark, sf), 3.6)
    return volumes.extract_sweep(tables.gates(spark, sf), chosen).select("volume_id", "sweep", "gate_id", "DBZH")


@register("ordered_sweeps", query(("raw_sweeps",), """SELECT volume_id, sweep, elevation, position,
    position = 1 AS is_reference, CASE WHEN available < 7 THEN 'too few sweeps' END AS reason FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY volume_id ORDER BY elevation, sweep) AS INT) AS position,
             count(*) OVER (PARTITION BY volume_id) AS available
      FROM raw_sweeps WHERE elevation >= 0.65) q"""))  # fmt: skip
def ordered_sweeps(spark, sf):
    return volumes.ordered_sweeps(tables.raw_sweeps(spark, sf), 0.65, 7)

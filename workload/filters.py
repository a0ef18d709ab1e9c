"""Gate filter queries."""

from __future__ import annotations

import pyarrow.compute as pc
from pyspark.sql import functions as F

from echolattice.operators import filters
from echolattice.operators.filters import GateFilter
from workload import tables
from workload.registry import register
from workload.sqltables import query

KEPT = ("volume_id", "gate_id", "DBZH", "RHOHV", "ZDR")
_ROWS = "volume_id, gate_id, DBZH, RHOHV, ZDR"


def _gates(spark, sf):
    """Gates with holes in DBZH, so that missing values meet every rule."""
    hole = F.col("gate") % 7 == 0
    return tables.gates(spark, sf).withColumn("DBZH", F.when(~hole, F.col("DBZH")))


_HOLED = "(SELECT * REPLACE (CASE WHEN gate % 7 = 0 THEN NULL ELSE DBZH END AS DBZH) FROM gates)"
_HOLED_XYZ = "(SELECT * REPLACE (CASE WHEN gate % 7 = 0 THEN NULL ELSE DBZH END AS DBZH) FROM gxyz)"


def _register(name: str, chain, rule: str, xyz: bool = False) -> None:
    source, needs = (_HOLED_XYZ, "gxyz") if xyz else (_HOLED, "gates")

    @register(name, query((needs,), f"SELECT {_ROWS} FROM {source} g WHERE NOT coalesce({rule}, false)"))
    def run(spark, sf):
        gates = _gates(spark, sf)
        if xyz:
            gates = tables.with_xyz(gates)
        return chain(GateFilter.on(gates)).apply(gates).select(*KEPT)


_register("exclude_below", lambda f: f.below("DBZH", 20.0), "DBZH < 20")
_register("exclude_above", lambda f: f.above("DBZH", 45.0), "DBZH > 45")
_register("exclude_between", lambda f: f.between("RHOHV", 0.7, 0.8), "RHOHV > 0.7::DOUBLE AND RHOHV < 0.8::DOUBLE")
_register("exclude_outside", lambda f: f.outside("ZDR", 0.0, 4.0), "ZDR < 0 OR ZDR > 4")
_register("exclude_equal", lambda f: f.equal("WRAD", 0.0), "abs(WRAD) < 1e-5")
_register("exclude_invalid", lambda f: f.all_missing(["DBZH", "ZDR"]), "DBZH IS NULL OR ZDR IS NULL")
_register("exclude_altitude", lambda f: f.altitude(tables.SITE_ALTITUDE, below=1200.0, above=12000.0),
          "z + 480 < 1200 OR z + 480 > 12000", xyz=True)
_register("exclude_range", lambda f: f.range(below=15000.0, above=200000.0), "range_m < 15000 OR range_m > 200000")
_register("exclude_elevation", lambda f: f.elevation(below=0.65, above=8.5), "elevation < 0.65 OR elevation > 8.5")
_register("filter_chain", lambda f: f.below("DBZH", 0.0).above("WRAD", 4.6).missing("DBZH").below("TH", 1.0),
          "DBZH < 0 OR coalesce(WRAD > 4.6, false) OR DBZH IS NULL")
_register("exclude_where", lambda f: f.where(F.col("CM") == 1, "clutter"), "CM = 1")
_register("exclude_by_function", lambda f: f.by_function("DBZH", lambda c: F.pow(c, F.lit(2)) > 900),
          "DBZH*DBZH > 900")


@register("exclude_by_mask_table", query(("gates",), f"""SELECT {_ROWS} FROM {_HOLED} g
    WHERE gate_id NOT IN (SELECT gate_id FROM gates g2 WHERE g2.volume_id = g.volume_id AND g2.VRAD > 20)"""))
def exclude_by_mask_table(spark, sf):
    """A mask kept as a table of gates, joined instead of passed as a column."""
    gates = _gates(spark, sf)
    masks = tables.gates(spark, sf).filter(F.col("VRAD") > 20).select("volume_id", "gate_id")
    return gates.join(masks, ["volume_id", "gate_id"], "left_anti").select(*KEPT)


@register("exclude_percentile", query(("gates",), f"""SELECT {_ROWS} FROM {_HOLED} g
    JOIN (SELECT volume_id, quantile_cont(DBZH, 0.1) AS q FROM {_HOLED} h GROUP BY 1) p USING (volume_id)
    WHERE NOT coalesce(DBZH < q, false)"""))  # fmt: skip
def exclude_percentile(spark, sf):
    return filters.exclude_below_percentile(_gates(spark, sf), "DBZH", 0.1).select(*KEPT)


@register("filter_summary", query(("gates",), f"""SELECT volume_id, count(*) AS total,
    count(*) FILTER (bad) AS excluded, count(*) FILTER (NOT bad) AS included,
    count(*) FILTER (bad)*100.0::DOUBLE/count(*) AS percent_excluded, 'DBZH < 10.0,ZDR > 6.0' AS history
    FROM (SELECT *, coalesce(DBZH < 10, false) OR coalesce(ZDR > 6, false) AS bad FROM {_HOLED} g) q
    GROUP BY volume_id"""))  # fmt: skip
def filter_summary(spark, sf):
    gates = _gates(spark, sf)
    found = GateFilter.on(gates).below("DBZH", 10.0).above("ZDR", 6.0).summary(gates)
    return found.withColumn("history", F.array_join("history", ","))


@register("field_with_mask", query(("gates",), f"""SELECT volume_id, gate_id,
    CASE WHEN NOT coalesce(RHOHV < 0.8, false) THEN DBZH END AS DBZH FROM {_HOLED} g"""))  # fmt: skip
def field_with_mask(spark, sf):
    gates = _gates(spark, sf)
    return GateFilter.on(gates).below("RHOHV", 0.8).mask(gates, "DBZH").select("volume_id", "gate_id", "DBZH")


@register("mask_fields_by_source", query(("gates",), f"""SELECT volume_id, gate_id, DBZH, ZDR,
    CASE WHEN NOT bad THEN DBZH END AS DBZHf, CASE WHEN NOT bad THEN ZDR END AS ZDRf,
    'RHOHV<0.8,RHOHV>0.99' AS applied
    FROM (SELECT *, coalesce(RHOHV < 0.8, false) OR coalesce(RHOHV > 0.99, false) AS bad FROM {_HOLED} g) q"""))
def mask_fields_by_source(spark, sf):
    out = filters.mask_by_source(
        _gates(spark, sf), "RHOHV", ["DBZH", "ZDR", "TH"], below=0.8, above=0.99, suffix="f", trail="applied"
    )
    return out.select("volume_id", "gate_id", "DBZH", "ZDR", "DBZHf", "ZDRf", F.array_join("applied", ",").alias("applied"))


@register("mask_fields_by_mask", query(("gates",), f"""SELECT volume_id, gate_id,
    CASE WHEN NOT WRAD > 4 THEN DBZH END AS DBZH, CASE WHEN NOT WRAD > 4 THEN ZDR END AS ZDR FROM {_HOLED} g"""))
def mask_fields_by_mask(spark, sf):
    masks = tables.gates(spark, sf).select("volume_id", "gate_id", (F.col("WRAD") > 4).alias("masked"))
    return filters.mask_by_mask(_gates(spark, sf), masks, ["DBZH", "ZDR"]).select("volume_id", "gate_id", "DBZH", "ZDR")


@register("mask_outside", query(("gates",), """SELECT volume_id, gate_id, CASE WHEN ray >= 4 AND ray < 30
    AND range_m - 6000 >= 40000 AND range_m < 180000 THEN DBZH END AS DBZH FROM gates"""))  # fmt: skip
def mask_outside(spark, sf):
    out = filters.mask_annulus(
        tables.gates(spark, sf), ["DBZH"], tables.GATE_SIZE, tables.GATES, inner_km=40, outer_km=180, rays=(4, 30)
    )
    return out.select("volume_id", "gate_id", "DBZH")


@register("mask_inside", query(("gates",), """SELECT volume_id, gate_id, CASE WHEN NOT (ray >= 4 AND ray < 30
    AND range_m >= 40000 AND gate < 39) THEN DBZH END AS DBZH FROM gates"""))  # fmt: skip
def mask_inside(spark, sf):
    out = filters.mask_annulus(
        tables.gates(spark, sf), ["DBZH"], tables.GATE_SIZE, tables.GATES, inner_km=40, rays=(4, 30), side="inside"
    )
    return out.select("volume_id", "gate_id", "DBZH")


@register("colmax_filter", query(("gates",), f"""SELECT {_ROWS} FROM {_HOLED} g
    WHERE NOT (elevation < 0.65 OR RHOHV < 0.8 OR WRAD > 4.6 OR ZDR > 8.5)"""))  # fmt: skip
def colmax_filter(spark, sf):
    gates = _gates(spark, sf)
    return filters.colmax_filter(gates).apply(gates).select(*KEPT)


@register("field_filter", query(("gates",), f"""SELECT {_ROWS} FROM {_HOLED} g
    WHERE NOT (RHOHV < 0.55 OR WRAD > 4.6 OR coalesce(DBZH < -3, false) OR ZDR > 8.5)"""))  # fmt: skip
def field_filter(spark, sf):
    gates = _gates(spark, sf)
    return filters.field_filter(gates).apply(gates).select(*KEPT)


@register("quality_rules", query(("stage3",), f"SELECT {_ROWS} FROM stage3"))
def quality_rules(spark, sf):
    gates = tables.gates(spark, sf)
    return gates.filter(~filters.quality_rules(gates.columns)).select(*KEPT)


@register("despeckle", query(("speckle1",), f"""SELECT {_ROWS} FROM good_rhohv g
    JOIN speckle1 s ON s.img = g.img AND s.p = g.r*40 + g.c
    SEMI JOIN (SELECT img, label FROM good_rhohv g JOIN speckle1 s USING (img) WHERE s.p = g.r*40 + g.c
               GROUP BY 1, 2 HAVING count(*) >= 4 AND round(avg(RHOHV), 6) >= 0.86) o ON o.img = s.img AND o.label = s.label"""))
def despeckle(spark, sf):
    gates = tables.gates(spark, sf)
    excluded = GateFilter.on(gates).below("RHOHV", 0.75).excluded
    kept = filters.despeckle(gates, excluded, tables.RAYS, tables.GATES, size=4, mean_threshold=0.86, delta_deg=15.0)
    return kept.select(*KEPT)


@register("quality_filter", query(("speckle3",), f"""SELECT {_ROWS} FROM stage3 g
    JOIN speckle3 s ON s.img = g.img AND s.p = g.r*40 + g.c
    SEMI JOIN (SELECT img, label FROM stage3 g JOIN speckle3 s USING (img) WHERE s.p = g.r*40 + g.c
               GROUP BY 1, 2 HAVING count(*) >= 3 AND round(avg(RHOHV), 6) >= 0.85) o ON o.img = s.img AND o.label = s.label"""))
def quality_filter(spark, sf):
    gates = tables.gates(spark, sf)
    kept = filters.quality_filter(gates, tables.RAYS, tables.GATES, tables.GATE_SIZE, delta_deg=15.0)
    return kept.select(*KEPT)


@register("exclude_vectorised", query(("gates",), f"""SELECT {_ROWS} FROM {_HOLED} g
    WHERE NOT coalesce(abs(DBZH - 20) > 30, false) AND NOT coalesce(ZDR > 4 AND RHOHV < 0.8, false)"""))  # fmt: skip
def exclude_vectorised(spark, sf):
    """Predicates over Arrow arrays: one of a single field, one of two."""
    gates = _gates(spark, sf)
    far = filters.vectorised(lambda v: pc.greater(pc.abs(pc.subtract(v, 20.0)), 30.0))
    odd = filters.vectorised(lambda zdr, rhohv: pc.and_kleene(pc.greater(zdr, 4.0), pc.less(rhohv, 0.8)))
    chain = GateFilter.on(gates).by_function("DBZH", far).where(odd(F.col("ZDR"), F.col("RHOHV")))
    return chain.apply(gates).select(*KEPT)

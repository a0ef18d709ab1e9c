"""Raster queries on the column-maximum pixels."""

from __future__ import annotations

from pyspark.sql import functions as F

from echolattice.functions.colours import LISTED, Scale
from echolattice.operators import rasters
from workload import grids, tables
from workload.registry import register
from workload.scalars import BOUNDS, product_bounds_of
from workload.sqltables import query

SCALE = Scale("th")


def channel_sql(scale: Scale, index: str, channel: str) -> str:
    """A channel of a scale at an index, by the interval the index falls in."""
    last = scale.size - 1
    if scale.base in LISTED:
        at = 1 + 2 * ("red", "green", "blue").index(channel)
        steps = [int(c[at : at + 2], 16) for c in LISTED[scale.base]]
        return f"CAST(floor(list_extract({[s / 255 for s in steps]}::DOUBLE[], {index} + 1)*255) AS SMALLINT)"
    knots = scale.knots(channel)
    cases = [f"WHEN {index} <= 0 THEN {knots[0][2]}::DOUBLE", f"WHEN {index} >= {last} THEN {knots[-1][1]}::DOUBLE"]
    for (x0, _, right), (x1, left, _) in zip(knots, knots[1:]):
        if x1 > x0:
            lo, hi = f"({x0}::DOUBLE*{last})", f"({x1}::DOUBLE*{last})"
            cases.append(
                f"WHEN {index} > {lo} AND {index} <= {hi} THEN ({index} - {lo})/({hi} - {lo})"
                f"*({left}::DOUBLE - {right}::DOUBLE) + {right}::DOUBLE"
            )
    return f"CAST(floor((CASE {' '.join(cases)} END)*255) AS SMALLINT)"


def index_sql(value: str, low: str, high: str, size: int) -> str:
    share = f"least(greatest(({value} - {low})/({high} - {low}), 0.0::DOUBLE), 1.0::DOUBLE)"
    return f"CAST(least(floor(coalesce({share}, 0)*{size}), {size - 1}) AS INT)"


def rgb_sql(scale: Scale, index: str) -> str:
    return ", ".join(f"{channel_sql(scale, index, c)} AS {c}" for c in rasters.CHANNELS)


def coloured_sql(source: str, scale: Scale, low: str, high: str) -> str:
    return f"""SELECT * EXCLUDE (i), {rgb_sql(scale, 'i')},
      CAST(CASE WHEN value IS NULL THEN 0 ELSE 255 END AS SMALLINT) AS alpha
      FROM (SELECT *, {index_sql('value', low, high, scale.size)} AS i FROM {source}) q"""


HOLED = "(SELECT volume_id, iy, ix, CASE WHEN ix % 5 = 0 THEN NULL ELSE value END AS value FROM colmax)"


def holed(spark, sf):
    """Pixels with some missing values kept as rows."""
    return grids.colmax(spark, sf).withColumn("value", F.when(F.col("ix") % 5 != 0, F.col("value")))


@register("value_range", query(("colmax",), f"""SELECT volume_id, coalesce(-20.0::DOUBLE, min(value)) AS vmin,
    coalesce(max(value), 1) AS vmax FROM {HOLED} h GROUP BY 1"""))  # fmt: skip
def value_range(spark, sf):
    return rasters.value_range(holed(spark, sf), vmin=-20.0)


@register("colormap_lut", query(("colmax",), f"""SELECT volume_id, i AS index, vmin + i*((vmax - vmin)/255) AS value,
    {rgb_sql(SCALE, 'i')} FROM (SELECT volume_id, min(value) AS vmin, max(value) AS vmax FROM colmax GROUP BY 1) r,
    (SELECT CAST(unnest(range(256)) AS INT) AS i) t"""))  # fmt: skip
def colormap_lut(spark, sf):
    """Every entry of the scale with its value over each volume's range."""
    return rasters.legend(rasters.value_range(grids.colmax(spark, sf)), SCALE)


@register("colorize", query(("colmax",), coloured_sql(HOLED, SCALE, "(-20)", "70")))
def colorize(spark, sf):
    return rasters.colorize(holed(spark, sf), SCALE, -20.0, 70.0)


@register("recolor", query(("colmax",), f"""SELECT * EXCLUDE (vmin, vmax) FROM ({coloured_sql(
    f'(SELECT h.*, vmin, vmax FROM {HOLED} h JOIN (SELECT volume_id, min(value) AS vmin, max(value) AS vmax FROM {HOLED} k GROUP BY 1) r USING (volume_id))',
    Scale('rho_r'), 'vmin', 'vmax')}) z"""))  # fmt: skip
def recolor(spark, sf):
    """From one scale to the reversed form of another, over each volume's own range."""
    first = rasters.colorize(holed(spark, sf), SCALE, -20.0, 70.0)
    return rasters.recolor(first, Scale("rho_r"))


@register("colorize_listed", query(("colmax",), coloured_sql(HOLED, Scale("hscan"), "0", "60")))
def colorize_listed(spark, sf):
    return rasters.colorize(holed(spark, sf), Scale("hscan"), 0.0, 60.0)


@register("colorize_jet", query(("colmax",), coloured_sql(HOLED, Scale("jet"), "(-4)", "80")))
def colorize_jet(spark, sf):
    return rasters.colorize(holed(spark, sf), Scale("jet"), -4.0, 80.0)


@register("uncolor", query(("colmax",), f"""
    SELECT c.volume_id, c.iy, c.ix, round(CASE WHEN alpha > 0 THEN k.value END, 6) AS value
    FROM ({coloured_sql(HOLED, SCALE, '(-20)', '70')}) c
    LEFT JOIN (SELECT red, green, blue, arg_min(t.value, (d, j)) AS value FROM (
        SELECT o.red, o.green, o.blue, t.j, t.value, (o.red::INT - t.red)**2 + (o.green::INT - t.green)**2
          + (o.blue::INT - t.blue)**2 AS d
        FROM (SELECT DISTINCT red, green, blue FROM ({coloured_sql(HOLED, SCALE, '(-20)', '70')}) x WHERE alpha > 0) o,
          (SELECT j, value, {rgb_sql(SCALE, 'i')} FROM (SELECT j, -20.0::DOUBLE + j*(90.0::DOUBLE/1023) AS value,
             {index_sql('(-20.0::DOUBLE + j*(90.0::DOUBLE/1023))', '(-20)', '70', 256)} AS i
             FROM (SELECT unnest(range(1024)) AS j) u) v) t) t GROUP BY 1, 2, 3) k USING (red, green, blue)"""))
def uncolor(spark, sf):
    shown = rasters.colorize(holed(spark, sf), SCALE, -20.0, 70.0).drop("value")
    back = rasters.uncolor(shown, SCALE, -20.0, 70.0)
    return back.select("volume_id", "iy", "ix", F.round("value", 6).alias("value"))


BLOCK = "(SELECT volume_id, f AS factor, CAST(iy//f AS INT) AS iy, CAST(ix//f AS INT) AS ix, value, iy*16777216 + ix AS o FROM colmax, (SELECT CAST(unnest([2, 4, 8, 16]) AS INT) AS f) t)"


def _overview(method: str, sql: str, rounded: bool) -> None:
    @register(f"overviews_{method}", query(("colmax",), f"SELECT volume_id, factor, iy, ix, {sql} AS value FROM {BLOCK} b GROUP BY 1, 2, 3, 4"))
    def run(spark, sf):
        out = rasters.overviews(grids.colmax(spark, sf), method)
        # Means of few decimals can fall on a half; a nudge keeps both engines on one side.
        return out.withColumn("value", F.round(F.col("value") + 1e-8, 6)) if rounded else out


_overview("average", "round(avg(value) + 1e-8, 6)", True)
_overview("rms", "round(sqrt(avg(value*value)) + 1e-8, 6)", True)
_overview("nearest", "arg_min(value, o)", False)


@register("overviews_mode", query(("colmax",), f"""SELECT volume_id, factor, iy, ix, arg_min(value, (-n, value)) AS value
    FROM (SELECT volume_id, factor, iy, ix, value, count(*) AS n FROM {BLOCK} b GROUP BY ALL) c
    GROUP BY 1, 2, 3, 4"""))  # fmt: skip
def overviews_mode(spark, sf):
    return rasters.overviews(grids.colmax(spark, sf), "mode")


@register("window_read", query(("colmax",), coloured_sql(
    f"(SELECT * FROM {HOLED} h WHERE iy BETWEEN 8 AND 24 AND ix BETWEEN 10 AND 30)", SCALE, "(-20)", "70")))
def window_read(spark, sf):
    return rasters.window_read(holed(spark, sf), (8, 24), (10, 30), SCALE, -20.0, 70.0)


@register("georeference", query(("colmax", "sites"), f"""SELECT volume_id, CAST(40 - iy AS INT) AS row, ix, value,
    round(west + (ix + 0.5)*((east - west)/41), 6) AS lon,
    round(north - (40 - iy + 0.5)*((north - south)/41), 6) AS lat FROM colmax JOIN {BOUNDS} b USING (volume_id)"""))
def georeference(spark, sf):
    placed = rasters.georeference(grids.colmax(spark, sf), product_bounds_of(spark, sf), tables.LATTICE)
    return placed.select(
        "volume_id", "row", "ix", "value", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat")
    )


_LIMITS = ", ".join(f"('{k}', {str(f).lower()}, {a}::DOUBLE, {b}::DOUBLE, '{s}')" for k, f, a, b, s in rasters.PLOT_LIMITS)


@register("plot_limits", query(("presence",), f"""SELECT volume_id, field, p.filtered, vmin, vmax, scale
    FROM (SELECT volume_id, field, volume_id % 2 = 0 AS filtered FROM presence) p
    LEFT JOIN (VALUES {_LIMITS}) l(key, filtered, vmin, vmax, scale)
    ON l.filtered = p.filtered AND l.key = CASE WHEN field IN ('DBZH', 'DBZV', 'COLMAX') THEN 'REFL' ELSE field END"""))
def plot_limits(spark, sf):
    shown = tables.field_presence(spark, sf).withColumn("filtered", F.col("volume_id") % 2 == 0)
    return rasters.plot_limits(shown).select("volume_id", "field", "filtered", "vmin", "vmax", "scale")

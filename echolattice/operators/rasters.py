"""Rasters as pixel tables: colours, overviews, tiles and map positions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolattice.config import Lattice
from echolattice.functions.colours import Scale, index_of
from echolattice.functions.inline import inline_table

CHANNELS = ("red", "green", "blue")

# --- fixed values: display limits (field, filtered, low, high, scale) -----
PLOT_LIMITS = (
    ("REFL", False, -20.0, 70.0, "th"),
    ("RHOHV", False, 0.0, 1.0, "rho"),
    ("PHIDP", False, -5.0, 360.0, "th"),
    ("KDP", False, -4.0, 8.0, "jet"),
    ("ZDR", False, -7.5, 7.5, "zdr"),
    ("VRAD", False, -30.0, 30.0, "vrad"),
    ("WRAD", False, -2.0, 6.0, "th"),
    ("REFL", True, -20.0, 70.0, "th"),
    ("RHOHV", True, 0.0, 1.0, "rho"),
    ("PHIDP", True, -5.0, 360.0, "th"),
    ("KDP", True, -4.0, 8.0, "jet"),
    ("ZDR", True, -2.0, 7.5, "zdr"),
    ("VRAD", True, -15.0, 15.0, "vrad"),
    ("WRAD", True, -2.0, 6.0, "th"),
)
SHARED_LIMITS = ("DBZH", "DBZV", "COLMAX")


def value_range(pixels: DataFrame, vmin: float | None = None, vmax: float | None = None) -> DataFrame:
    """Range per volume: the given ends, else the data's, else 0 and 1."""
    return pixels.groupBy("volume_id").agg(
        F.coalesce(F.lit(vmin).cast("double"), F.min("value"), F.lit(0.0)).alias("vmin"),
        F.coalesce(F.lit(vmax).cast("double"), F.max("value"), F.lit(1.0)).alias("vmax"),
    )


def legend(ranges: DataFrame, scale: Scale) -> DataFrame:
    """Every entry of a scale with its value over each volume's range."""
    last = scale.size - 1
    index = F.col("index")
    entries = ranges.withColumn("index", F.explode(F.sequence(F.lit(0), F.lit(last))))
    value = F.col("vmin") + index * ((F.col("vmax") - F.col("vmin")) / last)
    return entries.select("volume_id", "index", value.alias("value"), *[scale.byte(index, c).alias(c) for c in CHANNELS])


def colorize(pixels: DataFrame, scale: Scale, vmin: Column | float, vmax: Column | float) -> DataFrame:
    """Add red, green, blue and alpha; a missing value is transparent.

    The range may be a column (join :func:`value_range` for one per volume).
    """
    low = vmin if isinstance(vmin, Column) else F.lit(float(vmin))
    high = vmax if isinstance(vmax, Column) else F.lit(float(vmax))
    indexed = pixels.withColumn("index", index_of(F.col("value"), low, high, scale.size))
    alpha = F.when(F.col("value").isNull(), 0).otherwise(255).cast("short")
    return indexed.withColumns(
        {c: scale.byte(F.col("index"), c) for c in CHANNELS} | {"alpha": alpha}
    ).drop("index")


def recolor(pixels: DataFrame, scale: Scale, vmin: float | None = None, vmax: float | None = None) -> DataFrame:
    """Colour stored values anew; refuses a table that only holds colours."""
    if "value" not in pixels.columns:
        raise ValueError("only stored values can be recoloured; convert colours to values first")
    stored = pixels.drop(*CHANNELS, "alpha")
    if vmin is not None and vmax is not None:
        return colorize(stored, scale, vmin, vmax)
    ranged = stored.join(value_range(stored, vmin, vmax), "volume_id")
    return colorize(ranged, scale, F.col("vmin"), F.col("vmax")).drop("vmin", "vmax")


def uncolor(pixels: DataFrame, scale: Scale, vmin: float, vmax: float, entries: int = 1024) -> DataFrame:
    """Values back from colours: nearest entry of a dense table, transparent is missing.

    Distances are worked out once per distinct colour, within the row, and joined
    back; pixels never meet the table.
    """
    step = (vmax - vmin) / (entries - 1)

    def entry(i: Column) -> Column:
        value = F.lit(vmin) + i * step
        index = index_of(value, F.lit(vmin), F.lit(vmax), scale.size)
        return F.struct(value.alias("value"), *[scale.byte(index, c).cast("int").alias(c) for c in CHANNELS])

    table = F.transform(F.sequence(F.lit(0), F.lit(entries - 1)), entry)

    def farness(one: Column) -> Column:
        gaps = [(F.col(c).cast("int") - one[c]) * (F.col(c).cast("int") - one[c]) for c in CHANNELS]
        return gaps[0] + gaps[1] + gaps[2]

    ranked = F.transform("table", lambda one, i: F.struct(farness(one).alias("d"), i.alias("i"), one["value"].alias("v")))
    colours = pixels.filter(F.col("alpha") > 0).select(*CHANNELS).distinct().withColumn("table", table)
    known = colours.select(*CHANNELS, F.array_min(ranked)["v"].alias("restored"))
    joined = pixels.join(known, list(CHANNELS), "left")
    return joined.withColumn("value", F.when(F.col("alpha") > 0, F.col("restored"))).drop("restored")


FACTORS = (2, 4, 8, 16)


def overviews(pixels: DataFrame, method: str = "average", factors: Sequence[int] = FACTORS) -> DataFrame:
    """Coarser rasters by blocks of whole pixels.

    average, rms: of the block's valid pixels.  nearest: the block's first valid
    pixel in raster order.  mode: its most frequent value, the smallest on a tie.
    """
    # A block of all factors at once: pixels are exchanged once, not each with every factor.
    whole = math.lcm(*factors)
    around = {"__by": F.floor(F.col("iy") / whole), "__bx": F.floor(F.col("ix") / whole)}
    placed = pixels.filter(F.col("value").isNotNull()).withColumns(around).repartition("volume_id", *around)
    wide = placed.withColumn("factor", F.explode(F.array(*[F.lit(f) for f in factors])))
    block = {n: F.floor(F.col(n) / F.col("factor")).cast("int").alias(n) for n in ("iy", "ix")}
    combine = {
        "average": lambda: F.avg("value"),
        "rms": lambda: F.sqrt(F.avg(F.col("value") * F.col("value"))),
        "nearest": lambda: F.min_by("value", F.struct("iy", "ix")),
        "mode": lambda: F.mode("value", deterministic=True),
    }
    if method not in combine:
        raise ValueError(f"unknown resampling: {method}")
    blocks = wide.groupBy("volume_id", *around, "factor", *block.values()).agg(combine[method]().alias("value"))
    return blocks.drop(*around)


def window_read(
    pixels: DataFrame, rows: tuple[int, int], cols: tuple[int, int], scale: Scale, vmin: float, vmax: float
) -> DataFrame:
    """A rectangle of a raster (inclusive bounds) in colour."""
    part = pixels.filter(F.col("iy").between(*rows) & F.col("ix").between(*cols))
    return colorize(part, scale, vmin, vmax)


def georeference(pixels: DataFrame, bounds: DataFrame, lattice: Lattice) -> DataFrame:
    """Pixel centres in the bounds box, rows counted from the north."""
    placed = pixels.join(bounds, "volume_id").withColumn("row", F.lit(lattice.ny - 1) - F.col("iy"))
    lon = F.col("west") + (F.col("ix") + 0.5) * ((F.col("east") - F.col("west")) / lattice.nx)
    lat = F.col("north") - (F.col("row") + 0.5) * ((F.col("north") - F.col("south")) / lattice.ny)
    return placed.withColumns({"lon": lon, "lat": lat}).drop("west", "south", "east", "north")


def plot_limits(shown: DataFrame) -> DataFrame:
    """Display limits of (field, filtered) rows; reflectivities share one entry."""
    listed = inline_table(shown.sparkSession, ("key", "filtered", "vmin", "vmax", "scale"), PLOT_LIMITS)
    key = F.when(F.col("field").isin(list(SHARED_LIMITS)), "REFL").otherwise(F.col("field"))
    return shown.withColumn("key", key).join(F.broadcast(listed), ["key", "filtered"], "left").drop("key")

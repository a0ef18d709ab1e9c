"""Voxel to gate maps: a distance range join written as an equi-join on bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echolattice.config import Lattice
from echolattice.functions import geomath
from echolattice.session import spread

# A nearest-gate key packs the distance, in steps of 2^-18 m (four micrometres), above the
# gate index.  Distances below 2^18 m (262 km) and gate indices below 2**27 fit one BIGINT, so
# the minimum stays in a hash aggregate; a struct minimum would need a sort.
GATE_SLOTS, STEPS = 1 << 27, 1 << 18
FARTHEST = float(1 << 18)


class Parameters:
    """Lattice parameters, taken per row where a column of that name exists."""

    def __init__(self, df: DataFrame, lattice: Lattice):
        self._columns = set(df.columns)
        self._lattice = lattice

    def __getitem__(self, name: str) -> Column:
        if name in self._columns:
            return F.col(name)
        value = getattr(self._lattice, name)
        return F.lit(None).cast("double") if value is None else F.lit(value)


PER_GEOMETRY = ("h_factor", "nb", "bsp", "min_radius", "toa", "blind_range_m", "lowest_elevation")


def axis(index: Column, limits: tuple[float, float], points: int) -> Column:
    """Coordinate of an index on an evenly spaced axis."""
    if points <= 1:
        return F.lit(float(limits[0])) + index * 0.0
    return F.lit(float(limits[0])) + index * ((limits[1] - limits[0]) / (points - 1))


def with_indices(df: DataFrame, lattice: Lattice) -> DataFrame:
    """Split a voxel id into level, row and column."""
    plane = lattice.ny * lattice.nx
    return df.withColumns({
        "iz": F.expr(f"voxel_id div {plane}").cast("int"),
        "iy": F.expr(f"(voxel_id % {plane}) div {lattice.nx}").cast("int"),
        "ix": F.expr(f"voxel_id % {lattice.nx}").cast("int"),
    })


def voxels(geometries: DataFrame, lattice: Lattice) -> DataFrame:
    """Every voxel of every geometry with its position and radius of influence.

    Lattice rows are spread over the cluster before columns are unrolled.
    """
    kept = [c for c in PER_GEOMETRY if c in geometries.columns]
    lines = geometries.select("geometry_id", *kept).withColumn(
        "line", F.explode(F.sequence(F.lit(0), F.lit(lattice.nz * lattice.ny - 1)))
    )
    rows = spread(lines, "geometry_id", "line")
    cells = rows.withColumn("ix", F.explode(F.sequence(F.lit(0), F.lit(lattice.nx - 1)))).select(
        "geometry_id",
        *kept,
        (F.col("line").cast("bigint") * lattice.nx + F.col("ix")).alias("voxel_id"),
        F.expr(f"line div {lattice.ny}").cast("int").alias("iz"),
        F.expr(f"line % {lattice.ny}").cast("int").alias("iy"),
        "ix",
    )
    placed = cells.withColumns({
        "x": axis(F.col("ix"), lattice.x_limits, lattice.nx),
        "y": axis(F.col("iy"), lattice.y_limits, lattice.ny),
        "z": axis(F.col("iz"), lattice.z_limits, lattice.nz),
    })
    p = Parameters(placed, lattice)
    roi = geomath.influence_radius(
        F.col("x"), F.col("y"), F.col("z"), p["h_factor"], p["nb"], p["bsp"], p["min_radius"]
    )
    return placed.withColumn("roi", roi)


def searched_voxels(geometries: DataFrame, lattice: Lattice) -> DataFrame:
    """Voxels outside the blind zone and not below the lowest beam."""
    cells = voxels(geometries, lattice)
    p = Parameters(cells, lattice)
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    blind = (p["blind_range_m"] > 0) & (F.sqrt(x * x + y * y + z * z) <= p["blind_range_m"])
    margin = 0.8 * lattice.z_step if lattice.nz > 1 else 400.0
    below = z < geomath.beam_height(F.sqrt(x * x + y * y), p["lowest_elevation"]) - margin
    return cells.filter(~F.coalesce(blind, F.lit(False)) & ~F.coalesce(below, F.lit(False)))


def _level(radius: Column, min_radius: Column) -> Column:
    return F.greatest(F.ceil(F.log2(radius / min_radius)), F.lit(0)).cast("int")


def neighbours(gate_positions: DataFrame, geometries: DataFrame, lattice: Lattice, salt: int = 1) -> DataFrame:
    """All (voxel, gate) pairs with squared distance below the voxel's radius squared.

    The radius grows with distance, so voxels are put in levels of radii doubling
    from the smallest, and each level has its own bin edge (the level's largest
    radius).  A voxel probes the bins its ball meets.  A gate is copied only to
    levels it can serve: the radius function changes by at most ``slope`` per
    metre, which bounds the radius of any voxel that reaches the gate from both
    sides, so one or two copies suffice and no join is needed to find them.

    ``salt`` splits the voxels of every bin and copies the gates as often.
    """
    cells = searched_voxels(geometries, lattice)
    p = Parameters(cells, lattice)
    probing = cells.withColumn("level", _level(F.col("roi"), p["min_radius"])).withColumn(
        "edge", p["min_radius"] * F.pow(F.lit(2.0), F.col("level"))
    )
    for name in ("x", "y", "z"):
        low = F.floor((F.col(name) - F.col("roi")) / F.col("edge"))
        high = F.floor((F.col(name) + F.col("roi")) / F.col("edge"))
        probing = probing.withColumn(f"b{name}", F.explode(F.sequence(low, high)))

    def gap(name: str) -> Column:
        start = F.col(f"b{name}") * F.col("edge")
        return F.greatest(start - F.col(name), F.col(name) - start - F.col("edge"), F.lit(0.0))

    reach = gap("x") * gap("x") + gap("y") * gap("y") + gap("z") * gap("z")
    probing = probing.filter(reach < F.col("roi") * F.col("roi")).select(
        "geometry_id", "level", "bx", "by", "bz",
        (F.col("voxel_id") % salt).cast("int").alias("salt"),
        "voxel_id", "roi",
        F.col("x").alias("vx"), F.col("y").alias("vy"), F.col("z").alias("vz"),
    )

    g = Parameters(gate_positions, lattice)
    widening = F.tan(g["nb"] * g["bsp"] * 3.141592653589793 / 180.0)
    slope = F.sqrt(F.pow(g["h_factor"] / 20.0, F.lit(2.0)) + widening * widening) + 1e-9
    own = geomath.influence_radius_raw(F.col("x"), F.col("y"), F.col("z"), g["h_factor"], g["nb"], g["bsp"])
    corner = max(abs(v) for v in (*lattice.x_limits, *lattice.y_limits))
    widest = geomath.influence_radius(
        corner, corner, lattice.z_limits[1], g["h_factor"], g["nb"], g["bsp"], g["min_radius"]
    )
    smallest = F.greatest(own / (1 + slope), g["min_radius"])
    largest = F.when(slope < 1, F.greatest(own / (1 - slope), g["min_radius"])).otherwise(widest)
    low, high = _level(smallest, g["min_radius"]), _level(largest, g["min_radius"])
    offered = (
        gate_positions.filter(F.col("z") <= g["toa"])
        .withColumn("level", F.explode(F.sequence(low, F.greatest(low, high))))
        .withColumn("edge", g["min_radius"] * F.pow(F.lit(2.0), F.col("level")))
        .select(
            "geometry_id", "level",
            *[F.floor(F.col(n) / F.col("edge")).alias(f"b{n}") for n in ("x", "y", "z")],
            F.explode(F.sequence(F.lit(0), F.lit(salt - 1))).alias("salt"),
            "gate_id", "x", "y", "z",
        )
    )
    dx, dy, dz = F.col("x") - F.col("vx"), F.col("y") - F.col("vy"), F.col("z") - F.col("vz")
    # The map is wider than the gate list only on tiny lattices; a shuffled hash
    # join avoids sorting the bins, AQE splits a bin that is still too large.
    met = probing.join(offered.hint("shuffle_hash"), ["geometry_id", "level", "bx", "by", "bz", "salt"])
    return (
        met.withColumn("d2", dx * dx + dy * dy + dz * dz)
        .filter(F.col("d2") < F.col("roi") * F.col("roi"))
        .select("geometry_id", "voxel_id", "gate_id", "d2", "roi")
    )


def shared_scans(scans: DataFrame) -> DataFrame:
    """geometry_id and shared_id: geometries with the same scan in every column share the least id.

    ``scans`` has a row per sweep.  A map is searched once per shared_id and joined to
    all geometries that share it.
    """
    rest = sorted(c for c in scans.columns if c != "geometry_id")
    shape = F.sha2(F.to_json(F.sort_array(F.collect_list(F.struct(*rest)))), 256)
    shapes = scans.groupBy("geometry_id").agg(shape.alias("shape"))
    least = shapes.groupBy("shape").agg(F.min("geometry_id").alias("shared_id"))
    return shapes.join(least, "shape").select("geometry_id", "shared_id")


def for_all(shared: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of shared geometries (with ``voxel_id``) for every geometry that shares them.

    Many geometries may share one scan, so voxels are dealt into as many parts as there are
    shuffle partitions and a part is joined to a copy of the list for it.  Rank, weigh and sum before this.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    users = shared.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    dealt = rows.withColumnRenamed("geometry_id", "shared_id").withColumn("__part", F.pmod("voxel_id", F.lit(parts)).cast("int"))
    return users.join(dealt, ["shared_id", "__part"]).drop("shared_id", "__part")


def _steps(d2: Column) -> Column:
    """The distance in whole steps; nearer by a step is nearer, else the lower gate index counts."""
    return F.floor(F.sqrt(d2) * F.lit(STEPS))


def nearest_gate_of(pairs: DataFrame) -> DataFrame:
    """The nearest gate of each voxel, ties to the lower index.

    The packed minimum combines map-side, so about one row per voxel is shuffled.
    """
    fits = F.col("gate_id").between(0, GATE_SLOTS - 1) & (F.col("d2") < FARTHEST * FARTHEST)
    gate = F.when(fits, F.col("gate_id")).otherwise(F.raise_error(F.lit("a gate index or a distance does not fit its key")).cast("bigint"))
    packed = _steps(F.col("d2")) * F.lit(GATE_SLOTS) + gate
    best = pairs.groupBy("geometry_id", "voxel_id").agg(F.min(packed).alias("best"))
    distance = F.expr(f"best div {GATE_SLOTS}") / F.lit(float(STEPS))
    return best.select("geometry_id", "voxel_id", (F.col("best") % GATE_SLOTS).alias("gate_id"), (distance * distance).alias("d2"))


def knn_gates(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest gates of each voxel; the rank limit is applied before the shuffle."""
    if k == 1:
        return nearest_gate_of(pairs)
    order = Window.partitionBy("geometry_id", "voxel_id").orderBy(_steps(F.col("d2")), "gate_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def neighbour_weights(pairs: DataFrame, weighting: str) -> DataFrame:
    """Add ``weight`` by name (any case): barnes, barnes2, cressman or nearest."""
    d2, roi = F.col("d2"), F.col("roi")
    kind = weighting.lower()
    if kind == "nearest":
        # A minimum over the voxel, not a rank: the gates of a voxel need no order.
        packed = _steps(F.col("d2")) * F.lit(GATE_SLOTS) + F.col("gate_id")
        least = F.min(packed).over(Window.partitionBy("geometry_id", "voxel_id"))
        return pairs.withColumn("weight", F.when(packed == least, 1.0).otherwise(0.0))
    if kind == "barnes":
        weight = F.exp(-d2 / (2 * (roi / 2) * (roi / 2)))
    elif kind == "barnes2":
        weight = F.exp(-4 * d2 / (roi * roi)) + 1e-5
    elif kind == "cressman":
        r2 = roi * roi
        weight = F.least(F.greatest((r2 - d2) / (r2 + d2 + 1e-12), F.lit(0.0)), F.lit(1.0))
    else:
        raise ValueError(f"unknown weighting: {weighting}")
    return pairs.withColumn("weight", F.when(roi <= 0, 0.0).otherwise(weight))


def geometry_pairs(gate_positions: DataFrame, geometries: DataFrame, lattice: Lattice, salt: int = 1) -> DataFrame:
    """The sparse map of every geometry: (geometry, voxel, gate, weight)."""
    pairs = neighbours(gate_positions, geometries, lattice, salt)
    if lattice.max_neighbors == 1:
        # One neighbour carries all the weight, whatever the weighting.
        chosen = nearest_gate_of(pairs).withColumn("weight", F.lit(1.0))
        return chosen.select("geometry_id", "voxel_id", "gate_id", "weight")
    if lattice.max_neighbors is not None:
        pairs = knn_gates(pairs, lattice.max_neighbors)
    return neighbour_weights(pairs, lattice.weighting).select("geometry_id", "voxel_id", "gate_id", "weight")

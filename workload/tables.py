"""Radar-shaped tables derived from the supplied commerce tables.

``lineitem`` gives gates, ``events`` gives the arrival log.  Every expression is
closed form and engine independent, so the SQL twins can state the same tables.
Nothing here rounds: engines disagree about halves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from echolattice.config import Lattice
from echolattice.functions import geomath
from echolattice.operators.neighbours import PER_GEOMETRY
from echolattice.session import spread

# --- fixed values: the scan and lattice of the derived volumes ------------
RAYS, GATES, GATE_SIZE, FIRST_GATE = 36, 40, 6000, 3000
SUPPLIERS_PER_VOLUME = 25
RADARS = 4
EXPECTED = ["DBZH", "DBZV", "ZDR", "RHOHV", "KDP"]
AS_OF = "2024-01-31 00:00:00"
SITE_ALTITUDE = 480.0

LATTICE = Lattice(
    nz=6, ny=41, nx=41,
    z_limits=(0.0, 15000.0), y_limits=(-240000.0, 240000.0), x_limits=(-240000.0, 240000.0),
    h_factor=1.02, nb=8.0, bsp=1.2, min_radius=6000.0, toa=15000.0, blind_range_m=3000.0,
    lowest_elevation=0.5, max_neighbors=1, weighting="nearest",
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _epoch(column: str) -> Column:
    """Whole epoch seconds of an NTZ timestamp read as UTC."""
    return F.unix_timestamp(F.col(column).cast("timestamp"))


def gates(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> DataFrame:
    """One row per observed gate, one nullable column per field.

    With ``buckets`` the measurements are dealt by (geometry, gate) before they become gates, which then lie where the gate store wants them.
    """
    line = read(spark, sf_dir, "lineitem")
    volume, sweep = F.expr(f"l_suppkey div {SUPPLIERS_PER_VOLUME}"), (F.col("l_linenumber") - 1).cast("int")
    ray, gate = (F.col("l_orderkey") % RAYS).cast("int"), (F.col("l_partkey") % GATES).cast("int")
    placed = []
    if buckets is not None:
        measured = ("l_extendedprice", "l_discount", "l_quantity", "l_tax")
        line = line.select(volume.alias("volume_id"), sweep.alias("sweep"), ray.alias("ray"), gate.alias("gate"), *measured)
        volume, sweep, ray, gate = (F.col(c) for c in ("volume_id", "sweep", "ray", "gate"))
        line = line.withColumns({"geometry_id": geometry_of(volume), "gate_id": gate_id_of(sweep, ray, gate)}).repartition(buckets, "geometry_id", "gate_id")
        placed = ["geometry_id", "gate_id"]
    observed = line.groupBy(
        *placed, volume.alias("volume_id"), sweep.alias("sweep"), ray.alias("ray"), gate.alias("gate"),
    ).agg(
        F.max(F.col("l_extendedprice") / 1500 - 10).alias("DBZH"),
        F.max(1 - 4 * F.col("l_discount")).alias("RHOHV"),
        F.min(F.col("l_quantity") / 5 - 1).alias("ZDR"),
        F.min(F.col("l_tax") * 100).alias("WRAD"),
        F.max(F.col("l_quantity") - 25).alias("VRAD"),
        F.max(F.col("l_quantity") * 7).alias("PHIDP"),
        F.min(F.col("l_quantity") / 10 - 1).alias("KDP"),
        F.max(F.when(F.col("l_discount") > 0.085, 1.0).otherwise(0.0)).alias("CM"),
    )
    return observed.select(
        "volume_id",
        radar_of(F.col("volume_id")).alias("radar"),
        "geometry_id" if placed else geometry_of(F.col("volume_id")).alias("geometry_id"),
        "sweep", "ray", "gate",
        "gate_id" if placed else gate_id_of(F.col("sweep"), F.col("ray"), F.col("gate")).alias("gate_id"),
        "DBZH",
        (F.col("DBZH") - F.col("ZDR")).alias("DBZV"),
        "ZDR", "RHOHV", "PHIDP", "KDP", "VRAD", "WRAD", "CM",
        elevation_of(F.col("sweep")).alias("elevation"),
        (F.col("ray") * 10.0).alias("azimuth"),
        (F.col("gate") * float(GATE_SIZE) + FIRST_GATE).alias("range_m"),
    )


def radar_of(volume: Column) -> Column:
    return F.concat(F.lit("RAD"), (volume % RADARS + 1).cast("string"))


def geometry_of(volume: Column) -> Column:
    return volume % RADARS


def gate_id_of(sweep: Column, ray: Column, gate: Column) -> Column:
    return ((sweep * RAYS + ray) * GATES + gate).cast("bigint")


def elevation_of(sweep: Column) -> Column:
    return sweep * 1.5 + 0.5


def with_xyz(df: DataFrame) -> DataFrame:
    x, y, z = geomath.gate_xyz(F.col("range_m"), F.col("azimuth"), F.col("elevation"))
    return df.withColumns({"x": x, "y": y, "z": z})


def sweeps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan description of every volume, one row per sweep."""
    line = read(spark, sf_dir, "lineitem")
    seen = line.select(
        F.expr(f"l_suppkey div {SUPPLIERS_PER_VOLUME}").alias("volume_id"),
        (F.col("l_linenumber") - 1).cast("int").alias("sweep"),
    ).distinct()
    return seen.select(
        "volume_id",
        geometry_of(F.col("volume_id")).alias("geometry_id"),
        "sweep",
        elevation_of(F.col("sweep")).alias("elevation"),
        F.lit(RAYS).alias("nrays"),
        F.lit(GATES).alias("ngates"),
        F.lit(GATE_SIZE).alias("gate_size"),
        F.lit(FIRST_GATE).alias("gate_offset"),
    )


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sweeps of every geometry (one scan per radar, shared by its volumes)."""
    return sweeps(spark, sf_dir).drop("volume_id").distinct()


def volume_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`scans` with one geometry per volume, for the map operators."""
    return sweeps(spark, sf_dir).withColumn("geometry_id", F.col("volume_id")).drop("volume_id")


def scan_gates(scan: DataFrame) -> DataFrame:
    """Every gate position of a scan, whether or not a volume has a value there.

    Rays are spread over the cluster before gates are unrolled, so that one long
    sweep is not one task.  Parameters of a geometry ride along with its gates.
    """
    own = [c for c in PER_GEOMETRY if c in scan.columns]
    rays = scan.withColumn("ray", F.explode(F.sequence(F.lit(0), F.col("nrays") - 1)))
    rays = spread(rays, "geometry_id", "sweep", "ray")
    cells = rays.withColumn("gate", F.explode(F.sequence(F.lit(0), F.col("ngates") - 1))).select(
        "geometry_id",
        ((F.col("sweep") * F.col("nrays") + F.col("ray")) * F.col("ngates") + F.col("gate"))
        .cast("bigint")
        .alias("gate_id"),
        (F.col("gate") * F.col("gate_size").cast("double") + F.col("gate_offset")).alias("range_m"),
        (F.col("ray") * (F.lit(360.0) / F.col("nrays"))).alias("azimuth"),
        "elevation",
        *own,
    )
    return with_xyz(cells).select("geometry_id", "gate_id", "x", "y", "z", *own)


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The append-only log of field files as they arrived."""
    return arrivals_from(read(spark, sf_dir, "events"))


def arrivals_from(events: DataFrame) -> DataFrame:
    """Arrival log of an events frame, batch or streaming."""
    slot = F.floor((_epoch("ts") - F.floor(F.col("value")) * 60) / 21600)
    base = events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("created_ts"),
        F.concat(F.lit("RAD"), (F.col("user_id") % 4 + 1).cast("string")).alias("radar"),
        F.lit("0315").alias("strategy"),
        F.concat(F.lit("0"), (F.expr("user_id div 4") % 2 + 1).cast("string")).alias("vol_nr"),
        F.when(F.col("event_type") == "click", "DBZH")
        .when(F.col("event_type") == "view", "DBZV")
        .when(F.col("event_type") == "purchase", "ZDR")
        .when(F.col("event_type") == "signup", "RHOHV")
        .otherwise("KDP")
        .alias("field"),
        slot.cast("bigint").alias("slot"),
        F.when(F.col("value") < 20, "failed").otherwise("completed").alias("status"),
        F.expr("user_id % 3").cast("int").alias("retry_count"),
    ).filter(~((F.col("field") == "KDP") & (F.col("slot") % 5 == 0)))
    dated = base.withColumn("obs_ts", F.timestamp_seconds(F.col("slot") * 21600))
    return dated.withColumn(
        "filename",
        F.concat(
            F.concat_ws("_", "radar", "strategy", "vol_nr", "field", F.date_format("obs_ts", "yyyyMMdd'T'HHmmss'Z'")),
            F.lit(".BUFR"),
        ),
    ).withColumn(
        "cleanup_status",
        F.when(F.col("event_id") % 11 == 0, "cleaned")
        .when(F.col("event_id") % 13 == 0, "cleanup_failed")
        .when(F.col("event_id") % 2 == 0, "active"),
    )


def volumes_of(files: DataFrame) -> DataFrame:
    """Volume ledger: one row per (radar, strategy, vol, slot) in the file ledger."""
    keys = files.select("radar", "strategy", "vol_nr", "slot", "obs_ts").distinct()
    phase = F.col("slot") % 4
    return keys.select(
        F.concat_ws(
            "_", "radar", "strategy", "vol_nr", F.date_format("obs_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
        ).alias("volume_id"),
        "radar", "strategy", "vol_nr", "slot", "obs_ts",
        F.when(phase == 0, "completed").when(phase == 1, "processing").when(phase == 2, "pending")
        .otherwise("failed").alias("status"),
        (F.col("slot") % 3 != 1).alias("is_complete"),
        F.when(F.col("slot") % 6 != 5, F.concat(F.lit("/volumes/"), F.col("radar"))).alias("stored_path"),
        F.when(F.col("slot") % 9 == 0, "cleaned").when(F.col("slot") % 2 == 0, "active").alias("cleanup_status"),
        (F.col("obs_ts") + F.expr("INTERVAL 2 HOURS")).alias("updated_ts"),
    )


def products_of(volumes: DataFrame) -> DataFrame:
    """Product ledger: two product types per volume, absent for every seventh slot."""
    kinds = volumes.filter(F.col("slot") % 7 != 0).withColumn(
        "product_type", F.explode(F.array(F.lit("image"), F.lit("raw_cog")))
    )
    phase = (F.col("slot") + F.when(F.col("product_type") == "image", 0).otherwise(F.col("slot") % 2)) % 3
    return kinds.select(
        "volume_id", "product_type",
        F.when(phase == 0, "completed").when(phase == 1, "pending").otherwise("failed").alias("status"),
        F.when(phase == 2, "GriddingError").alias("error_type"),
        F.when(phase == 0, F.col("updated_ts")).alias("generated_ts"),
        F.col("updated_ts"),
    )


def raw_sweeps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sweep headers as received: gate counts from the data, some volumes inconsistent."""
    seen = gates(spark, sf_dir).groupBy("volume_id", "sweep").agg(
        (F.max("gate") + 1).alias("ngates"), F.count(F.lit(1)).alias("n")
    )
    v, s = F.col("volume_id"), F.col("sweep")
    return seen.select(
        "volume_id", "sweep", elevation_of(s).alias("elevation"),
        (F.lit(RAYS) + F.when((v % 5 == 3) & (s == 2), 1).otherwise(0)).alias("nrays"),
        "ngates",
        (F.lit(GATE_SIZE) - F.when((v % 7 == 6) & (s == 1), 1000).otherwise(0)).alias("gate_size"),
        (F.lit(FIRST_GATE) + (F.col("n") % 3).cast("int") * 100 + F.when((v % 4 == 2) & (s == 4), 2000).otherwise(0))
        .alias("gate_offset"),
    )


LONG_FIELDS = ("DBZH", "DBZV", "ZDR", "RHOHV")


def long_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form of four fields: (volume, field, sweep, ray, gate, value)."""
    wide = gates(spark, sf_dir).select("volume_id", "sweep", "ray", "gate", *LONG_FIELDS)
    return wide.unpivot(["volume_id", "sweep", "ray", "gate"], list(LONG_FIELDS), "field", "value")


def field_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate layout of each field of each volume; some do not fit the others."""
    v = F.col("volume_id")
    seen = sweeps(spark, sf_dir).select("volume_id").distinct()
    listed = seen.select("volume_id", F.posexplode(F.array(*[F.lit(f) for f in LONG_FIELDS])).alias("position", "field"))
    field = F.col("field")
    return listed.select(
        "volume_id", "position", "field",
        F.when(field == "DBZV", 9000).otherwise(FIRST_GATE).alias("gate_offset"),
        F.when((field == "ZDR") & (v % 3 == 2), 5000).otherwise(GATE_SIZE).alias("gate_size"),
        F.when((field == "DBZV") & (v % 2 == 0), GATES - 1).otherwise(GATES).alias("ngates"),
    )


def field_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(volume, field) rows with a field list that differs by volume."""
    v = F.col("volume_id")
    fields = (
        F.when(v % 3 == 0, F.array(*[F.lit(f) for f in ("DBZH", "DBZV", "TH", "RHOHV", "KDP")]))
        .when(v % 3 == 1, F.array(*[F.lit(f) for f in ("TH", "TV", "TDR", "PHIDP")]))
        .otherwise(F.array(*[F.lit(f) for f in ("DBZH", "ZDR", "VRAD", "WRAD", "CM")]))
    )
    seen = sweeps(spark, sf_dir).select("volume_id").distinct()
    return seen.select("volume_id", F.explode(fields).alias("field"))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site of the radar of every volume."""
    g = geometry_of(F.col("volume_id"))
    seen = sweeps(spark, sf_dir).select("volume_id").distinct()
    return seen.select(
        "volume_id", (g * 0.7 - 64.2).alias("site_lon"), (g * 0.3 - 31.4).alias("site_lat")
    )

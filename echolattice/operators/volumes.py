"""Assembly of volumes from sweeps and fields, and facts about volumes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echolattice.functions.inline import inline_table
from echolattice.session import spread

# --- fixed values: names and units of fields ------------------------------
# (field, language, long name, short name, units)
FIELD_DICTIONARY = (
    ("TH", "es", "Factor de Reflectividad Horizontal", "Th", "[dBZ]"),
    ("TV", "es", "Factor de Reflectividad Vertical", "Tv", "[dBZ]"),
    ("RHOHV", "es", "Coeficiente de Correlacion Co-Polar", "RHOhv", " "),
    ("TDR", "es", "Reflectividad Diferencial (o SNR nva vers INVAP)", "Tdr o SNR", "[dBZ]"),
    ("PHIDP", "es", "Fase Diferencial", "PHIdp", "[grados]"),
    ("KDP", "es", "Fase Diferencial Especifica", "Kdp", "[grados/km]"),
    ("CM", "es", "Mapa de Clutter", "CM", " "),
    ("WRAD", "es", "Ancho Espectral", "Wrad", "[Hz]"),
    ("VRAD", "es", "Velocidad Doppler Radial", "Vrad", "[m/s]"),
    ("DBZH", "es", "Factor de Reflectividad Horizontal Filtrado", "Zh", "[dBZ]"),
    ("DBZV", "es", "Factor de Reflectividad Vertical Filtrado", "Zv", "[dBZ]"),
    ("ZDR", "es", "Reflectividad Diferencial Filtrada", "Zdr", "[dBZ]"),
    ("VRADV", "es", "SQI (nva vers INVAP)", "SQI", ""),
    ("TH", "en", "Horizontal Reflectivity Factor", "Th", "[dBZ]"),
    ("TV", "en", "Vertical Reflectivity Factor", "Tv", "[dBZ]"),
    ("RHOHV", "en", "Co-Polar Correlation Coeficient", "RHOhv", " "),
    ("TDR", "en", "Differential Reflectivity (or SNR nva vers INVAP)", "Tdr or SNR", "[dBZ]"),
    ("PHIDP", "en", "Differential Phase", "PHIdp", "[degrees]"),
    ("KDP", "en", "Specific Differential Phase", "Kdp", "[degrees/km]"),
    ("CM", "en", "Clutter Map", "CM", " "),
    ("WRAD", "en", "Spectral Width", "Wrad", "[Hz]"),
    ("VRAD", "en", "Radial Doppler Velocity", "Vrad", "[m/s]"),
    ("DBZH", "en", "Horizontal Reflectivity Factor Filtered", "Zh", "[dBZ]"),
    ("DBZV", "en", "Vertical Reflectivity Factor Filtered", "Zv", "[dBZ]"),
    ("ZDR", "en", "Differential Reflectivity Filtered", "Zdr", "[dBZ]"),
    ("VRADV", "en", "SQI (nva vers INVAP)", "SQI", ""),
)
PRODUCT_UNITS = {"DBZH": "dBZ", "DBZV": "dBZ", "ZDR": "dB", "KDP": "deg/km", "VRAD": "m/s"}


def validate_sweeps(sweeps: DataFrame) -> DataFrame:
    """Whether a volume's sweeps agree, and the first reason if they do not.

    One ray count, one gate size, and every offset within half of the first
    sweep's offset.  Plain minima and maxima, so one shuffle without distincts.
    """
    first = F.min_by("gate_offset", "sweep")
    facts = sweeps.groupBy("volume_id").agg(
        F.min("nrays").alias("ray_low"), F.max("nrays").alias("ray_high"),
        F.min("gate_size").alias("size_low"), F.max("gate_size").alias("size_high"),
        F.greatest(F.max("gate_offset") - first, first - F.min("gate_offset")).alias("drift"),
        first.alias("first_offset"),
    )
    reason = (
        F.when(F.col("ray_low") != F.col("ray_high"), "ray count differs")
        .when(F.col("size_low") != F.col("size_high"), "gate size differs")
        .when(F.col("drift") > F.floor(F.col("first_offset") / 2), "gate offset drifts")
    )
    return facts.select("volume_id", "drift", reason.isNull().alias("valid"), reason.alias("reason"))


def uniform_gates(sweeps: DataFrame, gates: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Every cell of a volume padded to its largest gate count; absent cells are NULL."""
    widest = sweeps.groupBy("volume_id").agg(F.max("ngates").alias("width"))
    rays = sweeps.select("volume_id", "sweep", "nrays").join(widest, "volume_id")
    rays = spread(rays.withColumn("ray", F.explode(F.sequence(F.lit(0), F.col("nrays") - 1))), "volume_id", "sweep", "ray")
    cells = rays.withColumn("gate", F.explode(F.sequence(F.lit(0), F.col("width") - 1)))
    values = gates.select("volume_id", "sweep", "ray", "gate", *fields)
    frame = cells.select("volume_id", "sweep", "ray", "gate")
    return frame.join(values, ["volume_id", "sweep", "ray", "gate"], "left")


def ray_starts(sweeps: DataFrame) -> DataFrame:
    """Index of each sweep's first ray within the volume (a volume has few sweeps)."""
    before = Window.partitionBy("volume_id").orderBy("sweep").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("nrays").over(before), F.lit(0)).cast("int")
    return sweeps.select("volume_id", "sweep", "nrays", start.alias("first_ray"))


def assemble_volume(sweeps: DataFrame, gates: DataFrame) -> DataFrame:
    """Gates with their ray index within the stacked volume."""
    starts = ray_starts(sweeps).drop("nrays")
    return gates.join(starts, ["volume_id", "sweep"]).withColumn("volume_ray", F.col("first_ray") + F.col("ray"))


def reference_field(field_scans: DataFrame) -> DataFrame:
    """The field of each volume that reaches farthest; the first listed wins ties."""
    reach = F.col("gate_offset") + F.col("gate_size") * F.col("ngates")
    chosen = F.struct("field", "gate_offset", "gate_size", "ngates")
    best = field_scans.groupBy("volume_id").agg(F.max_by(chosen, F.struct(reach, -F.col("position"))).alias("r"))
    return best.select(
        "volume_id", F.col("r.field").alias("ref_field"), F.col("r.gate_offset").alias("ref_offset"),
        F.col("r.gate_size").alias("ref_size"), F.col("r.ngates").alias("ref_ngates"),
    )


def field_alignment(field_scans: DataFrame) -> DataFrame:
    """Gate shift of every field against its volume's reference, or why there is none."""
    joined = field_scans.join(reference_field(field_scans), "volume_id")
    shift = F.floor((F.col("gate_offset") - F.col("ref_offset")) / F.col("ref_size")).cast("int")
    reason = F.when(F.col("gate_size") != F.col("ref_size"), "gate size differs").when(
        (shift < 0) | (shift + F.col("ngates") > F.col("ref_ngates")), "out of the reference range"
    )
    return joined.select("volume_id", "field", "ref_field", shift.alias("shift"), reason.alias("reason"))


def align_fields(field_scans: DataFrame, values: DataFrame) -> DataFrame:
    """Long field values on the reference gates; rejected fields are left out."""
    good = field_alignment(field_scans).filter(F.col("reason").isNull()).select("volume_id", "field", "shift")
    return values.join(good, ["volume_id", "field"]).withColumn("gate", F.col("gate") + F.col("shift")).drop("shift")


def pivot_fields(values: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Long field values to one wide row per gate; the field list is given, not searched."""
    wide = [F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]
    return values.groupBy("volume_id", "sweep", "ray", "gate").agg(*wide)


def ray_geometry(gates: DataFrame, sweeps: DataFrame) -> DataFrame:
    """Range from offset and size, azimuth from the ray index, elevation from the sweep."""
    scan = sweeps.select("volume_id", "sweep", "elevation", "gate_size", "gate_offset")
    joined = gates.select("volume_id", "sweep", "ray", "gate", "gate_id").join(scan, ["volume_id", "sweep"])
    return joined.select(
        "volume_id", "gate_id", "elevation",
        (F.col("gate_offset") + F.col("gate_size") * F.col("gate")).cast("double").alias("range_m"),
        F.col("ray").cast("double").alias("azimuth"),
    )


def derive_zdr(gates: DataFrame, horizontal: str = "DBZH", vertical: str = "DBZV", output: str = "ZDR") -> DataFrame:
    """Difference of the reflectivities where a volume has no such field at all.

    Presence is one aggregated row per volume, joined back: a window would hold a
    whole volume in one task.
    """
    if output not in gates.columns:
        return gates.withColumn(output, F.col(horizontal) - F.col(vertical))
    present = gates.groupBy("volume_id").agg((F.count(output) > 0).alias("__present"))
    derived = F.when(F.col("__present"), F.col(output)).otherwise(F.col(horizontal) - F.col(vertical))
    return gates.join(present, "volume_id").withColumn(output, derived).drop("__present")


RENAMES = {"DBZH": "TH", "DBZV": "TV", "ZDR": "TDR"}


def rename_fields(gates: DataFrame) -> DataFrame:
    """Filtered field names to raw ones, replacing raw fields that are there."""
    present = {old: new for old, new in RENAMES.items() if old in gates.columns}
    return gates.drop(*present.values()).withColumnsRenamed(present)


def describe_fields(fields: DataFrame, language: str = "es") -> DataFrame:
    """Long name, short name and units of (volume, field) rows."""
    rows = [(f, long, short, unit) for f, lang, long, short, unit in FIELD_DICTIONARY if lang == language]
    listed = inline_table(fields.sparkSession, ("field", "long_name", "short_name", "units"), rows)
    return fields.join(F.broadcast(listed), "field")


def reflectivity_fields(present: DataFrame) -> DataFrame:
    """Which fields serve as filtered and raw reflectivity, from an array ``fields``."""

    def has(name: str) -> Column:
        return F.array_contains("fields", name)

    def pick(filtered: str, raw: str) -> tuple[Column, Column]:
        kept = F.when(~has(filtered) & has(raw), raw).otherwise(filtered)
        unfiltered = F.when(has(raw), raw).otherwise(filtered)
        return kept, unfiltered

    h, h_raw = pick("DBZH", "TH")
    v, v_raw = pick("DBZV", "TV")
    return present.select(
        "volume_id", h.alias("h_field"), h_raw.alias("h_field_raw"), v.alias("v_field"), v_raw.alias("v_field_raw")
    )


def field_sets(values: DataFrame) -> DataFrame:
    return values.groupBy("volume_id").agg(F.array_sort(F.collect_set("field")).alias("fields"))


def missing_fields(present: DataFrame, expected: Sequence[str]) -> DataFrame:
    wanted = F.array(*[F.lit(f) for f in expected])
    return present.select(
        "volume_id",
        F.array_sort(F.array_except(wanted, "fields")).alias("missing"),
        F.array_sort(F.array_intersect(wanted, "fields")).alias("available"),
    )


def volume_info(sweeps: DataFrame) -> DataFrame:
    """Size and reach of every volume."""
    last = F.col("gate_offset") + F.col("gate_size") * (F.col("ngates") - 1)
    return sweeps.groupBy("volume_id").agg(
        F.count(F.lit(1)).alias("nsweeps"),
        F.sum("nrays").alias("nrays"),
        F.max("ngates").alias("ngates"),
        (F.sum("nrays") * F.max("ngates")).alias("total_gates"),
        F.min("gate_offset").cast("double").alias("range_min_m"),
        F.max(last).cast("double").alias("range_max_m"),
    )


def blind_and_max_range(
    sweeps: DataFrame, margin_m: float = 0.0, default_blind_m: float = 0.0, default_max_m: float = 240e3,
    round_to_km: float = 20.0,
) -> DataFrame:
    """First gate plus a margin, and the last range rounded up."""
    first = F.min_by(F.col("gate_offset").cast("double"), F.col("sweep"))
    last = F.max(F.col("gate_offset") + F.col("gate_size") * (F.col("ngates") - 1)).cast("double")
    reach = F.coalesce(last, F.lit(float(default_max_m)))
    if round_to_km > 0:
        step = round_to_km * 1000.0
        reach = F.ceil(reach / step).cast("double") * step
    return sweeps.groupBy("volume_id").agg(
        F.greatest(F.lit(0.0), F.coalesce(first, F.lit(float(default_blind_m))) + margin_m).alias("blind_range_m"),
        reach.alias("max_range_m"),
    )


def lowest_sweep(sweeps: DataFrame) -> DataFrame:
    """Sweep of least elevation; the first wins ties.

    First by elevation, in a hash aggregate: the least of a struct needs a sort, of a few rows then.
    """
    first = sweeps.groupBy("volume_id", "elevation").agg(F.min("sweep").alias("sweep"))
    least = F.min(F.struct("elevation", "sweep")).alias("least")
    return first.groupBy("volume_id").agg(least).select(
        "volume_id", F.col("least.sweep").alias("sweep"), F.col("least.elevation").alias("elevation")
    )


def first_sweep_below(sweeps: DataFrame, limit: float = 0.6) -> DataFrame:
    """First sweep whose elevation is below the limit; volumes without one are absent."""
    return sweeps.filter(F.col("elevation") < limit).groupBy("volume_id").agg(F.min("sweep").alias("sweep"))


def extract_sweep(gates: DataFrame, chosen: DataFrame) -> DataFrame:
    return gates.join(chosen.select("volume_id", "sweep"), ["volume_id", "sweep"], "left_semi")


def ordered_sweeps(sweeps: DataFrame, above: float = -5.0, needed: int = 1) -> DataFrame:
    """Sweeps at or above an elevation in order; the first is the reference.

    Volumes with fewer than ``needed`` such sweeps carry a reason instead.
    """
    whole = Window.partitionBy("volume_id")
    order = whole.orderBy("elevation", "sweep")
    used = sweeps.filter(F.col("elevation") >= above).select("volume_id", "sweep", "elevation")
    ranked = used.withColumns({"position": F.row_number().over(order), "available": F.count(F.lit(1)).over(whole)})
    return ranked.select(
        "volume_id", "sweep", "elevation", "position", (F.col("position") == 1).alias("is_reference"),
        F.when(F.col("available") < needed, "too few sweeps").alias("reason"),
    )

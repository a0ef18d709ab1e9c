"""File, volume and product names as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolattice.config import LOCAL_ZONE, Lattice
from echolattice.functions.inline import inline_table

# --- fixed values: name patterns and stamp formats ------------------------
RAW_NAME = r"(?i)^([A-Z0-9]+)_(\d{4})_(\d{2})_([A-Z]{2,10})_(\d{8}T\d{6}Z)\.BUFR$"
VOLUME_NAME = r"(?i)^([A-Z0-9]+)_(\d{4})_(\d{2})_(\d{8}T\d{6}Z)\.nc$"
PRODUCT_NAME = r"(?i)^([A-Z0-9]+)_(\d{8}T\d{6}Z)_([A-Z0-9]+?)(o?)_(\d{2})\.tif$"
STAMP = "yyyyMMdd'T'HHmmss'Z'"


def _groups(name: Column, pattern: str, parts: Mapping[str, int]) -> dict[str, Column]:
    return {part: F.nullif(F.regexp_extract(name, pattern, group), F.lit("")) for part, group in parts.items()}


def parse_raw_name(name: Column) -> dict[str, Column]:
    """Parts of a raw field file's name; all NULL when it does not match."""
    return _groups(name, RAW_NAME, {"radar": 1, "strategy": 2, "vol_nr": 3, "field": 4, "stamp": 5})


def parse_volume_name(name: Column) -> dict[str, Column]:
    return _groups(name, VOLUME_NAME, {"radar": 1, "strategy": 2, "vol_nr": 3, "stamp": 4})


def parse_product_name(name: Column) -> dict[str, Column]:
    """Parts of a product's name; a trailing ``o`` of the field marks unfiltered."""
    parts = _groups(name, PRODUCT_NAME, {"radar": 1, "stamp": 2, "field": 3, "sweep": 5})
    mark = F.regexp_extract(name, PRODUCT_NAME, 4)
    parts["filtered"] = F.when(name.rlike(PRODUCT_NAME), mark == "")
    return parts


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(name: Column) -> Column:
    """The name up to its first dot."""
    return F.split(name, r"\.")[0]


def parse_raw_name_loose(path: Column) -> dict[str, Column]:
    """Exactly five parts between underscores; otherwise ``reject`` says why."""
    name = base_name(path)
    parts = F.split(stem(name), "_")
    good = F.size(parts) == 5
    out = {p: F.when(good, F.get(parts, F.lit(i))) for i, p in enumerate(("radar", "strategy", "vol_nr", "field"))}
    out["filename"] = F.when(good, name)
    out["reject"] = F.when(~good, F.concat(F.lit("unexpected name: "), path))
    return out


def raw_name_matches(
    parts: Mapping[str, Column], strategy: str | None = None, vol_nr: int | None = None, field: str | None = None
) -> Column:
    """Optional equality on strategy, zero-padded volume number and field."""
    rule = F.lit(True)
    if strategy is not None:
        rule = rule & (parts["strategy"] == strategy)
    if vol_nr is not None:
        rule = rule & (parts["vol_nr"] == F.lpad(F.lit(str(vol_nr)), 2, "0"))
    if field is not None:
        rule = rule & (parts["field"] == field)
    return rule


def volume_name_from_raw(name: Column) -> Column:
    parts = F.split(stem(name), "_")
    return F.concat(F.concat_ws("_", parts[0], parts[1], parts[2], parts[4]), F.lit(".nc"))


def volume_path(name: Column, root: str) -> Column:
    """``root/RADAR/yyyy/mm/dd/hh`` of a volume file."""
    parts = F.split(stem(name), "_")
    stamp = parts[3]
    return F.concat_ws(
        "/", F.lit(root), parts[0], stamp.substr(1, 4), stamp.substr(5, 2), stamp.substr(7, 2), stamp.substr(10, 2)
    )


def stamp_to_time(stamp: Column) -> Column:
    return F.try_to_timestamp(stamp, F.lit("yyyyMMdd'T'HHmmssX"))


def time_from_name(name: Column, utc: bool = True, zone: str = LOCAL_ZONE) -> Column:
    """The instant in part 3 of a volume's name, or the same as a local clock reading."""
    instant = stamp_to_time(F.split(stem(name), "_")[3])
    return instant if utc else F.from_utc_timestamp(instant, zone)


def build_tree_path(name: Column, base: str = "L2") -> Column:
    """``base/RADAR/yyyy/mm/dd/hh/mmss/name`` of a raw field file."""
    parts = F.split(name, "_")
    stamp = F.element_at(parts, -1)
    pieces = [stamp.substr(1, 4), stamp.substr(5, 2), stamp.substr(7, 2), stamp.substr(10, 2), stamp.substr(12, 4)]
    return F.concat_ws("/", F.lit(base), parts[0], *pieces, name)


def parse_tree_path(path: Column) -> dict[str, Column]:
    parts = F.split(path, "/")
    name = F.element_at(parts, -1)
    stamp = F.concat(*[F.element_at(parts, i) for i in (-6, -5, -4, -3, -2)])
    return {
        "radar": F.element_at(parts, -7),
        "filename": name,
        "obs_ts": F.to_timestamp(stamp, "yyyyMMddHHmmss"),
        "field": F.split(name, "_")[3],
    }


def volume_id(radar: Column, strategy: Column, vol_nr: Column, obs_ts: Column) -> Column:
    return F.concat_ws("_", radar, strategy, vol_nr, F.date_format(obs_ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def ceiled_slot(obs_ts: Column) -> Column:
    """Ten minutes later, cut to ten minutes: a full slot moves to the next one."""
    return F.timestamp_seconds(F.floor((F.unix_timestamp(obs_ts) + 600) / 600) * 600)


def rounded_slot(obs_ts: Column) -> Column:
    """The nearest ten minutes of the instant (hours and days carry), half to even minute tens."""
    minutes = F.floor(F.unix_timestamp(obs_ts) / 60)
    return F.timestamp_seconds((F.rint(minutes / 10) * 600).cast("bigint"))


def product_slot(
    radar: Column, field: Column, sweep: Column, obs_ts: Column, filtered: Column, extension: str
) -> dict[str, Column]:
    """Folder and the two names (ceiled and rounded time) of a product."""
    shown = F.concat(field, F.when(filtered, "").otherwise("o"))
    number = F.lpad(sweep.cast("string"), 2, "0")

    def named(instant: Column) -> Column:
        stamp = F.date_format(instant, "yyyyMMdd'T'HHmm'00Z'")
        return F.concat(F.concat_ws("_", radar, stamp, shown, number), F.lit("." + extension))

    return {
        "folder": F.date_format(rounded_slot(obs_ts), "yyyy/MM/dd"),
        "ceiled_name": named(ceiled_slot(obs_ts)),
        "rounded_name": named(rounded_slot(obs_ts)),
    }


def volume_type_rows(df: DataFrame, catalogue: Mapping[str, Mapping[str, Sequence[str]]]) -> DataFrame:
    """The catalogue as (strategy, vol_nr, field) rows; its size is the caller's literal."""
    rows = [(s, v, f) for s, vols in catalogue.items() for v, fields in vols.items() for f in fields]
    return inline_table(df.sparkSession, ("strategy", "vol_nr", "field"), rows)


def filter_volume_types(
    files: DataFrame, catalogue: Mapping[str, Mapping[str, Sequence[str]]]
) -> DataFrame:
    """Keep files of the catalogue's kinds; an empty catalogue keeps all."""
    if not catalogue:
        return files
    wanted = volume_type_rows(files, catalogue)
    return files.join(F.broadcast(wanted), ["strategy", "vol_nr", "field"], "left_semi")


def geometry_key(p: Mapping[str, Column]) -> Column:
    """Canonical key of all build parameters, points written as ``p``."""

    def number(value: Column, digits: int) -> Column:
        return F.translate(F.format_string(f"%.{digits}f", value.cast("double")), ".", "p")

    def whole(value: Column) -> Column:
        return value.cast("bigint").cast("string")

    return F.concat(
        F.concat_ws("_", p["radar"], p["strategy"], p["vol_nr"]),
        F.lit("_RES"), whole(p["resolution_xy"]), F.lit("x"), whole(p["resolution_z"]),
        F.lit("_TOA"), whole(p["toa"]), F.lit("_HF"), number(p["h_factor"], 4),
        F.lit("_MR"), whole(p["min_radius"]), F.lit("_MN"), p["max_neighbors"].cast("string"),
        F.lit("_NB"), number(p["nb"], 2), F.lit("_BSP"), number(p["bsp"], 2),
        F.lit("_"), p["weighting"], F.lit("_geometry"),
    )


def lattice_parameters(lattice: Lattice) -> dict[str, Column]:
    return {
        "resolution_xy": F.lit(lattice.x_step), "resolution_z": F.lit(lattice.z_step), "toa": F.lit(lattice.toa),
        "h_factor": F.lit(lattice.h_factor), "min_radius": F.lit(lattice.min_radius),
        "max_neighbors": F.lit(lattice.max_neighbors), "nb": F.lit(lattice.nb), "bsp": F.lit(lattice.bsp),
        "weighting": F.lit(lattice.weighting),
    }

"""Gate filters: a chain of exclusions that is one boolean column.

Catalyst fuses the chain into the scan of the gates.  A missing value is not
excluded by a threshold, only by the rules about missing values.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolattice.config import ColmaxThresholds, QualityThresholds, concrete_field
from echolattice.operators.components import component_of_runs


def _known(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def vectorised(rule: Callable[..., pa.Array]) -> Callable[..., Column]:
    """A predicate over Arrow arrays of one or more columns, for rules no expression states; null means not excluded.

    What it returns must be boolean and as long as what it gets, which is checked for every batch.
    """

    @F.arrow_udf("boolean")
    def run(*values: pa.Array) -> pa.Array:
        out = rule(*values)
        if isinstance(out, pa.ChunkedArray):
            out = out.combine_chunks()
        if not isinstance(out, pa.Array) or out.type != pa.bool_() or len(out) != len(values[0]):
            raise TypeError(f"a predicate returned {getattr(out, 'type', type(out))}, not a boolean for each of {len(values[0])} rows")
        return out

    return run


@dataclass(frozen=True)
class GateFilter:
    """Exclusions over the columns of a gate table; any one of them excludes.

    Immutable: each method returns a longer filter.  Fields go by stored or by
    descriptive name; a rule about a field the table does not have is skipped with
    a warning.
    """

    columns: frozenset[str]
    rules: tuple[Column, ...] = ()
    history: tuple[str, ...] = ()

    @classmethod
    def on(cls, gates: DataFrame) -> GateFilter:
        return cls(frozenset(gates.columns))

    def _add(self, note: str, rule: Column, needs: str | None = None) -> GateFilter:
        if needs is not None and needs not in self.columns:
            warnings.warn(f"no field {needs}: {note} skipped", stacklevel=3)
            return self
        return replace(self, rules=(*self.rules, _known(rule)), history=(*self.history, note))

    def below(self, field: str, limit: float) -> GateFilter:
        field = concrete_field(field)
        return self._add(f"{field} < {limit}", F.col(field) < limit, field)

    def above(self, field: str, limit: float) -> GateFilter:
        field = concrete_field(field)
        return self._add(f"{field} > {limit}", F.col(field) > limit, field)

    def between(self, field: str, low: float, high: float) -> GateFilter:
        field = concrete_field(field)
        return self._add(f"{low} < {field} < {high}", (F.col(field) > low) & (F.col(field) < high), field)

    def outside(self, field: str, low: float, high: float) -> GateFilter:
        field = concrete_field(field)
        return self._add(f"{field} outside {low}..{high}", (F.col(field) < low) | (F.col(field) > high), field)

    def equal(self, field: str, value: float, atol: float = 1e-5) -> GateFilter:
        field = concrete_field(field)
        return self._add(f"{field} = {value}", F.abs(F.col(field) - value) < atol, field)

    def missing(self, field: str) -> GateFilter:
        field = concrete_field(field)
        return self._add(f"{field} missing", F.col(field).isNull(), field)

    def all_missing(self, fields: Iterable[str]) -> GateFilter:
        out = self
        for name in fields:
            out = out.missing(name)
        return out

    def altitude(self, site_altitude: float, below: float | None = None, above: float | None = None) -> GateFilter:
        return self._span("altitude", F.col("z") + site_altitude, below, above, "z")

    def range(self, below: float | None = None, above: float | None = None) -> GateFilter:
        return self._span("range", F.col("range_m"), below, above, "range_m")

    def elevation(self, below: float | None = None, above: float | None = None) -> GateFilter:
        return self._span("elevation", F.col("elevation"), below, above, "elevation")

    def _span(self, name: str, value: Column, below: float | None, above: float | None, needs: str) -> GateFilter:
        out = self
        if below is not None:
            out = out._add(f"{name} < {below}", value < below, needs)
        if above is not None:
            out = out._add(f"{name} > {above}", value > above, needs)
        return out

    def where(self, rule: Column, note: str = "custom mask") -> GateFilter:
        return self._add(note, rule)

    def by_function(self, field: str, rule: Callable[[Column], Column], note: str = "function") -> GateFilter:
        """A user rule over one field's column; an unknown field is an error here.

        The rule maps the column to a boolean column: an expression, or the call of a
        pandas UDF where no expression will do.
        """
        field = concrete_field(field)
        if field not in self.columns:
            raise KeyError(field)
        return self._add(f"{note}({field})", rule(F.col(field)))

    def exclude_all(self) -> GateFilter:
        return self._add("all", F.lit(True))

    def reset(self) -> GateFilter:
        return GateFilter(self.columns)

    @property
    def excluded(self) -> Column:
        out = F.lit(False)
        for rule in self.rules:
            out = out | rule
        return out

    def apply(self, gates: DataFrame) -> DataFrame:
        return gates.filter(~self.excluded)

    def mask(self, gates: DataFrame, field: str, output: str | None = None) -> DataFrame:
        """The field, NULL where it is missing or excluded."""
        return gates.withColumn(output or field, F.when(~self.excluded, F.col(field)))

    def summary(self, gates: DataFrame) -> DataFrame:
        """Totals per volume with the history of rules."""
        out = gates.groupBy("volume_id").agg(
            F.count(F.lit(1)).alias("total"),
            F.sum(self.excluded.cast("bigint")).alias("excluded"),
        )
        notes = F.array(*[F.lit(n) for n in self.history]) if self.history else F.array().cast("array<string>")
        return out.select(
            "volume_id",
            "total",
            "excluded",
            (F.col("total") - F.col("excluded")).alias("included"),
            (F.col("excluded") * 100.0 / F.col("total")).alias("percent_excluded"),
            notes.alias("history"),
        )


def percentile_limits(gates: DataFrame, field: str, share: float, name: str = "limit") -> DataFrame:
    """Exact percentile of a field per volume, one row per volume."""
    return gates.groupBy("volume_id").agg(F.percentile(field, share).alias(name))


def exclude_below_percentile(gates: DataFrame, field: str, share: float) -> DataFrame:
    """Gates of each volume not below its own percentile of the field.

    The limits are one row per volume; joining them back lets AQE pick a
    broadcast, and split a hot volume, where a window would hold a whole volume
    in one task.
    """
    limits = percentile_limits(gates, field, share)
    kept = gates.join(limits, "volume_id").filter(~_known(F.col(field) < F.col("limit")))
    return kept.drop("limit")


def mask_by_source(
    gates: DataFrame,
    source: str,
    targets: Iterable[str],
    below: float | None = None,
    above: float | None = None,
    suffix: str | None = None,
    trail: str | None = None,
) -> DataFrame:
    """NULL the target fields where the source field is below or above a limit.

    With ``suffix`` new columns are added, with ``trail`` a note is appended to an
    array column of applied filters.  Without the source field nothing happens.
    """
    if source not in gates.columns:
        return gates
    failing = F.lit(False)
    notes = []
    if below is not None:
        failing = failing | _known(F.col(source) < below)
        notes.append(f"{source}<{below}")
    if above is not None:
        failing = failing | _known(F.col(source) > above)
        notes.append(f"{source}>{above}")
    present = [t for t in targets if t in gates.columns]
    out = gates.withColumns({t + (suffix or ""): F.when(~failing, F.col(t)) for t in present})
    if trail is not None:
        earlier = F.col(trail) if trail in gates.columns else F.array().cast("array<string>")
        out = out.withColumn(trail, F.concat(earlier, F.array(*[F.lit(n) for n in notes])))
    return out


def mask_by_mask(gates: DataFrame, masks: DataFrame, targets: Iterable[str]) -> DataFrame:
    """Mask target fields with a table of (volume_id, gate_id, masked).

    A value that is already missing stays missing.
    """
    joined = gates.join(masks.select("volume_id", "gate_id", "masked"), ["volume_id", "gate_id"], "left")
    failing = _known(F.col("masked"))
    return joined.withColumns({t: F.when(~failing, F.col(t)) for t in targets}).drop("masked")


def mask_annulus(
    gates: DataFrame,
    fields: Iterable[str],
    gate_size: float,
    ngates: int,
    inner_km: float | None = None,
    outer_km: float | None = None,
    rays: tuple[int, int] | None = None,
    side: str = "outside",
) -> DataFrame:
    """NULL fields outside or inside a ring sector, on every sweep.

    The limiting gate is the first one at or past a radius (first and last gate
    where no radius is given).  Outside masks up to and with the inner limiting
    gate, from the outer one on, and all rays beyond the sector; inside masks from
    the inner limiting gate up to, not with, the outer one.
    """
    gate, range_m = F.col("gate"), F.col("range_m")
    in_sector = F.lit(True) if rays is None else (F.col("ray") >= rays[0]) & (F.col("ray") < rays[1])
    past_outer = gate >= ngates - 1 if outer_km is None else range_m >= outer_km * 1000.0
    if side == "outside":
        to_inner = gate <= 0 if inner_km is None else range_m - gate_size < inner_km * 1000.0
        failing = ~in_sector | to_inner | past_outer
    elif side == "inside":
        from_inner = F.lit(True) if inner_km is None else range_m >= inner_km * 1000.0
        failing = in_sector & from_inner & ~past_outer
    else:
        raise ValueError(f"unknown side: {side}")
    return gates.withColumns({f: F.when(~failing, F.col(f)) for f in fields})


def colmax_filter(gates: DataFrame, t: ColmaxThresholds = ColmaxThresholds()) -> GateFilter:
    """The chain ahead of the column maximum."""
    return (
        GateFilter.on(gates)
        .elevation(below=t.min_elevation)
        .below("RHOHV", t.rhohv)
        .above("WRAD", t.wrad)
        .above("ZDR", t.zdr)
    )


def field_filter(gates: DataFrame, refl: str = "DBZH", t: QualityThresholds = QualityThresholds()) -> GateFilter:
    """The chain ahead of per-field products, without despeckling."""
    return (
        GateFilter.on(gates).below("RHOHV", t.rhohv).above("WRAD", t.wrad).below(refl, t.refl).above("ZDR", t.zdr)
    )


def quality_rules(columns: Iterable[str], refl: str = "DBZH", t: QualityThresholds = QualityThresholds()) -> Column:
    """Exclusion by the first three steps of the operational chain, in order.

    One: thresholds, where a missing source excludes.  Two: strong reflectivity is
    taken back.  Three: clutter is excluded unless well correlated.  Fields the
    table does not have are skipped.
    """
    have = set(columns)

    def absent_or(name: str, rule: Column) -> Column:
        return F.coalesce(rule, F.lit(True)) if name in have else F.lit(False)

    excluded = (
        absent_or(refl, F.col(refl) < t.refl)
        | absent_or("RHOHV", F.col("RHOHV") < t.rhohv)
        | absent_or("ZDR", F.col("ZDR") > t.zdr)
        | absent_or("WRAD", F.col("WRAD") > t.wrad)
    )
    if refl in have:
        excluded = excluded & ~_known(F.col(refl) > t.keep_refl)
    if "CM" in have:
        clutter = _known(F.col("CM") == 1)
        if "RHOHV" in have:
            clutter = clutter & ~_known(F.col("RHOHV") > t.clutter_rhohv)
        excluded = excluded | clutter
    return excluded


def kept_cells(place: np.ndarray, value: np.ndarray, width: int, wrap_rows: int | None, size: int, mean: float | None) -> np.ndarray:
    """Which cells of an image, given by raster index in any order, lie in an object that is large and good enough."""
    order = np.argsort(place, kind="stable")
    place, value = place[order], value[order]
    fresh = np.ones(len(place), dtype=bool)
    fresh[1:] = (np.diff(place) != 1) | (place[1:] % width == 0)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(place)) - 1
    label = component_of_runs(place[first], place[last], width, wrap_rows)
    _, of_run = np.unique(label, return_inverse=True)
    n = np.bincount(of_run, weights=last - first + 1)
    good = n >= size
    if mean is not None:
        # At single-precision resolution: a sum taken in another order must not flip a tie.
        total = np.bincount(of_run, weights=np.add.reduceat(value, first))
        good &= np.floor(total / n * 1e6 + 0.5) / 1e6 >= mean
    kept = np.empty(len(place), dtype=bool)
    kept[order] = np.repeat(good[of_run], last - first + 1)
    return kept


def despeckle(
    gates: DataFrame, excluded: Column, rows: int, width: int, field: str = "RHOHV", size: int = 10,
    mean_threshold: float | None = None, delta_deg: float = 5.0, threshold: float = -100.0,
) -> DataFrame:
    """Gates of objects that are large enough and good enough on average.

    Objects are four-connected surviving gates of one sweep; the last ray touches
    the first where the gap between rays is at most ``delta_deg``.  Gates are read and exchanged once: a sweep, which the
    lattice bounds, becomes a row of cells, of which only places and one field visit Python and come back as a mask.
    """
    image = ["volume_id", "sweep"]
    alive = gates.filter(~excluded & (F.col(field) > threshold))
    others = [c for c in gates.columns if c not in image]
    wrap_rows = rows if 360.0 / rows <= delta_deg else None

    @F.pandas_udf("array<boolean>")
    def mask(places: pd.Series, values: pd.Series) -> pd.Series:
        return pd.Series([kept_cells(np.asarray(p, dtype=np.int64), np.asarray(v, dtype=np.float64), width, wrap_rows, size, mean_threshold) for p, v in zip(places, values)])

    sweeps = alive.groupBy(*image).agg(F.collect_list(F.struct(*others)).alias("cells"))
    place = F.transform("cells", lambda c: c["ray"].cast("bigint") * width + c["gate"])
    judged = sweeps.withColumn("mask", mask(place, F.transform("cells", lambda c: c[field].cast("double"))))
    left = F.filter(F.zip_with("cells", "mask", lambda c, k: F.when(k, c)), lambda c: c.isNotNull())
    return judged.select(*image, F.explode(left).alias("cell")).select(*[c if c in image else F.col("cell")[c].alias(c) for c in gates.columns])


def quality_filter(
    gates: DataFrame, rows: int, width: int, gate_size: float, refl: str = "DBZH",
    t: QualityThresholds = QualityThresholds(), delta_deg: float = 5.0,
) -> DataFrame:
    """Gates that pass the whole operational chain, despeckling last."""
    excluded = quality_rules(gates.columns, refl, t)
    if "RHOHV" not in gates.columns:
        return gates.filter(~excluded)
    size = int(t.despeckle_metres / gate_size)
    return despeckle(gates, excluded, rows, width, "RHOHV", size, t.mean_rhohv, delta_deg)

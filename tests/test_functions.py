from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from echolattice.functions import geomath, names
from echolattice.functions.colours import KNOTS, LISTED, Scale
from echolattice.functions.inline import inline_table
from echolattice.functions.missing import mask_invalid
from echolattice.operators import filters, rasters, stations, volumes
from echolattice.operators.filters import GateFilter
from echolattice.sources import payload


def one(spark, *columns):
    return spark.range(1).select(*columns).collect()[0]


def test_raw_names(spark):
    name = F.lit("RAD11_0302_01_TH_20251120T120000Z.BUFR")
    parts = names.parse_raw_name(name)
    row = one(spark, *[c.alias(n) for n, c in parts.items()])
    assert tuple(row) == ("RAD11", "0302", "01", "TH", "20251120T120000Z")
    bad = names.parse_raw_name(F.lit("RAD11_302_01_TH.BUFR"))
    assert tuple(one(spark, *[c.alias(n) for n, c in bad.items()])) == (None,) * 5
    assert one(spark, names.volume_name_from_raw(name))[0] == "RAD11_0302_01_20251120T120000Z.nc"
    assert one(spark, names.build_tree_path(name))[0] == "L2/RAD11/2025/11/20/12/0000/RAD11_0302_01_TH_20251120T120000Z.BUFR"


def test_product_names(spark):
    get = lambda n: one(spark, *[c.alias(k) for k, c in names.parse_product_name(F.lit(n)).items()])
    assert tuple(get("RAD1_20260326T200000Z_VRADo_00.tif")) == ("RAD1", "20260326T200000Z", "VRAD", "00", False)
    assert get("RAD1_20260326T200000Z_VRAD_00.tif").filtered is True
    assert get("nothing.tif").filtered is None


@pytest.mark.parametrize(
    "clock,ceiled,rounded",
    [
        ("2024-01-01 12:00:00", "12:10", "12:00"),
        ("2024-01-01 12:03:20", "12:10", "12:00"),
        ("2024-01-01 12:05:00", "12:10", "12:00"),
        ("2024-01-01 12:15:00", "12:20", "12:20"),
        ("2024-01-01 12:57:00", "13:00", "13:00"),
        ("2024-01-01 23:58:00", "00:00", "00:00"),
    ],
)
def test_slots(spark, clock, ceiled, rounded):
    instant = F.lit(clock).cast("timestamp")
    row = one(
        spark, F.date_format(names.ceiled_slot(instant), "HH:mm"), F.date_format(names.rounded_slot(instant), "HH:mm")
    )
    assert tuple(row) == (ceiled, rounded)


def test_local_time(spark):
    name = F.lit("RAD1_0315_01_20240101T013000Z.nc")
    assert one(spark, names.time_from_name(name, utc=False).cast("string"))[0] == "2023-12-31 22:30:00"


def test_beam_heights(spark):
    heights = [one(spark, geomath.beam_height(d, 2.0, 100.0))[0] for d in (10e3, 20e3, 50e3)]
    assert heights == sorted(heights) and heights[0] > 100 + 10e3 * math.tan(math.radians(2)) - 1
    assert one(spark, geomath.beam_height(10e3, 45.0))[0] > 7000
    assert one(spark, geomath.beam_height_flat(10e3, 2.0))[0] == pytest.approx(10e3 * math.tan(math.radians(2)))
    assert one(spark, geomath.beam_height_diff(50e3, 0.5))[0] > 0


def test_elevation_inverts_beam_height(spark):
    df = inline_table(spark, ("d",), [(20e3,), (80e3,), (150e3,)])
    angles = geomath.with_elevation_at_height(df, F.col("d"), 6000.0, "angle")
    back = angles.select(geomath.beam_height(F.col("d"), F.col("angle"))).collect()
    assert all(b[0] == pytest.approx(6000.0, abs=2.0) for b in back)


def test_distances(spark):
    there = one(spark, geomath.haversine_km(-64.2, -31.4, -63.5, -32.1))[0]
    assert there == pytest.approx(one(spark, geomath.haversine_km(-63.5, -32.1, -64.2, -31.4))[0])
    assert one(spark, geomath.haversine_km(-64.0, -31.0, -64.0, -32.0))[0] == pytest.approx(111.1, abs=0.2)
    lon, lat = F.lit(-64.0), F.lit(-31.0)
    for target, expected in (((-64.0, -30.0), 0), ((-63.0, -31.0), 90), ((-65.0, -31.0), 270)):
        angle, _ = geomath.bearing_range(lon, lat, F.lit(target[0]), F.lit(target[1]))
        assert one(spark, angle)[0] % 360 == pytest.approx(expected, abs=0.5)


def test_bearing_of_a_station_on_the_site(spark):
    """No side of the triangle is left to divide by; customer 321684 of larger tables stands on a radar."""
    df = inline_table(spark, ("lon", "lat"), [(-62.8, -30.8), (-62.8, -30.0)])
    angle, distance = geomath.bearing_range(F.lit(2 * 0.7 - 64.2), F.lit(2 * 0.3 - 31.4), F.col("lon"), F.col("lat"))
    here, north = df.select(angle.alias("angle"), distance.alias("distance"), "lat").orderBy("lat").collect()
    assert (here.angle, here.distance) == (0.0, pytest.approx(0.0, abs=1e-6))
    assert north.angle % 360 == pytest.approx(0.0, abs=1e-3)


def test_nearest_gate_of_a_station_on_the_site(spark):
    placed = inline_table(spark, ("station_id", "lon", "lat"), [(321684, -62.8, -30.8)])
    radar = inline_table(spark, ("site_lon", "site_lat", "nrays", "ngates", "gate_size", "gate_offset"), [(2 * 0.7 - 64.2, 2 * 0.3 - 31.4, 36, 40, 6000, 3000)])
    near = stations.stations_in_reach(placed, radar).select("ray", "gate").collect()
    assert [tuple(r) for r in near] == [(0, None)], "north, and before the first gate"


def test_map_position_round_trip(spark):
    lon, lat = geomath.xy_to_lonlat(30e3, 40e3, -64.0, -31.0)
    row = one(spark, lon.alias("lon"), lat.alias("lat"))
    back = one(spark, geomath.haversine_km(-64.0, -31.0, row.lon, row.lat))[0]
    assert back == pytest.approx(50.0, rel=1e-3)
    here = one(spark, *geomath.xy_to_lonlat(0.0, 0.0, -64.0, -31.0))
    assert tuple(here) == (-64.0, -31.0)


def test_gate_filters_or_and_missing(spark):
    gates = inline_table(spark, ("volume_id", "gate_id", "DBZH", "RHOHV"),
                         [(1, 0, 5.0, 0.9), (1, 1, 30.0, 0.4), (1, 2, 30.0, 0.9), (1, 3, None, 0.9)])
    kept = lambda f: {r.gate_id for r in f.apply(gates).collect()}
    base = GateFilter.on(gates)
    assert kept(base.below("DBZH", 10.0)) == {1, 2, 3}, "a threshold does not exclude a missing value"
    assert kept(base.below("DBZH", 10.0).below("RHOHV", 0.5)) == {2, 3}
    assert kept(base.missing("DBZH")) == {0, 1, 2}
    assert kept(base.between("DBZH", 5.0, 31.0)) == {0, 3}
    assert kept(base.outside("DBZH", 10.0, 40.0)) == {1, 2, 3}
    assert kept(base.equal("RHOHV", 0.9)) == {1}
    assert kept(base.exclude_all()) == set() and kept(base.exclude_all().reset()) == {0, 1, 2, 3}
    with pytest.warns(UserWarning):
        assert kept(base.below("KDP", 0.0)) == {0, 1, 2, 3}
    with pytest.raises(KeyError):
        base.by_function("KDP", lambda c: c > 0)
    summary = base.below("DBZH", 10.0).summary(gates).collect()[0]
    assert (summary.total, summary.excluded, summary.percent_excluded) == (4, 1, 25.0)


def test_quality_rules_order(spark):
    rows = [
        (0, 10.0, 0.9, 1.0, 1.0, 0.0),  # fine
        (1, -5.0, 0.9, 1.0, 1.0, 0.0),  # weak
        (2, 30.0, 0.1, 1.0, 1.0, 0.0),  # poor but strong: taken back
        (3, 30.0, 0.5, 1.0, 1.0, 1.0),  # strong clutter
        (4, 30.0, 0.9, 1.0, 1.0, 1.0),  # clutter flag, well correlated
        (5, None, 0.9, 1.0, 1.0, 0.0),  # missing
    ]
    gates = inline_table(spark, ("gate_id", "DBZH", "RHOHV", "ZDR", "WRAD", "CM"), rows)
    kept = {r.gate_id for r in gates.filter(~filters.quality_rules(gates.columns)).collect()}
    assert kept == {0, 2, 4}


def test_masks_use_one_missing_value(spark):
    df = inline_table(spark, ("a",), [(1.0,), (2e5,)]).unionByName(
        spark.range(1).select(F.lit(float("nan")).alias("a"))
    ).unionByName(spark.range(1).select(F.lit(float("-inf")).alias("a")))
    assert sorted([r.a for r in mask_invalid(df, ["a"]).collect()], key=str) == [1.0, None, None, None]


def test_payload():
    values = np.arange(12) + 0.5
    good, reject = payload.inflate(zlib.compress(values.tobytes()), 4, 3)
    assert reject is None and good.reshape(4, 3)[0, 0] == 0.5
    assert payload.inflate(zlib.compress(values.tobytes()), 4, 4)[0] is None
    assert "8401" in payload.inflate(b"", 1, 8401)[1]
    assert payload.inflate(b"junk", 1, 1)[0] is None


def test_field_alignment(spark):
    scans = inline_table(
        spark, ("volume_id", "position", "field", "gate_offset", "gate_size", "ngates"),
        [(1, 0, "DBZH", 0, 100, 60), (1, 1, "ZDR", 100, 100, 50), (1, 2, "VRAD", 0, 50, 60), (1, 3, "KDP", -100, 100, 10)],
    )
    rows = {r.field: (r.ref_field, r["shift"], r.reason) for r in volumes.field_alignment(scans).collect()}
    assert rows["DBZH"] == ("DBZH", 0, None)
    assert rows["ZDR"] == ("DBZH", 1, None)
    assert rows["VRAD"][2] == "gate size differs"
    assert rows["KDP"][2] == "out of the reference range"


@pytest.mark.parametrize("name", [*KNOTS, *LISTED, "th_r", "zdr_r"])
def test_scales_cover_every_index(spark, name):
    scale = Scale(name)
    rows = spark.range(scale.size).select(*[scale.byte(F.col("id"), c).alias(c) for c in rasters.CHANNELS]).collect()
    assert all(0 <= r[c] <= 255 for r in rows for c in range(3))
    if name == "zdr":
        assert tuple(rows[1]) == (0x00, 0x55, 0xFF)
    if name == "th":
        assert tuple(rows[0]) == (255, 255, 255)


def test_colours_and_back(spark):
    pixels = inline_table(spark, ("volume_id", "iy", "ix", "value"), [(1, 0, i, float(v)) for i, v in enumerate((-30, 0, 35, 90))])
    pixels = pixels.unionByName(spark.range(1).select(
        F.lit(1).alias("volume_id"), F.lit(0).alias("iy"), F.lit(9).alias("ix"), F.lit(None).cast("double").alias("value")))
    shown = rasters.colorize(pixels, Scale("th"), -20.0, 70.0)
    back = {r.ix: r.value for r in rasters.uncolor(shown.drop("value"), Scale("th"), -20.0, 70.0).collect()}
    assert back[9] is None
    assert back[0] == pytest.approx(-20.0, abs=1.0) and back[2] == pytest.approx(35.0, abs=1.0)
    with pytest.raises(ValueError):
        rasters.recolor(shown.drop("value"), Scale("rho"))
    with pytest.raises(ValueError):
        Scale("unknown")


def test_rules_by_pandas_udf_and_descriptive_names(spark):
    gates = inline_table(spark, ("volume_id", "gate_id", "DBZH"), [(1, i, float(i)) for i in range(5)])

    @F.pandas_udf("boolean")
    def odd(values: pd.Series) -> pd.Series:
        return values % 2 == 1

    kept = GateFilter.on(gates).by_function("reflectivity", odd).below("reflectivity", 1.0).apply(gates)
    assert {r.gate_id for r in kept.collect()} == {2, 4}

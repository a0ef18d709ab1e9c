from __future__ import annotations

import itertools
import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from echolattice.config import Lattice
from echolattice.functions.inline import inline_table
from echolattice.operators import gridding, neighbours
from echolattice.plans import products
from echolattice.sources import gate_store
from workload import grids, tables

SMALL = Lattice(
    nz=3, ny=6, nx=6, z_limits=(0.0, 6000.0), y_limits=(-50000.0, 50000.0), x_limits=(-50000.0, 50000.0),
    h_factor=1.02, nb=6.0, bsp=1.2, min_radius=3000.0, toa=9000.0, blind_range_m=2000.0, max_neighbors=None,
)


def _gates(n=400, seed=3):
    rng = np.random.default_rng(seed)
    return [
        (0, i, float(x), float(y), float(z))
        for i, (x, y, z) in enumerate(
            zip(rng.uniform(-60e3, 60e3, n), rng.uniform(-60e3, 60e3, n), rng.uniform(0, 10e3, n))
        )
    ]


def _brute(gates, lattice):
    found = {}
    tan = math.tan(lattice.nb * lattice.bsp * math.pi / 180)
    for iz, iy, ix in itertools.product(range(lattice.nz), range(lattice.ny), range(lattice.nx)):
        z = lattice.z_limits[0] + iz * lattice.z_step
        y = lattice.y_limits[0] + iy * lattice.y_step
        x = lattice.x_limits[0] + ix * lattice.x_step
        if lattice.blind_range_m > 0 and math.sqrt(x * x + y * y + z * z) <= lattice.blind_range_m:
            continue
        roi = max(lattice.h_factor * z / 20 + math.hypot(x, y) * tan, lattice.min_radius)
        for _, gate, gx, gy, gz in gates:
            d2 = (gx - x) ** 2 + (gy - y) ** 2 + (gz - z) ** 2
            if gz <= lattice.toa and d2 < roi * roi:
                found[((iz * lattice.ny + iy) * lattice.nx + ix, gate)] = d2
    return found


@pytest.mark.parametrize("nb", [1.5, 6.0, 40.0])
@pytest.mark.parametrize("salt", [1, 3])
def test_neighbours_equal_brute_force(spark, nb, salt):
    lattice = replace(SMALL, nb=nb)
    gates = _gates()
    table = inline_table(spark, ("geometry_id", "gate_id", "x", "y", "z"), gates)
    geometries = inline_table(spark, ("geometry_id",), [(0,)])
    rows = neighbours.neighbours(table, geometries, lattice, salt).collect()
    expected = _brute(gates, lattice)
    got = {(r.voxel_id, r.gate_id): r.d2 for r in rows}
    assert len(rows) == len(got)
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[k], expected[k], rel_tol=1e-9) for k in got)


def test_nearest_and_knn_agree_with_brute_force(spark):
    gates = _gates()
    table = inline_table(spark, ("geometry_id", "gate_id", "x", "y", "z"), gates)
    geometries = inline_table(spark, ("geometry_id",), [(0,)])
    pairs = neighbours.neighbours(table, geometries, SMALL).cache()
    expected = {}
    for (voxel, gate), d2 in _brute(gates, SMALL).items():
        expected.setdefault(voxel, []).append((math.floor(math.sqrt(d2) * 2**18), gate))
    nearest = {r.voxel_id: r.gate_id for r in neighbours.nearest_gate_of(pairs).collect()}
    assert nearest == {v: min(c)[1] for v, c in expected.items()}
    three = {(r.voxel_id, r.gate_id) for r in neighbours.knn_gates(pairs, 3).collect()}
    assert three == {(v, g) for v, c in expected.items() for _, g in sorted(c)[:3]}


def test_gates_centimetres_apart(spark):
    """Beside a voxel and a hundred kilometres away from it."""
    lattice = replace(SMALL, nz=1, ny=1, nx=2, z_limits=(0.0, 0.0), y_limits=(0.0, 0.0), x_limits=(0.0, 100_000.0), min_radius=5000.0, blind_range_m=0.0, lowest_elevation=-90.0)
    gates = [(0, g, x, 0.0, 0.0) for g, x in ((7, 0.03), (2, 0.05), (3, -0.02), (9, 100_000.51), (4, 100_000.52), (1, 100_000.53))]
    pairs = neighbours.neighbours(inline_table(spark, ("geometry_id", "gate_id", "x", "y", "z"), gates), inline_table(spark, ("geometry_id",), [(0,)]), lattice).cache()
    assert {r.voxel_id: r.gate_id for r in neighbours.nearest_gate_of(pairs).collect()} == {0: 3, 1: 9}
    assert sorted((r.voxel_id, r.rank, r.gate_id) for r in neighbours.knn_gates(pairs, 2).collect()) == [(0, 1, 3), (0, 2, 7), (1, 1, 9), (1, 2, 4)]


def test_stored_gates_meet_their_map_without_an_exchange(spark, sf):
    """Gates and map lie in equal buckets: the column maximum exchanges pixels, gridding nothing."""
    gates, pairs = grids.gates(spark, sf), grids.geometry(spark, sf)

    def exchanges(df):
        df.collect()
        return str(df._jdf.queryExecution().executedPlan()).split("== Initial Plan ==")[0].count("Exchange hashpartitioning")

    voxels = gridding.grid_field(gates, pairs, tables.LATTICE, "DBZH")
    assert exchanges(voxels) == 0 and voxels.count() > 0
    assert exchanges(products.colmax_product(gates, pairs, tables.LATTICE)) == 1
    surface = products.field_products(gates, pairs, tables.LATTICE, None, ["DBZH", "ZDR"], ["DBZH"])
    assert exchanges(surface) == 1, "the lowest elevation lies beside the gates"
    wide = gridding.grid_field(gates, grids.geometry(spark, sf, grids.WIDE), grids.WIDE, "DBZH")
    assert exchanges(wide) == 1


def test_weights(spark):
    pairs = inline_table(
        spark, ("geometry_id", "voxel_id", "gate_id", "d2", "roi"), [(0, 0, 5, 100.0, 20.0), (0, 0, 3, 100.4, 20.0)]
    )
    got = {k: {r.gate_id: r.weight for r in neighbours.neighbour_weights(pairs, k).collect()} for k in
           ("Barnes", "Barnes2", "Cressman", "nearest")}
    assert got["Barnes"][5] == pytest.approx(math.exp(-100 / 200))
    assert got["Barnes2"][5] == pytest.approx(math.exp(-1) + 1e-5)
    assert got["Cressman"][5] == pytest.approx(300 / 500)
    assert got["nearest"] == {3: 0.0, 5: 1.0}, "the nearer gate, though less than a square metre"
    with pytest.raises(ValueError):
        neighbours.neighbour_weights(pairs, "linear")


ONE = Lattice(nz=1, ny=1, nx=1, z_limits=(0.0, 0.0), y_limits=(0.0, 0.0), x_limits=(0.0, 0.0), max_neighbors=None)


def _grid(spark, values, weights=(0.3, 0.7), exclude=None):
    gates = inline_table(spark, ("volume_id", "geometry_id", "gate_id", "v"), [(1, 0, i, v) for i, v in enumerate(values)])
    pairs = inline_table(
        spark, ("geometry_id", "voxel_id", "gate_id", "weight"), [(0, 0, i, w) for i, w in enumerate(weights)]
    )
    gates = gates.withColumn("v", F.col("v").cast("double"))
    return [r.value for r in gridding.grid_field(gates, pairs, ONE, "v", exclude).collect()]


def test_weighted_mean(spark):
    assert _grid(spark, [10.0, 20.0]) == [pytest.approx(17.0)]


def test_weights_renormalise_over_missing_and_excluded(spark):
    assert _grid(spark, [None, 20.0]) == [pytest.approx(20.0)]
    assert _grid(spark, [10.0, 20.0], exclude=F.col("v") > 15) == [pytest.approx(10.0)]
    assert _grid(spark, [None, None]) == []


CUBE = Lattice(nz=10, ny=50, nx=50, z_limits=(0.0, 10000.0), y_limits=(-25e3, 25e3), x_limits=(-25e3, 25e3))


def _cube(spark):
    lines = spark.range(10 * 50 * 50).select(
        F.lit(1).alias("volume_id"), F.expr("int(id div 2500)").alias("iz"), F.expr("int(id % 2500 div 50)").alias("iy"),
        F.expr("int(id % 50)").alias("ix"),
    )
    return lines.withColumn("value", F.when(~((F.col("iy") < 5) & (F.col("ix") < 5)), F.col("iz") * 10.0))


@pytest.mark.parametrize("how,value", [("max", 90.0), ("min", 0.0), ("mean", 45.0)])
def test_column_aggregates(spark, how, value):
    rows = gridding.column_aggregate(_cube(spark), CUBE, how).collect()
    assert len(rows) == 2500 - 25
    assert {r.value for r in rows} == {value}


def test_column_bounds_are_inclusive():
    five = Lattice(nz=5, ny=1, nx=1, z_limits=(0.0, 4000.0), y_limits=(0.0, 0.0), x_limits=(0.0, 0.0))
    assert gridding.level_bounds(five, z_min_alt=1000.0, z_max_alt=3000.0) == (1, 3)
    assert gridding.level_bounds(five, z_min_alt=1500.0, z_max_alt=9000.0) == (2, 4)
    assert gridding.level_bounds(five, z_min_idx=-3, z_max_idx=99) == (0, 4)


LEVELS = Lattice(nz=3, ny=1, nx=1, z_limits=(0.0, 2000.0), y_limits=(0.0, 0.0), x_limits=(0.0, 0.0))


def _column(spark, values):
    return inline_table(
        spark, ("volume_id", "iz", "iy", "ix", "value"), [(1, i, 0, 0, v) for i, v in enumerate(values) if v is not None]
    )


def test_cappi_blends_and_propagates_missing(spark):
    get = lambda values, z, how="linear": [r.value for r in gridding.cappi(_column(spark, values), LEVELS, z, how).collect()]
    assert get([10.0, 20.0, 30.0], 1250.0) == [pytest.approx(22.5)]
    assert get([10.0, None, 30.0], 1250.0) == []
    assert get([10.0, 20.0, 30.0], 1000.0) == [20.0]
    assert get([10.0, 20.0, 30.0], 500.0, "nearest") == [10.0]
    assert get([10.0, 20.0, 30.0], 2500.0) == [] and get([10.0, 20.0, 30.0], -1.0) == []


def test_ppi_falls_back_to_the_valid_level(spark):
    wide = replace(LEVELS, x_limits=(10000.0, 10000.0))
    angle = math.degrees(math.atan(1250 / 10000))
    get = lambda values, how="linear": [
        r.value for r in gridding.ppi(_column(spark, values), wide, angle, how, curved=False).collect()
    ]
    assert get([10.0, 20.0, 30.0]) == [pytest.approx(22.5)]
    assert get([10.0, None, 30.0]) == [30.0]
    assert get([10.0, 20.0, None]) == [20.0]
    assert get([10.0, 20.0, 30.0], "nearest") == [20.0]


def test_union_of_volumes_is_volume_by_volume(spark):
    cube = _cube(spark)
    both = cube.unionByName(cube.withColumns({"volume_id": F.lit(2), "value": F.col("value") + 1}))
    together = {(r.volume_id, r.iy, r.ix, r.value) for r in gridding.column_aggregate(both, CUBE).collect()}
    alone = {
        (r.volume_id, r.iy, r.ix, r.value)
        for v in (1, 2)
        for r in gridding.column_aggregate(both.filter(F.col("volume_id") == v), CUBE).collect()
    }
    assert together == alone


def test_pixel_filters(spark):
    pixels = inline_table(spark, ("volume_id", "iy", "ix", "value"), [(1, 0, 0, 5.0), (1, 0, 1, 15.0), (1, 1, 0, 25.0)])
    values = lambda df: [r.value for r in df.orderBy("iy", "ix").collect()]
    assert values(gridding.mask_below(pixels, 10.0)) == [None, 15.0, 25.0]
    assert values(gridding.mask_above(pixels, 15.0, -1.0)) == [5.0, 15.0, -1.0]
    assert values(gridding.mask_outside(pixels, 6.0, 20.0)) == [None, 15.0, None]
    two = Lattice(nz=1, ny=2, nx=2, z_limits=(0.0, 0.0), y_limits=(0.0, 1.0), x_limits=(0.0, 1.0))
    dense = gridding.fill_missing(pixels, pixels.select("volume_id").distinct(), two, 0.0)
    assert values(dense) == [5.0, 15.0, 25.0, 0.0]
    voxels = pixels.withColumn("voxel_id", F.col("iy") * 2 + F.col("ix").cast("bigint"))
    filled = gridding.fill_lattice(voxels, pixels.select("volume_id").distinct(), two, -9.0)
    assert values(filled) == [5.0, 15.0, 25.0, -9.0]


def test_measurements_are_exchanged_once_on_their_way_into_the_store(spark, sf):
    gates = grids.placed_gates(spark, sf)
    plan = gates._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(geometry_id") == 1 and "SortMergeJoin" not in plan
    plain = gate_store.with_lowest(tables.gates(spark, sf), tables.sweeps(spark, sf)).select(gates.columns)
    assert gates.exceptAll(plain).isEmpty() and plain.exceptAll(gates).isEmpty()


def test_buckets_follow_the_measurements(spark, sf, monkeypatch):
    """A bucket is one task, so its measurements are bounded: more of them, more buckets, of gates and map alike."""
    assert gate_store.buckets_for(0) == gate_store.buckets_for(gate_store.BUCKETS * gate_store.ROWS) == gate_store.BUCKETS
    assert gate_store.buckets_for(gate_store.BUCKETS * gate_store.ROWS + 1) == 2 * gate_store.BUCKETS
    whole = {tuple(r) for r in grids.colmax(spark, sf).collect()}
    monkeypatch.setattr(gate_store, "ROWS", -(-tables.read(spark, sf, "lineitem").count() // 32))
    monkeypatch.setattr(grids, "_STORED", {})
    assert grids.placed_gates(spark, sf).rdd.getNumPartitions() == 32
    assert {tuple(r) for r in grids.colmax(spark, sf).collect()} == whole

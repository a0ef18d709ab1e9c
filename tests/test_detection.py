from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from echolattice.config import CoreThresholds, Lattice, TopThresholds
from echolattice.functions.inline import inline_table
from echolattice.operators import components, detect, gridding, rasters, volumes
from echolattice.plans import products
from echolattice.sources import gate_store


def flood(mask: np.ndarray, wrap: bool = False) -> dict[tuple[int, int], int]:
    """Labels by flood fill, smallest raster index first."""
    rows, width = mask.shape
    label = {}
    for r0, c0 in zip(*np.nonzero(mask)):
        if (r0, c0) in label:
            continue
        stack, mark = [(r0, c0)], r0 * width + c0
        while stack:
            r, c = stack.pop()
            if wrap:
                r %= rows
            if not (0 <= r < rows and 0 <= c < width) or not mask[r, c] or (r, c) in label:
                continue
            label[(r, c)] = mark
            stack += [(r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)]
    return label


def runs_of(mask: np.ndarray) -> list[tuple[int, int, int]]:
    out = []
    for r, line in enumerate(mask):
        c = 0
        while c < len(line):
            if line[c]:
                first = c
                while c + 1 < len(line) and line[c + 1]:
                    c += 1
                out.append((r, first, c))
            c += 1
    return out


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(0, 2**32 - 1), st.booleans())
def test_runs_are_labelled_as_by_flood_fill(rows, width, seed, wrap):
    rng = np.random.default_rng(seed)
    mask = rng.random((rows, width)) < rng.uniform(0.2, 0.9)
    runs = runs_of(mask)
    start = np.array([r * width + a for r, a, _ in runs], dtype=np.int64)
    stop = np.array([r * width + b for r, _, b in runs], dtype=np.int64)
    got = components.component_of_runs(start, stop, width, rows if wrap else None) if runs else []
    expected = flood(mask, wrap)
    assert [int(g) for g in got] == [expected[(r, a)] for r, a, _ in runs]


@pytest.mark.parametrize("wrap", [False, True])
@pytest.mark.parametrize("tile", [None, 4, 5, 1024])
def test_labelling_of_images(spark, wrap, tile):
    rng = np.random.default_rng(5)
    masks = {1: rng.random((12, 15)) < 0.6, 2: rng.random((12, 15)) < 0.5}
    rows = [(v, int(r), int(c)) for v, m in masks.items() for r, c in zip(*np.nonzero(m))]
    pixels = inline_table(spark, ("volume_id", "iy", "ix"), rows)
    found = components.label_components(
        pixels, ["volume_id"], 12, 15, wrap=wrap, rounds=tile is not None, tile=tile or 1
    ).collect()
    expected = {(v, r, c): mark for v, m in masks.items() for (r, c), mark in flood(m, wrap).items()}
    assert {(f.volume_id, f.iy, f.ix): f.label for f in found} == expected


@pytest.mark.parametrize("wrap", [False, True])
def test_images_split_over_batches(spark, wrap):
    """Small Arrow batches, so that images begin and end inside and across batches."""
    rng = np.random.default_rng(8)
    masks = {v: rng.random((9, 11)) < p for v, p in enumerate((0.6, 0.02, 0.9, 0.5, 0.55, 0.7, 0.0, 0.4))}
    pixels = inline_table(
        spark, ("volume_id", "iy", "ix"), [(v, int(r), int(c)) for v, m in masks.items() for r, c in zip(*np.nonzero(m))]
    )
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in (1, 7, 40):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        found = components.label_components(pixels, ["volume_id"], 9, 11, wrap=wrap).collect()
        expected = {(v, r, c): mark for v, m in masks.items() for (r, c), mark in flood(m, wrap).items()}
        assert {(f.volume_id, f.iy, f.ix): f.label for f in found} == expected
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def greedy(points, radius):
    kept = []
    for p in sorted(points, key=lambda p: (-p[1], p[2])):
        if all(math.hypot(p[3] - k[3], p[4] - k[4]) >= radius for k in kept):
            kept.append(p)
    return {p[:3] for p in kept}


@pytest.mark.parametrize("rounds", [False, True])
def test_greedy_choice_is_sequential(spark, rounds):
    rng = np.random.default_rng(11)
    points = [
        (v, float(rng.integers(0, 6)), i, float(x), float(y))
        for v, n in ((1, 120), (2, 40))
        for i, (x, y) in enumerate(rng.uniform(0, 100, (n, 2)))
    ]
    table = inline_table(spark, ("volume_id", "strength", "tie", "x_m", "y_m"), points)
    found = detect.greedy_dedup(table, 15.0, rounds=rounds).collect()
    expected = set().union(*(greedy([p for p in points if p[0] == v], 15.0) for v in (1, 2)))
    assert {(f.volume_id, f.strength, f.tie) for f in found} == expected
    assert len(found) == len(expected)


def test_dropped_candidate_does_not_drop_others(spark):
    chain = [(1, 3.0, 0, 0.0, 0.0), (1, 2.0, 1, 8.0, 0.0), (1, 1.0, 2, 16.0, 0.0)]
    table = inline_table(spark, ("volume_id", "strength", "tie", "x_m", "y_m"), chain)
    for rounds in (False, True):
        kept = {r.tie for r in detect.greedy_dedup(table, 10.0, rounds=rounds).collect()}
        assert kept == {0, 2}


def test_a_ramp_of_separate_candidates_settles_at_once(spark, monkeypatch):
    """None is near another, so none waits for another, however many there are."""
    ramp = spark.range(2000).select(
        F.lit(1).alias("volume_id"), F.col("id").cast("double").alias("strength"), F.col("id").alias("tie"),
        (F.col("id") * 1000.0).alias("x_m"), F.lit(0.0).alias("y_m"),
    )
    cuts = []
    cut = detect.cut_lineage
    monkeypatch.setattr(detect, "cut_lineage", lambda df: cuts.append(1) or cut(df))
    assert detect.greedy_dedup(ramp, 900.0, rounds=True).count() == 2000
    assert len(cuts) == 3
    assert detect.greedy_dedup(ramp, 900.0).count() == 2000


GRID = Lattice(nz=4, ny=20, nx=20, z_limits=(3000.0, 12000.0), y_limits=(-100e3, 100e3), x_limits=(-100e3, 100e3))
X = np.linspace(-100e3, 100e3, 20)


def _image(spark, blobs, background=0.0, rhohv=None):
    image = np.full((20, 20), background)
    for (r0, r1), (c0, c1), value in blobs:
        image[r0 : r1 + 1, c0 : c1 + 1] = value
    rows = [(1, r, c, float(image[r, c]), rhohv) for r in range(20) for c in range(20)]
    return inline_table(spark, ("volume_id", "iy", "ix", "value", "rhohv"), rows).withColumn(
        "rhohv", F.col("rhohv").cast("double")
    )


def test_one_core(spark):
    found = detect.cores(_image(spark, [((14, 17), (14, 17), 60.0)]), GRID).collect()
    assert len(found) == 1
    assert (found[0].pixel_count, found[0].mean_dbz, found[0].max_dbz) == (16, 60.0, 60.0)
    assert found[0].x_m == pytest.approx(X[14:18].mean()) and found[0].y_m == pytest.approx(X[14:18].mean())


def test_close_cores_keep_the_stronger(spark):
    image = _image(spark, [((13, 16), (13, 16), 62.0), ((13, 16), (4, 7), 57.0)])
    assert len(detect.cores(image, GRID).collect()) == 2
    near = detect.cores(image, GRID, t=CoreThresholds(dedup_radius_m=150e3)).collect()
    assert [c.mean_dbz for c in near] == [62.0]


def test_core_gates(spark):
    weak = _image(spark, [((14, 17), (14, 17), 54.0)])
    assert detect.cores(weak, GRID).collect() == []
    good = weak.select("volume_id", "iy", "ix", F.lit(0.97).alias("value"))
    assert len(detect.cores(weak, GRID, good).collect()) == 1
    assert detect.cores(weak, GRID, good.withColumn("value", F.lit(0.85))).collect() == []
    spoilt = good.filter(~((F.col("iy") == 15) & (F.col("ix") == 15)))
    assert detect.cores(weak, GRID, spoilt).collect() == [], "a pixel without RhoHV fails the gate"
    single = _image(spark, [((14, 14), (14, 14), 70.0)])
    assert detect.cores(single, GRID, good).collect() == []
    central = _image(spark, [((9, 10), (9, 10), 60.0)])
    assert detect.cores(central, GRID, good).collect() == [], "too close to the radar"


def _levels(spark, level, value, rhohv):
    blob = _image(spark, [((14, 17), (14, 17), value)], rhohv=rhohv).filter(F.col("value") > 0)
    return blob.withColumn("iz", F.lit(level))


def test_one_top(spark):
    found = detect.tops(_levels(spark, 3, 30.0, 0.97), GRID, "rhohv").collect()
    assert [(t.level_index, t.altitude_m, t.altitude_km, t.pixel_count) for t in found] == [(3, 12000.0, 12.0, 16)]


def test_top_gates(spark):
    assert detect.tops(_levels(spark, 2, 30.0, 0.97), GRID, "rhohv").collect() == [], "not above the least altitude"
    assert detect.tops(_levels(spark, 3, 19.0, 0.97), GRID, "rhohv").collect() == []
    assert detect.tops(_levels(spark, 3, 30.0, 0.9), GRID, "rhohv").collect() == []
    assert len(detect.tops(_levels(spark, 3, 30.0, 0.9), GRID).collect()) == 1
    assert len(detect.tops(_levels(spark, 3, 30.0, None), GRID, "rhohv").collect()) == 1, "no RhoHV keeps a top"


def test_the_higher_of_two_tops_stays(spark):
    low = Lattice(**{**GRID.__dict__, "z_limits": (9500.0, 12500.0)})
    both = _levels(spark, 1, 40.0, 0.97).unionByName(_levels(spark, 3, 30.0, 0.97))
    assert [t.level_index for t in detect.tops(both, low, "rhohv").collect()] == [3]


def test_uneven_levels(spark):
    uneven = _levels(spark, 0, 30.0, 0.97).withColumn("height", F.lit(11000.0) + F.col("ix"))
    found = detect.tops(uneven, GRID, "rhohv", altitude="height").collect()
    assert [t.altitude_m for t in found] == [pytest.approx(11015.5)]


def test_moving_a_blob_moves_its_core(spark):
    here = detect.cores(_image(spark, [((14, 17), (14, 17), 60.0)]), GRID).collect()[0]
    there = detect.cores(_image(spark, [((12, 15), (13, 16), 60.0)]), GRID).collect()[0]
    assert there.x_m - here.x_m == pytest.approx(-GRID.x_step)
    assert there.y_m - here.y_m == pytest.approx(-2 * GRID.y_step)


def test_thresholds_are_parameters():
    assert TopThresholds().min_dbz == 20.0 and CoreThresholds(min_dbz=40.0).min_dbz == 40.0


def test_no_radius_keeps_all(spark):
    rows = spark.createDataFrame([(1, 0.0, 0.0, 5.0, 1), (1, 0.0, 0.0, 4.0, 2)], "volume_id int, x_m double, y_m double, strength double, tie int")
    assert [detect.greedy_dedup(rows, 0.0, rounds=r).count() for r in (False, True)] == [2, 2]


def test_a_component_through_many_tiles_is_one(spark):
    """A snake over a large image: only cells on tile borders are joined."""
    lines = spark.range(0, 400, 2).select(F.lit(1).alias("volume_id"), F.col("id").cast("int").alias("iy"), F.explode(F.sequence(F.lit(0), F.lit(399))).alias("ix"))
    turns = spark.range(1, 399, 2).select(F.lit(1).alias("volume_id"), F.col("id").cast("int").alias("iy"), F.when(F.col("id") % 4 == 1, 399).otherwise(0).alias("ix"))
    found = components.label_components(lines.unionByName(turns), ["volume_id"], 400, 400, rounds=True, tile=64)
    assert [tuple(r) for r in found.groupBy("label").count().collect()] == [(0, 200 * 400 + 199)]


def _two_fields(lattice, spark, elevation):
    """Voxels with holes in both fields, a volume without RhoHV and one without an elevation."""
    cells = spark.range(3 * lattice.nz * lattice.ny * lattice.nx).selectExpr(
        f"id div {lattice.nz * lattice.ny * lattice.nx} AS volume_id", f"CAST(id div {lattice.ny * lattice.nx} % {lattice.nz} AS INT) AS iz",
        f"CAST(id div {lattice.nx} % {lattice.ny} AS INT) AS iy", f"CAST(id % {lattice.nx} AS INT) AS ix", "xxhash64(id) AS h",
    )
    return cells.select(
        "volume_id", "iz", "iy", "ix", F.expr("CASE WHEN h % 3 != 0 THEN h % 97 * 0.5D END AS value"),
        F.expr("CASE WHEN h % 4 != 0 AND volume_id != 1 THEN (h % 89) / 89.0D END AS rhohv"),
        F.expr(f"CASE WHEN volume_id != 2 THEN CAST({elevation} AS DOUBLE) END AS {gate_store.LOWEST}"),
    )


@pytest.mark.parametrize("elevation", [0.5, 3.5, 9.0])
def test_column_and_surface_in_one_pass(spark, elevation):
    lattice = Lattice(nz=4, ny=21, nx=19, z_limits=(0.0, 9000.0), y_limits=(-150e3, 150e3), x_limits=(-150e3, 150e3))
    voxels = _two_fields(lattice, spark, elevation)
    both = gridding.column_and_surface(voxels, lattice, gate_store.LOWEST, "rhohv")
    lowest = spark.createDataFrame([(0, elevation), (1, elevation)], "volume_id long, elevation double")
    column = gridding.column_aggregate(voxels, lattice)
    surface = products.rhohv_surface(voxels, lattice, lowest).withColumnRenamed("value", "rhohv")
    wanted = column.join(surface, ["volume_id", "iy", "ix"], "left").select("volume_id", "iy", "ix", "value", "rhohv")
    rows = sorted(both.collect(), key=lambda r: r[:3])
    assert rows == sorted(wanted.collect(), key=lambda r: r[:3]) and any(r.rhohv is not None for r in rows)
    plan = both._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1


def test_lowest_sweep_sorts_no_input(spark):
    """What reads all sweeps is a hash aggregate; a sort would spill where sweeps come from every measurement."""
    sweeps = spark.range(100).selectExpr("id % 3 AS volume_id", "CAST(id % 7 AS INT) AS sweep", "2.5D - (id % 7) div 5 AS elevation").distinct()
    found = volumes.lowest_sweep(sweeps)
    assert sorted(map(tuple, found.collect())) == [(v, 5, 1.5) for v in range(3)]
    aggregates = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Aggregate(" in x]
    assert "HashAggregate" in aggregates[-1]


@pytest.mark.parametrize("method", ["average", "nearest"])
def test_overviews_exchange_pixels_once(spark, method):
    pixels = spark.range(40 * 40).selectExpr("id % 2 AS volume_id", "CAST(id div 40 AS INT) AS iy", "CAST(id % 40 AS INT) AS ix", "id * 1.0D AS value")
    out = rasters.overviews(pixels, method, (2, 3, 8))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Generate") < plan.index("Exchange hashpartitioning")
    cells = {}
    for r in sorted(pixels.collect(), key=lambda r: (r.iy, r.ix)):
        for f in (2, 3, 8):
            cells.setdefault((r.volume_id, f, r.iy // f, r.ix // f), []).append(r.value)
    best = (lambda v: v[0]) if method == "nearest" else (lambda v: sum(v) / len(v))
    assert {tuple(r[:4]): r.value for r in out.collect()} == {k: best(v) for k, v in cells.items()}

from __future__ import annotations

import zlib
import os
import tempfile
import zlib
from datetime import datetime

import numpy as np
from pyspark.sql import functions as F

from echolattice.config import Lattice
from echolattice.functions.inline import inline_table
from echolattice.functions.colours import Scale
from echolattice.operators import stations
from echolattice.sources import commits, files, geometry_store, map_cache, payload, sinks, tree_source
from echolattice.streaming import runner
from echolattice.streaming.ledger import dedup_sink
from echolattice.session import cut_lineage, shared_folder

NAMES = (
    "RAD1_0315_01_DBZH_20240101T000000Z.BUFR", "RAD1_0315_01_DBZH_20240101T010000Z.BUFR",
    "RAD2_0315_01_ZDR_20240102T000500Z.BUFR",
)


def _tree():
    base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    for name in NAMES:
        stamp = name.split("_")[-1]
        folder = f"{base}/{name.split('_')[0]}/{stamp[:4]}/{stamp[4:6]}/{stamp[6:8]}/{stamp[9:11]}/{stamp[11:15]}"
        os.makedirs(folder)
        for each in (name, "notes.txt"):
            with open(f"{folder}/{each}", "wb") as out:
                out.write(b"x")
    return base


def test_tree_is_listed_within_bounds(spark):
    base = _tree()
    names = lambda df: {r.filename for r in df.collect()}
    at = lambda text: F.lit(text).cast("timestamp")
    assert names(files.scan_tree(spark, base)) == set(NAMES)
    bounded = files.scan_tree(spark, base, start=at("2024-01-01 00:00:00"), end=at("2024-01-02 00:05:00"), include_start=False)
    assert names(bounded) == set(NAMES[1:])
    open_end = files.scan_tree(spark, base, start=at("2024-01-01 00:00:00"), end=at("2024-01-02 00:05:00"), include_end=False)
    assert names(open_end) == set(NAMES[:2])
    assert names(files.scan_tree(spark, base, radars=["RAD1"], hours=["2024/01/01/01"])) == {NAMES[1]}
    assert names(files.scan_tree(spark, base, hours=["2024/01/02/00"])) == {NAMES[2]}


def test_bounds_prune_the_folders(spark):
    base = _tree()
    tail = lambda paths: sorted(p.split("/RAD")[1] for p in paths)
    found = files.tree_folders(spark, base, None, datetime(2024, 1, 1, 0, 30), datetime(2024, 1, 2, 0, 5))
    assert tail(found) == ["1/2024/01/01/00", "1/2024/01/01/01", "2/2024/01/02/00"]
    assert tail(files.tree_folders(spark, base, None, datetime(2024, 1, 1, 0, 30), None)) == ["1/2024/01/01/00", "1/2024/01/01/01", "2/2024/01/02"]
    assert tail(files.tree_folders(spark, base, ["RAD1"], datetime(2023, 5, 1), datetime(2024, 6, 1))) == ["1/2024/01"]
    assert files.tree_folders(spark, base, None, datetime(2025, 1, 1), None) == []
    names = lambda **k: {r.filename for r in files.scan_tree(spark, base, **k).collect()}
    assert names(start=datetime(2024, 1, 1), end=datetime(2024, 1, 2, 0, 5), include_start=False) == set(NAMES[1:])
    assert names(start=datetime(2024, 1, 1, 0, 30)) == set(NAMES[1:])
    assert names(start=datetime(2025, 1, 1)) == set()


LAT = Lattice(nz=1, ny=2, nx=2, z_limits=(0.0, 0.0), y_limits=(0.0, 1.0), x_limits=(0.0, 1.0))


def test_store_keeps_overrides_and_finds_unbuilt_maps(spark):
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    geometries = inline_table(spark, ("geometry_id", "nb"), [(1, 2.5)])
    pairs = inline_table(spark, ("geometry_id", "voxel_id", "gate_id", "weight"), [(1, 0, 7, 1.0), (1, 3, 9, 1.0)])
    geometry_store.save_geometry(pairs, geometry_store.geometry_meta(geometries, LAT), path)
    assert sorted(map(tuple, geometry_store.load_geometry(spark, path).collect())) == sorted(map(tuple, pairs.collect()))
    (meta,) = geometry_store.peek_geometry(spark, path).collect()
    assert meta.params["nb"] == "2.5" and meta.params["h_factor"] == str(LAT.h_factor)
    wanted = inline_table(spark, ("geometry_id",), [(1,), (2,)])
    assert [r.geometry_id for r in geometry_store.unbuilt(wanted, spark, path).collect()] == [2]


def test_bucketed_map_is_not_shuffled_again(spark):
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    pairs = spark.range(1000).select((F.col("id") % 2).alias("geometry_id"), "id", (F.col("id") % 97).alias("gate_id"))
    geometry_store.save_bucketed(pairs, "bucketed_map", 8, f"{path}/map")
    gates = spark.range(194).select((F.col("id") % 2).alias("geometry_id"), F.expr("id div 2").alias("gate_id"))
    joined = gates.hint("merge").join(spark.table("bucketed_map"), ["geometry_id", "gate_id"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, "only the gates move"
    assert joined.count() == 1000
    spark.sql("DROP TABLE bucketed_map")


def test_lineage_is_cut_in_the_shared_folder(spark):
    assert shared_folder(spark) == shared_folder(spark)
    cut = cut_lineage(spark.range(10).filter("id % 2 = 0"))
    assert cut.count() == 5 and "Filter" not in cut._jdf.queryExecution().executedPlan().toString()


def test_a_second_write_keeps_the_first_volume(spark):
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    gates = inline_table(spark, ("volume_id", "radar", "gate_id", "DBZH"), [(1, "A", 0, 1.0), (1, "A", 1, 2.0), (2, "A", 0, 3.0)])
    gates = gates.withColumn("obs_ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    for volume in (1, 2, 2):
        sinks.write_volumes(gates.filter(F.col("volume_id") == volume), path)
    held = lambda: sorted((r.volume_id, r.DBZH) for r in commits.held(spark, path).collect())
    assert held() == [(1, 1.0), (1, 2.0), (2, 3.0)]
    nothing = gates.limit(0)
    sinks.write_volumes(nothing, path, volumes=gates.filter("volume_id = 1").select("volume_id"))
    assert held() == [(2, 3.0)], "an empty result replaces the old one"
    sinks.write_volumes(nothing, path)
    assert held() == [(2, 3.0)]


def test_a_write_cut_off_before_its_commit_is_invisible(spark):
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    rows = inline_table(spark, ("volume_id", "day", "v"), [("007", "a", 1.0), ("8", "a", 2.0)])
    first = commits.publish(rows, path, ("day", "volume_id"))
    # Data of the next write without its listing, as a lost driver leaves it.
    rows.withColumn("v", F.lit(9.0)).write.partitionBy("day", "volume_id").parquet(f"{path}/data/batch={first + 1}")
    held = lambda: sorted((r.volume_id, r.v) for r in commits.held(spark, path).collect())
    assert held() == [("007", 1.0), ("8", 2.0)], "names stay as they were"
    assert commits.publish(rows.filter("volume_id = '8'").withColumn("v", F.lit(3.0)), path, ("day", "volume_id")) == first + 1
    assert held() == [("007", 1.0), ("8", 3.0)]
    commits.publish(rows.withColumn("v", F.lit(4.0)), path, ("day", "volume_id"), batch=first)
    assert held() == [("007", 4.0), ("8", 3.0)], "a replayed batch replaces its own rows only"


def test_features_that_are_gone_leave_no_file_behind(spark):
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    volumes = inline_table(spark, ("volume_id",), [(1,), (2,)])
    lines = inline_table(spark, ("volume_id", "folder", "name", "geojson"), [(1, "2024/01/01", "a", "{}"), (2, "2024/01/01", "b", "{}")])
    sinks.write_features(lines, path, volumes)
    sinks.write_features(lines.filter("volume_id = 2"), path, volumes)
    assert [r.volume_id for r in commits.held(spark, path, "text").collect()] == [2]


def test_a_window_reads_few_row_groups(spark):
    """The rows a scan returns for a small window of a large image."""
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    pixels = spark.range(1024 * 1024).select(
        F.lit(1).alias("volume_id"), F.floor(F.col("id") / 1024).cast("int").alias("iy"), (F.col("id") % 1024).cast("int").alias("ix"), F.rand(1).alias("value")
    )
    sinks.write_tiles(sinks.tile_table(pixels, "COLMAX", Scale("th"), tile=64), path)
    found = sinks.read_window(spark, path, "COLMAX", 1, (100, 110), (200, 210), tile=64)
    assert found.count() == 121
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(tile_y" in plan.replace("`", "")
    rows = spark.read.parquet(f"{path}/data").filter("zoom = 1").select("tile_y", "tile_x", F.col("_metadata.row_index").alias("at"))
    order = [(r.tile_y, r.tile_x) for r in rows.groupBy("tile_y", "tile_x").agg(F.min("at").alias("at")).orderBy("at").collect()]
    assert order[:4] == [(0, 0), (0, 1), (1, 0), (1, 1)], "tiles lie in Morton order"


def test_window_of_stored_tiles(spark):
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    pixels = spark.range(300 * 40).select(
        F.lit(1).alias("volume_id"), F.floor(F.col("id") / 40).cast("int").alias("iy"), (F.col("id") % 40).cast("int").alias("ix"), F.col("id").cast("double").alias("value")
    )
    for method in ("nearest", "average"):
        sinks.write_tiles(sinks.tile_table(pixels, "COLMAX", Scale("th"), tile=16, method=method), path)
        found = sinks.read_window(spark, path, "COLMAX", 2, (70, 100), (3, 5), tile=16).collect()
        offset = {"nearest": 0.0, "average": 20.5}[method]
        expected = {(y, x): 2 * y * 40 + 2 * x + offset for y in range(70, 101) for x in range(3, 6)}
        assert {(r.iy, r.ix): r.value for r in found} == expected


def test_stations_on_both_sides_of_the_date_line(spark):
    radars = inline_table(spark, ("radar", "site_lon", "site_lat", "nrays", "ngates", "gate_size", "gate_offset"), [("R", 179.4, -10.0, 360, 480, 500, 500)])
    places = inline_table(spark, ("station", "lon", "lat"), [("west", 179.5, -10.0), ("east", -179.5, -10.0), ("far", -170.0, -10.0)])
    found = stations.stations_in_reach(places, radars).collect()
    assert sorted(r.station for r in found) == ["east", "west"]


def test_maps_are_searched_once_by_canonical_key(spark):
    """Equal scans and parameters share a search, whatever the radar; other parameters or scans do not; a key that is known is not searched."""
    path, searched = tempfile.mkdtemp(prefix="spark-", dir="/tmp"), []

    def search(scans):
        ids = sorted(r.geometry_id for r in scans.select("geometry_id").distinct().collect())
        searched.append(ids)
        return spark.createDataFrame([(i, v, 10 * i + v, 1.0) for i in ids for v in range(3)], "geometry_id long, voxel_id long, gate_id long, weight double")

    def scans(*rows):
        return spark.createDataFrame([(g, r, "0315", "01", sweep, e, nb) for g, r, e, nb in rows for sweep in (0, 1)], "geometry_id long, radar string, strategy string, vol_nr string, sweep int, elevation double, nb double")

    first = map_cache.ensure(scans((1, "A", 0.5, 1.0), (2, "A", 0.5, 1.0), (3, "B", 0.5, 1.0)), LAT, path, search)
    assert searched == [[1]] and len({r.map_key for r in first.collect()}) == 2
    second = map_cache.ensure(scans((1, "A", 0.5, 1.0), (4, "C", 0.5, 1.0), (5, "A", 0.5, 2.0), (6, "A", 1.5, 1.0)), LAT, path, search)
    assert searched == [[1], [5, 6]], "the map of C is known under another radar's key"
    map_cache.ensure(scans((6, "A", 1.5, 1.0), (3, "B", 0.5, 1.0)), LAT, path, search)
    assert len(searched) == 2
    got = {(r.geometry_id, r.gate_id, r.batch) for r in map_cache.load(spark, path, second).collect()}
    assert got == {(g, 10 * s + v, b) for g, s, b in ((1, 1, 0), (4, 1, 0), (5, 5, 1), (6, 6, 1)) for v in range(3)}
    assert all("_NB2p00_" in r.map_key for r in second.collect() if r.geometry_id == 5)


def test_the_tree_as_a_data_source(spark):
    """Batch with pushed bounds lists the folders it needs; a stream resumes less its buffer and gives the files of a batch."""
    base = _tree()
    tree_source.register(spark)
    read = lambda: spark.read.format("radar_tree").load(base)
    assert {r.filename for r in read().collect()} == set(NAMES)
    same = ["radar", "filename", "obs_ts", "field", "length"]
    assert sorted(map(tuple, read().select(same).collect())) == sorted(map(tuple, files.scan_tree(spark, base).select(same).collect()))
    reader = tree_source.TreeReader({"path": base})
    at = lambda *x: datetime(*x)
    filters = [tree_source.GreaterThanOrEqual(("obs_ts",), at(2024, 1, 1, 0, 30)), tree_source.LessThan(("obs_ts",), at(2024, 1, 1, 5)), tree_source.EqualTo(("radar",), "RAD1")]
    assert list(reader.pushFilters(filters)) == filters
    (month,) = reader.partitions()
    assert (month.radar, month.year, month.month) == ("RAD1", "2024", "01")
    assert [f[3] for f in reader.read(month)] == [NAMES[1]]
    assert list(tree_source.TreeReader({"path": base + "/none"}).read(tree_source.TreeReader({"path": base + "/none"}).partitions()[0])) == []
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    stream = spark.readStream.format("radar_tree").option("buffer_minutes", 5).load(base)
    sink = dedup_sink(f"{path}/files")
    columns = ["filename", "radar", "field", "obs_ts"]
    runner.drain(stream.select(columns), sink, f"{path}/checkpoint")
    os.makedirs(f"{base}/RAD1/2024/01/02/00/0200")
    more = "RAD1_0315_01_DBZH_20240102T000200Z.BUFR"
    open(f"{base}/RAD1/2024/01/02/00/0200/{more}", "wb").write(b"x")
    os.makedirs(f"{base}/RAD1/2024/01/02/00/3000")
    newest = "RAD1_0315_01_DBZH_20240102T003000Z.BUFR"
    open(f"{base}/RAD1/2024/01/02/00/3000/{newest}", "wb").write(b"x")
    runner.drain(stream.select(columns), sink, f"{path}/checkpoint")
    assert {r.filename for r in spark.read.parquet(f"{path}/files").collect()} == {r.filename for r in read().collect()} == {*NAMES, more, newest}


def test_a_commit_leaves_one_file_in_a_folder(spark, tmp_path):
    """Rows of a volume that lie in many tasks are gathered first: files grow with volumes, not with tasks times volumes."""
    rows = spark.range(0, 400, 1, 8).select((F.col("id") % 5).alias("volume_id"), F.lit("d").alias("day"), F.col("id").cast("string").alias("value"))
    path = str(tmp_path)
    commits.publish(rows, path, ("day", "volume_id"), kind="text")
    assert len(list(tmp_path.glob("data/**/part-*.txt"))) == 5
    assert commits.held(spark, path, "text").groupBy("volume_id").count().filter("count = 80").count() == 5


def test_few_sweeps_meet_python_at_once(spark):
    """Memory of a worker must not grow with the sweeps of its task."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "10000")
    try:
        blob = zlib.compress(np.arange(6, dtype="<f8").tobytes())
        sweeps = spark.range(0, 500, 1, 1).selectExpr("id AS volume_id", "0 AS sweep", "2 AS nrays", "3 AS ngates").withColumn("payload", F.lit(blob))
        decoded = payload.decode_sweeps(sweeps)
        sizes = sweeps.mapInPandas(lambda batches: (b.head(1)[["sweep"]].assign(sweep=len(b)) for b in batches), "sweep int").collect()
        assert max(r.sweep for r in sizes) <= payload.SWEEPS_PER_BATCH
        assert payload.decoded_gates(decoded).count() == 3000
    finally:
        spark.conf.set(setting, before)

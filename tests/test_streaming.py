from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from echolattice.streaming import incomplete, products, runner
from echolattice.streaming import ledger as live
from workload import tables
from workload.ledger import seconds


def staged(spark, rows, batches):
    """A stream that delivers the given rows in the given batches."""
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    for batch in batches:
        rows.filter(F.col("event_id").isin(batch)).coalesce(1).write.mode("append").parquet(f"{path}/in")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in"), path


def arrivals(spark, items):
    rows = spark.createDataFrame(
        [(e, f"{f}-{o}", "RAD1", "0315", "01", f, "completed", f"2024-01-01 {o}", f"2024-01-01 {c}") for e, f, o, c in items],
        "event_id long, filename string, radar string, strategy string, vol_nr string, field string, status string,"
        " obs_ts string, created_ts string",
    )
    return rows.withColumns({c: F.col(c).cast("timestamp") for c in ("obs_ts", "created_ts")})


def test_a_late_field_reopens_its_volume(spark):
    rows = arrivals(spark, [(1, "DBZH", "00:00:00", "00:01:00"), (2, "ZDR", "00:10:00", "00:11:00"), (3, "ZDR", "00:00:00", "00:12:00")])
    stream, path = staged(spark, rows, ([1], [2], [3]))
    states = runner.collected(spark, live.stream_volumes(stream, ["DBZH", "ZDR"], "1 hour"), path, "update")
    final = {r.obs_s: (r.is_complete, r.missing) for r in runner.latest_state(states, list(live.VOLUME)).withColumn("obs_s", F.date_format("obs_ts", "HH:mm")).collect()}
    assert final == {"00:00": (True, []), "00:10": (False, ["DBZH"])}
    products = rows.select(*live.VOLUME).distinct().withColumn("status", F.lit("completed"))
    assert live.reopened(states, products).count() == 1


def test_volumes_are_given_up_behind_the_watermark(spark):
    rows = arrivals(spark, [(1, "DBZH", "00:00:00", "00:01:00"), (2, "DBZH", "06:00:00", "06:01:00"), (3, "DBZH", "06:05:00", "06:06:00"), (4, "ZDR", "00:00:00", "06:07:00")])
    stream, path = staged(spark, rows, ([1], [2], [3], [4]))
    done = runner.collected(spark, live.stream_timed_out(stream, ["DBZH", "ZDR"], "1 hour"), path).collect()
    assert [(r.downloaded, r.is_complete) for r in done] == [(["DBZH"], False)], "the late field comes too late"


def test_files_are_taken_once_however_late(spark):
    """The third batch brings a copy and a first arrival far behind the newest observation; a replay changes nothing."""
    rows = arrivals(spark, [(1, "DBZH", "00:00:00", "00:01:00"), (2, "DBZH", "20:00:00", "20:02:00"), (3, "DBZH", "00:00:00", "20:03:00"), (4, "ZDR", "00:00:00", "20:04:00")])
    stream, path = staged(spark, rows, ([1], [2], [3, 4]))
    sink = live.dedup_sink(f"{path}/files")
    runner.drain(stream, sink, f"{path}/checkpoint")
    sink(rows.filter("event_id = 2"), 1)
    names = sorted(r.filename for r in spark.read.parquet(f"{path}/files").collect())
    assert names == ["DBZH-00:00:00", "DBZH-20:00:00", "ZDR-00:00:00"]


def test_order_is_followed_across_batches(spark):
    rows = arrivals(spark, [(1, "DBZH", "00:20:00", "00:21:00"), (2, "DBZH", "00:10:00", "00:22:00"), (3, "DBZH", "00:30:00", "00:31:00"), (4, "DBZH", "00:25:00", "00:32:00")])
    stream, path = staged(spark, rows, ([1], [2, 3], [4]))
    sink = live.order_sink(f"{path}/order")
    runner.drain(stream, sink, f"{path}/checkpoint")
    flags = lambda: {r.event_id: r.out_of_order for r in spark.read.parquet(f"{path}/order/rows").collect()}
    assert flags() == {1: False, 2: True, 3: False, 4: True}
    sink(rows.filter("event_id IN (2, 3)"), 1)
    assert flags() == {1: False, 2: True, 3: False, 4: True}, "a replayed batch changes nothing"


def test_stuck_volumes_return_to_pending(spark):
    rows = arrivals(spark, [(1, "a", "00:00:00", "00:00:00"), (2, "b", "00:00:00", "00:10:00"), (3, "b", "00:00:00", "00:20:00"), (4, "c", "00:00:00", "05:00:00")])
    states = rows.select(
        F.col("field").alias("volume_id"), "event_id", F.col("created_ts").alias("updated_ts"),
        F.when(F.col("event_id") == 3, "completed").otherwise("processing").alias("status"),
    )
    stream, path = staged(spark, states, ([1, 2], [3], [4]))
    late = runner.collected(spark, live.stream_stuck(stream, "1 minute", 60), path).collect()
    assert [(r.volume_id, r.status) for r in late] == [("a", "pending")]


def test_a_replayed_batch_leaves_one_copy(spark):
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    sink = runner.batch_table(path)
    for _ in range(2):
        sink(spark.range(5), 0)
    assert spark.read.parquet(path).count() == 5


def test_slots_of_a_stream_are_those_of_the_batch(spark, sf):
    log = tables.arrivals(spark, sf)
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    log.repartition(3).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    states = runner.collected(spark, live.stream_slots(stream, "400 days"), path, "update")
    got = runner.latest_state(states, ["slot_ts", "radar"]).select(seconds("slot"), "radar", "files").collect()
    expected = log.groupBy((F.floor(F.unix_timestamp("created_ts") / 600) * 600).alias("slot_s"), "radar").count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected))


def test_a_stream_without_rows_reads_back_empty(spark):
    rows = arrivals(spark, [(1, "DBZH", "00:00:00", "00:01:00")])
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    rows.filter("event_id < 0").write.parquet(f"{path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
    assert runner.collected(spark, stream.select("filename"), path).count() == 0


def test_a_volume_done_again_replaces_itself_even_by_nothing(spark):
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    gates = spark.createDataFrame([(1, 5.0), (2, 6.0)], "volume_id long, value double")
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "volume_id long")
    sink = products.product_sink(gates, {"all": lambda g: g}, path)
    sink(ids(1, 2), 0)
    sink(ids(1, 2), 0)
    assert sorted(map(tuple, products.stored_products(spark, path, "all").collect())) == [(1, 5.0), (2, 6.0)]
    products.product_sink(gates, {"all": lambda g: g.filter("value < 0")}, path)(ids(1), 1)
    assert [tuple(r) for r in products.stored_products(spark, path, "all").collect()] == [(2, 6.0)]


def test_volumes_are_given_up_by_attempts_or_time_over_a_restart(spark):
    """Complete at once, after failed attempts, after hours, and still open at the end; a field after giving up opens a volume again."""
    items = [(1, "DBZH", "00:00:00", "00:01:00"), (2, "ZDR", "00:00:00", "00:02:00"), (3, "DBZH", "00:10:00", "00:11:00"),
             (4, "ZDR", "00:10:00", "00:12:00"), (5, "ZDR", "00:10:00", "00:13:00"), (6, "DBZH", "00:20:00", "00:21:00"),
             (7, "DBZH", "06:00:00", "06:01:00"), (8, "ZDR", "00:20:00", "06:02:00"), (9, "DBZH", "09:00:00", "09:01:00")]
    rows = arrivals(spark, items).withColumn("status", F.when(F.col("event_id").isin(4, 5), "failed").otherwise("completed"))
    path, kinds = tempfile.mkdtemp(prefix="spark-", dir="/tmp"), {("0315", "01"): ["DBZH", "ZDR"]}
    with incomplete.keyed_state(spark):
        for part in (([1, 2], [3, 4]), ([5, 6], [7]), ([8, 9],)):
            for batch in part:
                rows.filter(F.col("event_id").isin(batch)).coalesce(1).write.mode("append").parquet(f"{path}/in")
            stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
            out = incomplete.follow_volumes(stream, kinds, "1 minute", max_attempts=2, timeout_minutes=120)
            runner.drain(out, runner.batch_table(f"{path}/out"), f"{path}/checkpoint")
    came = spark.read.parquet(f"{path}/out").drop("batch_id").unionByName(incomplete.still_open(spark, f"{path}/checkpoint"))
    stamp = F.date_format("obs_ts", "HH:mm").alias("obs")
    seen = {(r.obs, r.reason, ",".join(r.downloaded)) for r in came.select(stamp, "reason", "downloaded").collect()}
    assert {x for x in seen if x[1] != "open"} == {("00:00", "complete", "DBZH,ZDR"), ("00:10", "attempts", "DBZH"), ("00:20", "time", "DBZH"), ("06:00", "time", "DBZH"), ("00:20", "time", "ZDR")}
    assert {x for x in seen if x[1] == "open"} == {("09:00", "open", "DBZH")}
    expected = spark.createDataFrame([("0315", "01", ["DBZH", "ZDR"])], "strategy string, vol_nr string, expected array<string>")
    final = {r.obs: (r.is_complete, r.attempts) for r in incomplete.outcomes(came, expected).select(stamp, "is_complete", "attempts").collect()}
    assert final == {"00:00": (True, 0), "00:10": (False, 2), "00:20": (True, 0), "06:00": (False, 0), "09:00": (False, 0)}


def test_late_rows_go_aside_and_nothing_is_lost(spark):
    rows = arrivals(spark, [(1, "DBZH", "00:00:00", "00:01:00"), (2, "DBZH", "20:00:00", "20:01:00"), (3, "ZDR", "00:00:00", "20:02:00"), (4, "DBZH", "00:00:00", "20:03:00"), (5, "ZDR", "20:00:00", "20:04:00")])
    stream, path = staged(spark, rows, ([1], [2], [3, 4, 5]))
    sink = live.late_sink(path + "/out", "1 HOUR")
    runner.drain(stream, sink, f"{path}/checkpoint")
    sink(rows.filter("event_id IN (3, 4, 5)"), 2)
    held, late = (spark.read.parquet(f"{path}/out/{n}") for n in ("rows", "late"))
    assert sorted(r.event_id for r in held.collect()) == [1, 2, 5] and sorted(r.event_id for r in late.collect()) == [3, 4]
    (opened,) = live.reopened_by_late(held, late).collect()
    assert (opened.held, opened.late_fields) == (["DBZH"], ["ZDR"])

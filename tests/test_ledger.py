from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from echolattice.functions.inline import inline_table
from echolattice.operators import ledger
from workload import tables

CATALOGUE = {"0315": {"01": ["DBZH", "ZDR"]}}


def stamped(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp") for c in columns})


def files(spark, rows):
    """(event, field, obs, status, cleanup) rows of one radar and volume number."""
    full = [
        (e, f"RAD1_0315_01_{f}_{o[:10]}.BUFR", "RAD1", "0315", "01", f, o, s, c, o, 0) for e, f, o, s, c in rows
    ]
    names = ("event_id", "filename", "radar", "strategy", "vol_nr", "field", "obs_ts", "status", "cleanup_status",
             "created_ts", "retry_count")
    out = inline_table(spark, names, full).withColumn("cleanup_status", F.col("cleanup_status").cast("string"))
    return stamped(out, "obs_ts", "created_ts")


def volumes(spark, rows):
    full = [(v, "RAD1", "0315", "01", o, s, done, "/v", None, o) for v, o, s, done in rows]
    names = ("volume_id", "radar", "strategy", "vol_nr", "obs_ts", "status", "is_complete", "stored_path",
             "cleanup_status", "updated_ts")
    out = inline_table(spark, names, full).withColumn("cleanup_status", F.col("cleanup_status").cast("string"))
    return stamped(out, "obs_ts", "updated_ts")


def products(spark, rows):
    out = inline_table(spark, ("volume_id", "product_type", "status", "generated_ts"), rows)
    return stamped(out, "generated_ts").withColumns(
        {"error_type": F.lit(None).cast("string"), "updated_ts": F.col("generated_ts")}
    )


def at(text):
    return F.lit(text).cast("timestamp")


def test_last_writer_wins_and_resets(spark):
    log = files(spark, [
        (1, "DBZH", "2024-01-01 00:00:00", "failed", "active"), (2, "DBZH", "2024-01-01 00:00:00", "completed", None),
    ])
    (row,) = ledger.current_files(log).collect()
    assert (row.event_id, row.status, row.cleanup_status) == (2, "completed", None)


@pytest.mark.parametrize(
    "fields,complete,missing",
    [(["DBZH", "ZDR"], True, []), (["DBZH"], False, ["ZDR"]), (["DBZH", "ZDR", "KDP"], False, [])],
)
def test_complete_means_equal(spark, fields, complete, missing):
    log = files(spark, [(i, f, "2024-01-01 00:00:00", "completed", None) for i, f in enumerate(fields)])
    (row,) = ledger.volume_completeness(log, CATALOGUE).collect()
    assert (row.is_complete, row.missing) == (complete, missing)


def test_unlisted_kinds_are_skipped(spark):
    log = files(spark, [(1, "DBZH", "2024-01-01 00:00:00", "completed", None)])
    assert ledger.volume_completeness(log, {"0300": {"01": ["DBZH"]}}).collect() == []


def test_cleanup_needs_age_volume_and_every_product(spark):
    log = files(spark, [
        (1, "DBZH", "2024-01-01 00:00:00", "completed", None), (2, "DBZH", "2024-01-10 00:00:00", "completed", "active"),
        (3, "DBZH", "2024-01-02 00:00:00", "completed", "cleaned"),
    ])
    vols = volumes(spark, [
        ("a", "2024-01-01 00:00:00", "completed", True), ("b", "2024-01-10 00:00:00", "completed", True),
        ("c", "2024-01-02 00:00:00", "completed", True),
    ])
    made = products(spark, [(v, k, "completed", "2024-01-10 00:00:00") for v in "abc" for k in ("image", "raw_cog")])
    ready = ledger.files_for_cleanup(log, vols, made, ["image", "raw_cog"], at("2024-01-05 00:00:00"))
    assert [r.event_id for r in ready.collect()] == [1]
    partial = made.filter(~((F.col("volume_id") == "a") & (F.col("product_type") == "image")))
    assert ledger.files_for_cleanup(log, vols, partial, ["image", "raw_cog"], at("2024-01-05 00:00:00")).collect() == []
    assert len(ledger.volumes_for_cleanup(vols, made, ["image"], at("2024-01-05 00:00:00")).collect()) == 2


def test_ready_and_reset(spark):
    vols = volumes(spark, [(v, "2024-01-01 00:00:00", "completed", True) for v in "abcd"])
    made = products(spark, [
        ("a", "image", "completed", "2024-01-01 01:00:00"), ("b", "image", "failed", "2024-01-01 01:00:00"),
        ("c", "image", "processing", "2024-01-01 01:00:00"),
    ])
    ready = ledger.ready_for_products(vols, made, "image").collect()
    assert {r.volume_id for r in ready} == {"b", "d"}
    (reset,) = ledger.reset_products(made, vols, at("2024-01-02 00:00:00")).collect()
    assert (reset.volume_id, reset.status, reset.generated_ts) == ("a", "pending", None)


def test_stuck_uses_the_given_now(spark):
    vols = volumes(spark, [("a", "2024-01-01 00:00:00", "processing", True), ("b", "2024-01-01 00:50:00", "processing", True)])
    now = at("2024-01-01 01:00:00")
    assert [r.volume_id for r in ledger.stuck(vols, now, 30).collect()] == ["a"]
    (row,) = ledger.reset_stuck(vols, now, 30).collect()
    assert row.status == "pending" and str(row.updated_ts) == "2024-01-01 01:00:00"


def test_resume_point_is_the_oldest_of_the_newest(spark):
    log = files(spark, [(1, "DBZH", "2024-01-02 00:00:00", "completed", None), (2, "ZDR", "2024-01-03 00:00:00", "failed", None)])
    other = log.withColumns({"vol_nr": F.lit("02"), "obs_ts": at("2024-01-05 00:00:00"), "status": F.lit("completed")})
    (row,) = ledger.resume_point(log.unionByName(other), at("2023-01-01 00:00:00")).collect()
    assert str(row.resume_ts) == "2024-01-01 23:00:00"
    (row,) = ledger.resume_point(log.filter(F.col("status") == "failed"), at("2023-01-01 00:00:00")).collect()
    assert str(row.resume_ts) == "2023-01-01 00:00:00"


def test_nearest_slot_prefers_earlier_offsets(spark):
    log = files(spark, [
        (1, "DBZH", "2024-01-01 00:05:00", "completed", None), (2, "DBZH", "2023-12-31 23:55:00", "completed", None),
        (3, "DBZH", "2024-01-01 02:00:00", "completed", None),
    ])
    targets = stamped(inline_table(spark, ("radar", "strategy", "vol_nr", "target_ts"), [("RAD1", "0315", "01", "2024-01-01 00:00:00")]), "target_ts")
    (row,) = ledger.nearest_complete_slot(targets, log, ["DBZH"]).collect()
    assert row.offset_min == 5
    assert ledger.nearest_complete_slot(targets, log, ["DBZH", "ZDR"]).collect() == []


def test_retry_gives_up_after_the_limit(spark):
    log = files(spark, [(1, "ZDR", "2024-01-01 00:00:00", "failed", None)]).withColumn("retry_count", F.lit(2))
    open_volumes = volumes(spark, [("a", "2024-01-01 00:00:00", "pending", False)]).withColumns({
        "missing": F.array(F.lit("ZDR"), F.lit("KDP")), "sample": F.lit("RAD1_0315_01_DBZH_2024-01-01.BUFR"),
    })
    rows = {r.field: (r.attempts, r.give_up, r.next_attempt) for r in ledger.retry_exhausted(open_volumes, log, 2).collect()}
    assert rows == {"ZDR": (2, True, None), "KDP": (0, False, 1)}


def test_no_status_counts_as_active(spark):
    log = files(spark, [(1, "DBZH", "2024-01-01 00:00:00", "completed", None), (2, "ZDR", "2024-01-01 00:00:00", "completed", "active")])
    rows = {r.kind: r.active for r in ledger.cleanup_stats(log, volumes(spark, [("a", "2024-01-01 00:00:00", "x", True)])).collect()}
    assert rows == {"file": 2, "volume": 1}


def test_order_is_carried_across_segments(spark):
    """Random arrivals over days with nulls, ties and empty hours, against a plain loop."""
    rng = random.Random(9)
    rows = [(i, rng.choice(["A", "A", "A", None]), rng.choice([None, *range(50)]), rng.choice([0, 10, 3599, 3600, 90_000, rng.randrange(200_000)])) for i in range(400)]
    frame = spark.createDataFrame(rows, "id long, k string, v long, at long").withColumn("at", F.timestamp_seconds("at")).repartition(5)
    got = {r.id: (r.previous, r.is_first) for r in ledger.with_previous(frame, ["k"], "v", F.col("at"), ["at", "id"]).collect()}
    expected, last = {}, {}
    for i, k, v, at in sorted(rows, key=lambda r: (r[3], r[0])):
        expected[i] = (last.get(k), k not in last)
        last[k] = v
    assert got == expected


def test_profile_exchanges_the_log_once(spark, sf):
    """A key that holds a third of the rows is ordered by hours; the log itself moves a single time."""
    plan = ledger.arrival_profile(tables.arrivals(spark, sf))
    plan.collect()
    text = str(plan._jdf.queryExecution().executedPlan()).split("== Initial Plan ==")[0]
    windows = [line for line in text.splitlines() if "Window" in line and "lag" in line]
    assert windows and all("__segment" in line or "__of" in line for line in windows)
    assert text.count("Scan parquet") - text.count("ReusedExchange") <= 2

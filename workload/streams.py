"""Streaming queries: each drains its input and reads the stored result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from echolattice.operators import ledger, volumes
from echolattice.plans import products
from echolattice.sources import gate_store
from echolattice.streaming import incomplete
from echolattice.streaming import ledger as live
from echolattice.streaming import products as live_products
from echolattice.streaming import runner
from workload import detection, grids, tables
from workload.ledger import seconds
from workload.registry import TWINS, register
from workload.sources import folder
from workload.sqltables import query

LONG = "40 days"


def events_stream(spark, sf):
    """The events table as a stream of files."""
    schema = tables.read(spark, sf, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return tables.arrivals_from(reader.parquet(sf))


# --- fixed values: batches of the staged streams ---------------------------
BY_TIME = "CASE WHEN created_ts < '2024-01-11' THEN 0 WHEN created_ts < '2024-01-21' THEN 1 ELSE 2 END"
BY_EVENT = "CAST(event_id % 3 AS INT)"


#: Files of a batch.
FILES = 4


def staged_stream(spark, sf, stage: str = BY_TIME):
    """The same arrivals in three batches, by time of arrival unless told otherwise."""
    path = folder(spark, "arrivals")
    log = tables.arrivals(spark, sf)
    for batch in range(3):
        log.filter(F.expr(stage) == batch).repartition(FILES).write.mode("append").parquet(path)
    return spark.readStream.schema(log.schema).option("maxFilesPerTrigger", FILES).parquet(path)


@register("stream_dedup", query(("arrivals",), "SELECT DISTINCT filename, radar, field FROM arrivals"))
def stream_dedup(spark, sf):
    """Copies and first arrivals come in several batches, in no order of observation."""
    path = folder(spark, "dedup")
    arrivals = staged_stream(spark, sf, BY_EVENT).select("filename", "radar", "field", "obs_ts")
    runner.drain(arrivals, live.dedup_sink(f"{path}/files"), f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/files").select("filename", "radar", "field")


_SETS = """SELECT radar, vol_nr, obs_s, array_to_string(downloaded, ',') AS downloaded,
    downloaded = list_sort(['DBZH','DBZV','ZDR','RHOHV','KDP']) AS is_complete
    FROM (SELECT radar, vol_nr, obs_s, list_sort(list_distinct(list(field))) AS downloaded FROM arrivals
          WHERE status = 'completed' GROUP BY ALL) q"""


def _set_row(df):
    return df.select("radar", "vol_nr", seconds("obs"), F.array_join("downloaded", ",").alias("downloaded"), "is_complete")


@register("stream_volumes", query(("arrivals",), _SETS))
def stream_volumes(spark, sf):
    catalogue = ledger.catalogue_table(tables.read(spark, sf, "events"), {"0315": {"01": tables.EXPECTED, "02": tables.EXPECTED}})
    sets = live.stream_volumes(staged_stream(spark, sf), catalogue, LONG)
    rows = runner.collected(spark, sets, folder(spark, "volumes"), "update")
    return _set_row(runner.latest_state(rows, list(live.VOLUME)))


@register("stream_volume_kinds", query(("arrivals",), """SELECT radar, vol_nr, obs_s, array_to_string(downloaded, ',') AS downloaded,
    downloaded = CASE vol_nr WHEN '01' THEN ['DBZH','DBZV','KDP','RHOHV','ZDR'] ELSE ['DBZH','ZDR'] END AS is_complete
    FROM (SELECT radar, vol_nr, obs_s, list_sort(list_distinct(list(field))) AS downloaded FROM arrivals
          WHERE status = 'completed' GROUP BY ALL) q"""))  # fmt: skip
def stream_volume_kinds(spark, sf):
    """Volumes of the second kind have two fields only."""
    catalogue = ledger.catalogue_table(tables.read(spark, sf, "events"), {"0315": {"01": tables.EXPECTED, "02": ["DBZH", "ZDR"]}})
    sets = live.stream_volumes(staged_stream(spark, sf, BY_EVENT), catalogue, LONG)
    rows = runner.collected(spark, sets, folder(spark, "kinds"), "update")
    return _set_row(runner.latest_state(rows, list(live.VOLUME)))


@register("stream_incomplete_timeout", query(("arrivals",), """SELECT radar, vol_nr, obs_s, array_to_string(downloaded, ',') AS downloaded,
    CAST(len(list_filter(failed, lambda f: NOT list_contains(downloaded, f))) AS INT) AS attempts,
    list_has_all(downloaded, ['DBZH','DBZV','ZDR','RHOHV','KDP']) AS is_complete
    FROM (SELECT radar, vol_nr, obs_s, coalesce(list_sort(list(DISTINCT field) FILTER (status = 'completed')), []) AS downloaded,
                 coalesce(list(field) FILTER (status = 'failed'), []) AS failed FROM arrivals GROUP BY ALL) q"""))  # fmt: skip
def stream_incomplete_timeout(spark, sf):
    """Three batches, with a restart before the last; every volume comes out, the last ones from the state."""
    path = folder(spark, "incomplete")
    kinds = {("0315", v): tables.EXPECTED for v in ("01", "02")}
    log = tables.arrivals(spark, sf)
    with incomplete.keyed_state(spark):
        for batches in ((0, 1), (2,)):
            for batch in batches:
                log.filter(F.expr(BY_TIME) == batch).repartition(FILES).write.mode("append").parquet(f"{path}/in")
            arrivals = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", FILES).parquet(f"{path}/in")
            out = incomplete.follow_volumes(arrivals, kinds, "1 hour", max_attempts=2)
            runner.drain(out, runner.batch_table(f"{path}/out"), f"{path}/checkpoint")
    came_out = spark.read.parquet(f"{path}/out").drop("batch_id").unionByName(incomplete.still_open(spark, f"{path}/checkpoint"))
    expected = ledger.catalogue_table(log, {"0315": {"01": tables.EXPECTED, "02": tables.EXPECTED}})
    found = incomplete.outcomes(came_out, expected)
    return found.select("radar", "vol_nr", seconds("obs"), F.array_join("downloaded", ",").alias("downloaded"), "attempts", "is_complete")


#: Days after which a row of an older observation is late.
LATE_DAYS = 1


@register("stream_late_rows", query(("arrivals",), f"""
    SELECT radar, vol_nr, obs_s, array_to_string(held, ',') AS held, array_to_string(late_fields, ',') AS late_fields FROM (
      SELECT radar, strategy, vol_nr, obs_s, list_sort(list(DISTINCT field) FILTER (late AND NOT in_time)) AS late_fields,
             coalesce(list_sort(list(DISTINCT field) FILTER (in_time)), []) AS held
      FROM (SELECT radar, strategy, vol_nr, obs_s, field, bool_or(late) AS late, bool_or(NOT late) AS in_time
            FROM (SELECT a.*, coalesce(obs_s < (SELECT max(obs_s) FROM arrivals b WHERE CAST(b.event_id % 3 AS INT) < CAST(a.event_id % 3 AS INT)) - 86400*{LATE_DAYS}, false) AS late
                  FROM (SELECT *, '0315' AS strategy FROM arrivals) a) r WHERE status = 'completed' GROUP BY ALL) f GROUP BY ALL) v
    WHERE late_fields IS NOT NULL"""))  # fmt: skip
def stream_late_rows(spark, sf):
    """A stream with a real delay: what lies behind the watermark goes to a side table and opens its volumes again."""
    path = folder(spark, "late-rows")
    runner.drain(staged_stream(spark, sf, BY_EVENT), live.late_sink(path, f"{LATE_DAYS} DAYS"), f"{path}/checkpoint")
    rows, late = (spark.read.parquet(f"{path}/{name}") for name in ("rows", "late"))
    opened = live.reopened_by_late(rows, late)
    return opened.select("radar", "vol_nr", seconds("obs"), *[F.array_join(c, ",").alias(c) for c in ("held", "late_fields")])


@register("stream_slots", query(("arrivals",), """SELECT (created_s // 600)*600 AS slot_s, radar, count(*) AS files,
    count(*) FILTER (status = 'completed') AS completed FROM arrivals GROUP BY 1, 2"""))  # fmt: skip
def stream_slots(spark, sf):
    slots = live.stream_slots(staged_stream(spark, sf), LONG)
    rows = runner.collected(spark, slots, folder(spark, "slots"), "update")
    return runner.latest_state(rows, ["slot_ts", "radar"]).select(seconds("slot"), "radar", "files", "completed")


@register("stream_late_fields", query(("arrivals", "volumes", "products"), f"""
    SELECT p.volume_id, p.product_type, 'pending' AS status FROM products p JOIN volumes v USING (volume_id)
    SEMI JOIN (
      SELECT radar, strategy, vol_nr, obs_s FROM (
        SELECT a.radar, a.strategy, a.vol_nr, a.obs_s, b.batch, count(DISTINCT a.field) AS n
        FROM arrivals a JOIN (SELECT DISTINCT radar, strategy, vol_nr, obs_s, {BY_EVENT} AS batch FROM arrivals
                              WHERE status = 'completed') b
          ON b.radar = a.radar AND b.strategy = a.strategy AND b.vol_nr = a.vol_nr AND b.obs_s = a.obs_s
        WHERE a.status = 'completed' AND CAST(a.event_id % 3 AS INT) <= b.batch GROUP BY ALL) c
      GROUP BY ALL HAVING arg_min(n, batch) < 5 AND arg_max(n, batch) = 5) r
    ON r.radar = v.radar AND r.strategy = v.strategy AND r.vol_nr = v.vol_nr AND r.obs_s = v.obs_s
    WHERE p.status = 'completed'"""))  # fmt: skip
def stream_late_fields(spark, sf):
    sets = live.stream_volumes(staged_stream(spark, sf, BY_EVENT), tables.EXPECTED, LONG)
    rows = runner.collected(spark, sets, folder(spark, "late"), "update")
    volumes = tables.volumes_of(ledger.current_files(tables.arrivals(spark, sf)))
    products = tables.products_of(volumes).join(volumes.select("volume_id", *live.VOLUME), "volume_id")
    return live.reopened(rows, products).select("volume_id", "product_type", "status")


_STATE = "CASE WHEN event_id % 3 = 0 THEN 'completed' ELSE 'processing' END"
_VOLUME_ID = "radar || '_' || vol_nr || '_' || CAST(slot AS VARCHAR)"


@register("stream_stuck", query(("arrivals",), f"""SELECT volume_id, 'pending' AS status, last AS since_us FROM (
    SELECT {_VOLUME_ID} AS volume_id, CAST(epoch_us(max(created_ts)) AS BIGINT) AS last,
           arg_max({_STATE}, (created_ts, event_id)) AS state FROM arrivals GROUP BY 1) q
    WHERE state = 'processing' AND last // 1000 + 86400000 < (SELECT epoch_ms(max(created_ts)) FROM arrivals) - 3600000"""))
def stream_stuck(spark, sf):
    states = events_stream(spark, sf).select(
        F.expr(_VOLUME_ID.replace("VARCHAR", "STRING")).alias("volume_id"), "event_id",
        F.col("created_ts").alias("updated_ts"), F.expr(_STATE).alias("status"),
    )
    late = live.stream_stuck(states, "1 hour", 1440)
    return runner.collected(spark, late, folder(spark, "stuck")).drop("batch_id")


# A volume left processing by one batch is stuck if a later batch, before its next row, begins behind its timeout.
@register("stream_stuck_batches", query(("arrivals",), f"""SELECT volume_id, 'pending' AS status, last AS since_us FROM (
    WITH s AS (SELECT {_VOLUME_ID} AS volume_id, {BY_TIME} AS batch, CAST(epoch_us(max(created_ts)) AS BIGINT) AS last,
                      arg_max({_STATE}, (created_ts, event_id)) AS state FROM arrivals GROUP BY 1, 2),
    n AS (SELECT *, coalesce(lead(batch) OVER (PARTITION BY volume_id ORDER BY batch), 4) - 1 AS free FROM s),
    w AS (SELECT b AS batch, (SELECT epoch_ms(max(created_ts)) FROM arrivals WHERE {BY_TIME} < b) - 3600000 AS mark FROM (SELECT unnest([1, 2, 3]) AS b) t)
    SELECT n.* FROM n JOIN w ON w.batch = least(free, 3) WHERE state = 'processing' AND free > n.batch AND last // 1000 + 86400000 < mark) z"""))
def stream_stuck_batches(spark, sf):
    """Volumes stuck between batches, some of which move again later."""
    states = staged_stream(spark, sf).select(
        F.expr(_VOLUME_ID.replace("VARCHAR", "STRING")).alias("volume_id"), "event_id",
        F.col("created_ts").alias("updated_ts"), F.expr(_STATE).alias("status"),
    )
    late = live.stream_stuck(states, "1 hour", 1440)
    return runner.collected(spark, late, folder(spark, "stuck-batches")).drop("batch_id")


@register("stream_out_of_order", query(("arrivals",), """SELECT event_id, radar, coalesce(obs_s < lag(obs_s) OVER (
    PARTITION BY radar, obs_s // 86400, strategy, vol_nr, field ORDER BY created_ts, event_id), false) AS out_of_order
    FROM arrivals"""))  # fmt: skip
def stream_out_of_order(spark, sf):
    path = folder(spark, "order")
    runner.drain(staged_stream(spark, sf), live.order_sink(path), f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/rows").drop("batch_id")


#: Values of the day of stored gates, by which a batch finds its volumes' part of them.
DAYS = 4


def _day(df):
    return df.withColumn("obs_day", F.col("volume_id") % DAYS)


def _all_products(spark, sf):
    """Volume ids stream in as they are completed; a batch reads its days of the stored gates, grids once and stores three products."""
    path = folder(spark, "products")
    done = _day(tables.sweeps(spark, sf).select("volume_id").distinct())
    for part in (0, 1):
        done.filter(F.col("volume_id") % 2 == part).repartition(FILES).write.mode("append").parquet(f"{path}/done")
    ids = spark.readStream.schema(done.schema).option("maxFilesPerTrigger", FILES).parquet(f"{path}/done")
    pairs, name = grids.geometry(spark, sf), path.rsplit("/", 1)[1].replace("-", "_")
    gate_store.save_gates(_day(grids.placed_gates(spark, sf)), name, f"{path}/gates", grids.buckets(spark, sf), ["obs_day"], placed=True)
    lowest, sites = volumes.lowest_sweep(tables.sweeps(spark, sf)).select("volume_id", "elevation"), tables.sites(spark, sf)

    def voxels(gates):
        return products.one_gridding(gates, pairs, tables.LATTICE, *grids.SHOWN, rhohv_hole=F.col("gate") % 9 == 0)

    makers = {name: lambda v, name=name: products.products_of(v, tables.LATTICE, lowest, sites)[name] for name in ("colmax", "fields", "features")}
    sink = live_products.product_sink(spark.table(name), makers, f"{path}/out", ("volume_id", "obs_day"), prepare=voxels)
    runner.drain(ids, sink, f"{path}/checkpoint")
    return f"{path}/out"


_MADE: dict[tuple, str] = {}


def _products(spark, sf, name):
    """One stream makes all three products; each query reads its own."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MADE:
        _MADE[key] = _all_products(spark, sf)
    return live_products.stored_products(spark, _MADE[key], name)


@register("stream_products", query(("colmax",), "SELECT volume_id, iy, ix, value FROM colmax"))
def stream_products(spark, sf):
    return _products(spark, sf, "colmax").select("volume_id", "iy", "ix", "value")


@register("stream_field_products", TWINS["field_products"])
def stream_field_products(spark, sf):
    return _products(spark, sf, "fields").withColumn("value", F.round("value", 6))


@register("stream_features", TWINS["cores_and_tops"])
def stream_features(spark, sf):
    return detection.rounded(_products(spark, sf, "features"))

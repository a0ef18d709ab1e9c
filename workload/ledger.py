"""Ledger and file-scan queries over the arrival log."""

from __future__ import annotations

from pyspark.sql import functions as F

from echolattice.functions import names
from echolattice.operators import ledger
from workload import tables
from workload.registry import register
from workload.sqltables import query


AS_OF_S = "1706659200"
CATALOGUE = {"0315": {"01": tables.EXPECTED, "02": tables.EXPECTED}}
START, END = "2024-01-05 00:00:00", "2024-01-20 12:00:00"
START_S, END_S = 1704412800, 1705752000
LISTED = "list_sort(['DBZH','DBZV','ZDR','RHOHV','KDP'])"


def ts(text: str):
    return F.lit(text).cast("timestamp")


def seconds(name: str):
    return F.unix_timestamp(name + "_ts").alias(name + "_s")


def _files(spark, sf):
    return ledger.current_files(tables.arrivals(spark, sf))


def _volumes(spark, sf):
    return tables.volumes_of(_files(spark, sf))


def _products(spark, sf):
    return tables.products_of(_volumes(spark, sf))


@register("scan_tree", query(("arrivals",), f"""SELECT event_id, radar, filename, obs_s FROM arrivals
    WHERE obs_s > {START_S} AND obs_s <= {END_S} AND filename LIKE '%_DBZH_%'"""))  # fmt: skip
def scan_tree(spark, sf):
    """File paths of the tree, bounded in time, start exclusive, filtered by name."""
    paths = tables.arrivals(spark, sf).select("event_id", names.build_tree_path(F.col("filename")).alias("path"))
    parts = names.parse_tree_path(F.col("path"))
    listed = paths.select("event_id", *[c.alias(n) for n, c in parts.items()])
    found = ledger.in_range(listed, ts(START), ts(END), include_start=False)
    return found.filter(F.col("filename").contains("_DBZH_")).select("event_id", "radar", "filename", seconds("obs"))


@register("latest_file", query(("files",), f"""SELECT radar, max(filename) AS filename, obs_s FROM files f
    WHERE obs_s = (SELECT max(obs_s) FROM files g WHERE g.radar = f.radar AND obs_s <= {END_S} AND vol_nr = '01'
                   AND field = 'DBZH') AND vol_nr = '01' AND field = 'DBZH'
    GROUP BY radar, obs_s HAVING radar = 'RAD1'"""))  # fmt: skip
def latest_file(spark, sf):
    found = ledger.latest_file(_files(spark, sf), ts(END), radar="RAD1", vol_nr="01", field="DBZH")
    return found.select("radar", "filename", seconds("obs"))


@register("latest_file_per_radar", query(("files",), f"""SELECT radar, filename, obs_s FROM (
    SELECT *, row_number() OVER (PARTITION BY radar ORDER BY obs_s DESC, filename DESC) AS r
    FROM files WHERE obs_s <= {END_S}) q WHERE r = 1"""))  # fmt: skip
def latest_file_per_radar(spark, sf):
    return ledger.latest_file(_files(spark, sf), ts(END)).select("radar", "filename", seconds("obs"))


@register("files_exist", query(("arrivals", "files"), """SELECT DISTINCT a.filename, EXISTS (
    SELECT 1 FROM files f WHERE f.filename = a.filename AND f.status = 'completed') AS present FROM arrivals a"""))
def files_exist(spark, sf):
    wanted = tables.arrivals(spark, sf).select("filename").distinct()
    return ledger.files_exist(wanted, ledger.by_status(_files(spark, sf), "completed"))


@register("nearest_complete_slot", query(("arrivals",), """
    SELECT radar, strategy, vol_nr, target_s, arg_min(obs_s, rank) AS slot_s,
           CAST(arg_min(off, rank) AS INT) AS offset_min
    FROM (SELECT t.*, o.off, o.rank, target_s + o.off*60 AS obs_s
          FROM (SELECT DISTINCT radar, strategy, vol_nr, (created_s // 300)*300 AS target_s FROM arrivals) t,
               (SELECT off, CASE WHEN off = 0 THEN 0 WHEN off > 0 THEN 2*(off//5) - 1 ELSE -2*(off//5) END AS rank
                FROM (SELECT unnest(range(-30, 31, 5)) AS off) u) o) q
    SEMI JOIN (SELECT radar, strategy, vol_nr, obs_s FROM arrivals WHERE field IN ('DBZH', 'ZDR')
               GROUP BY ALL HAVING count(DISTINCT field) = 2) c USING (radar, strategy, vol_nr, obs_s)
    GROUP BY ALL"""))  # fmt: skip
def nearest_complete_slot(spark, sf):
    log = tables.arrivals(spark, sf)
    target = F.timestamp_seconds(F.floor(F.unix_timestamp("created_ts") / 300) * 300).alias("target_ts")
    targets = log.select("radar", "strategy", "vol_nr", target).distinct()
    found = ledger.nearest_complete_slot(targets, log, ["DBZH", "ZDR"])
    return found.select("radar", "strategy", "vol_nr", seconds("target"), seconds("slot"), "offset_min")


_FILE = "filename, radar, strategy, vol_nr, field, obs_s, status, retry_count, cleanup_status, event_id"


def _file_row(df):
    return df.select(
        "filename", "radar", "strategy", "vol_nr", "field", seconds("obs"), "status", "retry_count",
        "cleanup_status", "event_id",
    )


@register("current_files", query(("files",), f"SELECT {_FILE} FROM files"))
def current_files(spark, sf):
    return _file_row(_files(spark, sf))


@register("files_in_range", query(("files",), f"""SELECT {_FILE} FROM files WHERE status = 'completed'
    AND obs_s BETWEEN {START_S} AND {END_S} AND radar = 'RAD2' ORDER BY obs_s"""))  # fmt: skip
def files_in_range(spark, sf):
    found = ledger.files_in_range(_files(spark, sf), ts(START), ts(END), "RAD2")
    return _file_row(found.orderBy("obs_ts", "filename"))


@register("count_by_status", query(("files",), "SELECT status, count(*) AS files FROM files GROUP BY status"))
def count_by_status(spark, sf):
    return _files(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("files"))


@register("latest_by_radar", query(("files",), f"""SELECT {_FILE} FROM (SELECT *, row_number() OVER (
    PARTITION BY radar ORDER BY obs_s DESC, filename DESC) AS r FROM files WHERE status = 'completed') q
    WHERE r = 1"""))  # fmt: skip
def latest_by_radar(spark, sf):
    done = ledger.by_status(_files(spark, sf), "completed")
    return _file_row(ledger.latest(done, ["radar"], ("obs_ts", "filename")))


@register("latest_by_volume_nr", query(("files",), f"""SELECT {_FILE} FROM (SELECT *, row_number() OVER (
    PARTITION BY radar, vol_nr ORDER BY obs_s DESC, filename DESC) AS r FROM files WHERE status = 'completed') q
    WHERE r = 1"""))  # fmt: skip
def latest_by_volume_nr(spark, sf):
    done = ledger.by_status(_files(spark, sf), "completed")
    return _file_row(ledger.latest(done, ["radar", "vol_nr"], ("obs_ts", "filename")))


@register("resume_point", query(("files",), """SELECT radar, min(newest) - 3600 AS resume_s FROM (
    SELECT radar, vol_nr, max(obs_s) AS newest FROM files WHERE status = 'completed' GROUP BY 1, 2) q
    GROUP BY radar"""))  # fmt: skip
def resume_point(spark, sf):
    return ledger.resume_point(_files(spark, sf), ts(START)).select("radar", seconds("resume"))


_COMPLETE = f"""SELECT radar, strategy, vol_nr, obs_s, {LISTED} AS expected, downloaded,
    downloaded = {LISTED} AS is_complete,
    list_filter({LISTED}, lambda f: NOT list_contains(downloaded, f)) AS missing
    FROM (SELECT radar, strategy, vol_nr, obs_s, list_sort(list_distinct(list(field))) AS downloaded
          FROM files WHERE status = 'completed' AND obs_s >= {START_S} GROUP BY ALL) q"""


def _joined(df, *columns):
    """Field lists as text, so both engines hash them alike."""
    return df.withColumns({c: F.array_join(c, ",") for c in columns})


@register("volume_completeness", query(("files",), f"""SELECT radar, strategy, vol_nr, obs_s, is_complete,
    array_to_string(expected, ',') AS expected, array_to_string(downloaded, ',') AS downloaded,
    array_to_string(missing, ',') AS missing FROM ({_COMPLETE}) c"""))  # fmt: skip
def volume_completeness(spark, sf):
    found = ledger.volume_completeness(_files(spark, sf), CATALOGUE, start=ts(START))
    found = _joined(found, "expected", "downloaded", "missing")
    return found.select(
        "radar", "strategy", "vol_nr", seconds("obs"), "is_complete", "expected", "downloaded", "missing"
    )


@register("volume_completeness_floor", query(("files", "volumes"), f"""
    SELECT radar, strategy, vol_nr, obs_s, downloaded = {LISTED} AS is_complete
    FROM (SELECT radar, strategy, vol_nr, obs_s, list_sort(list_distinct(list(field))) AS downloaded
          FROM files f WHERE status = 'completed' AND obs_s >= greatest({START_S},
            (SELECT max(obs_s) FROM volumes v WHERE v.radar = f.radar AND v.status = 'completed'))
          GROUP BY ALL) q"""))  # fmt: skip
def volume_completeness_floor(spark, sf):
    """Only files at or after the latest registered volume of their radar."""
    files = _files(spark, sf)
    done = ledger.by_status(tables.volumes_of(files), "completed")
    floors = done.groupBy("radar").agg(F.max("obs_ts").alias("floor_ts"))
    found = ledger.volume_completeness(files, CATALOGUE, start=ts(START), floors=floors)
    return found.select("radar", "strategy", "vol_nr", seconds("obs"), "is_complete")


_VOLUME = "volume_id, radar, vol_nr, obs_s, status, is_complete, updated_s"


def _volume_row(df):
    return df.select("volume_id", "radar", "vol_nr", seconds("obs"), "status", "is_complete", seconds("updated"))


@register("unprocessed", query(("volumes",), f"SELECT {_VOLUME} FROM volumes WHERE status = 'pending' ORDER BY obs_s"))
def unprocessed(spark, sf):
    return _volume_row(ledger.unprocessed(_volumes(spark, sf)).orderBy("obs_ts"))


@register("complete_unprocessed",
          query(("volumes",), f"SELECT {_VOLUME} FROM volumes WHERE status = 'pending' AND is_complete"))
def complete_unprocessed(spark, sf):
    return _volume_row(ledger.complete_unprocessed(_volumes(spark, sf)))


@register("incomplete", query(("volumes",), f"SELECT {_VOLUME} FROM volumes WHERE NOT is_complete"))
def incomplete(spark, sf):
    return _volume_row(ledger.incomplete(_volumes(spark, sf)))


@register("volumes_by_status", query(("volumes",), f"SELECT {_VOLUME} FROM volumes WHERE status = 'failed'"))
def volumes_by_status(spark, sf):
    return _volume_row(ledger.by_status(_volumes(spark, sf), "failed"))


@register("volume_files", query(("files", "volumes"), """SELECT v.volume_id, f.filename, f.field
    FROM files f JOIN volumes v USING (radar, strategy, vol_nr, obs_s)
    WHERE f.status = 'completed' AND v.radar = 'RAD3'"""))  # fmt: skip
def volume_files(spark, sf):
    files = _files(spark, sf)
    chosen = tables.volumes_of(files).filter(F.col("radar") == "RAD3")
    return ledger.volume_files(files, chosen).select("volume_id", "filename", "field")


@register("file_volume_join", query(("files", "volumes"), """SELECT v.volume_id, f.filename, f.status AS file_status,
    v.status AS volume_status FROM files f JOIN volumes v USING (radar, strategy, vol_nr, obs_s)"""))  # fmt: skip
def file_volume_join(spark, sf):
    files = _files(spark, sf)
    volumes = tables.volumes_of(files).select("volume_id", *ledger.VOLUME_KEY, F.col("status").alias("volume_status"))
    joined = files.withColumnRenamed("status", "file_status").join(volumes, list(ledger.VOLUME_KEY))
    return joined.select("volume_id", "filename", "file_status", "volume_status")


@register("volume_product_join", query(("volumes", "products"), """SELECT v.volume_id, v.status AS volume_status,
    p.status AS product_status FROM volumes v LEFT JOIN products p
    ON p.volume_id = v.volume_id AND p.product_type = 'raw_cog'"""))  # fmt: skip
def volume_product_join(spark, sf):
    volumes = _volumes(spark, sf)
    made = tables.products_of(volumes).filter(F.col("product_type") == "raw_cog").select(
        "volume_id", F.col("status").alias("product_status")
    )
    return volumes.select("volume_id", F.col("status").alias("volume_status")).join(made, "volume_id", "left")


@register("new_files", query(("arrivals", "files"), """SELECT DISTINCT a.filename, a.radar FROM arrivals a
    WHERE NOT EXISTS (SELECT 1 FROM files f WHERE f.filename = a.filename AND f.radar = a.radar
                      AND f.status = 'completed')"""))  # fmt: skip
def new_files(spark, sf):
    listed = tables.arrivals(spark, sf).select("filename", "radar").distinct()
    return ledger.new_files(listed, _files(spark, sf))


@register("stuck", query(("volumes",), f"""SELECT {_VOLUME} FROM volumes WHERE status = 'processing'
    AND updated_s < {AS_OF_S} - 86400*5"""))  # fmt: skip
def stuck(spark, sf):
    return _volume_row(ledger.stuck(_volumes(spark, sf), ts(tables.AS_OF), 5 * 1440))


@register("stuck_products", query(("products",), f"""SELECT volume_id, product_type, updated_s FROM products
    WHERE status = 'pending' AND product_type = 'image' AND updated_s < {AS_OF_S} - 86400*5"""))  # fmt: skip
def stuck_products(spark, sf):
    """Products of one type left unfinished past the timeout (the ledger marks them pending)."""
    open_rows = _products(spark, sf).filter(F.col("product_type") == "image").withColumn(
        "status", F.when(F.col("status") == "pending", "processing").otherwise(F.col("status"))
    )
    found = ledger.stuck(open_rows, ts(tables.AS_OF), 5 * 1440)
    return found.select("volume_id", "product_type", seconds("updated"))


@register("reset_stuck", query(("volumes",), f"""SELECT volume_id, radar, vol_nr, obs_s, 'pending' AS status,
    is_complete, {AS_OF_S} AS updated_s FROM volumes WHERE status = 'processing'
    AND updated_s < {AS_OF_S} - 86400*5""").replace(f"{AS_OF_S} AS updated_s", f"CAST({AS_OF_S} AS BIGINT) AS updated_s"))  # fmt: skip
def reset_stuck(spark, sf):
    return _volume_row(ledger.reset_stuck(_volumes(spark, sf), ts(tables.AS_OF), 5 * 1440))


@register("ready_for_products", query(("volumes", "products"), """SELECT v.volume_id, v.obs_s,
    p.status AS product_status FROM volumes v LEFT JOIN products p
    ON p.volume_id = v.volume_id AND p.product_type = 'image'
    WHERE v.status = 'completed' AND (p.status IS NULL OR p.status IN ('pending', 'failed'))"""))  # fmt: skip
def ready_for_products(spark, sf):
    volumes = _volumes(spark, sf)
    ready = ledger.ready_for_products(volumes, tables.products_of(volumes), "image").orderBy("obs_ts")
    return ready.select("volume_id", seconds("obs"), "product_status")


@register("products_by_status", query(("volumes", "products"), """SELECT p.volume_id, p.error_type, v.radar, v.obs_s,
    v.stored_path FROM products p JOIN volumes v USING (volume_id)
    WHERE p.status = 'failed' AND p.product_type = 'raw_cog'"""))  # fmt: skip
def products_by_status(spark, sf):
    volumes = _volumes(spark, sf)
    found = ledger.products_by_status(tables.products_of(volumes), volumes, "failed", "raw_cog")
    return found.select("volume_id", "error_type", "radar", seconds("obs"), "stored_path")


@register("reset_products", query(("volumes", "products"), f"""SELECT volume_id, product_type, 'pending' AS status,
    CAST(NULL AS VARCHAR) AS error_type, CAST({AS_OF_S} AS BIGINT) AS updated_s FROM products
    WHERE status = 'completed' AND volume_id IN (SELECT volume_id FROM volumes WHERE is_complete
    AND status = 'pending')"""))  # fmt: skip
def reset_products(spark, sf):
    volumes = _volumes(spark, sf)
    recovered = ledger.complete_unprocessed(volumes)
    found = ledger.reset_products(tables.products_of(volumes), recovered, ts(tables.AS_OF))
    return found.select("volume_id", "product_type", "status", "error_type", seconds("updated"))


_CUTOFF = "2024-01-24 00:00:00"
_CUTOFF_S = 1706054400
_FILES_OLD = f"""SELECT f.filename, f.radar, f.obs_s, v.volume_id FROM files f
    JOIN volumes v USING (radar, strategy, vol_nr, obs_s)
    WHERE f.status = 'completed' AND (f.cleanup_status = 'active' OR f.cleanup_status IS NULL)
      AND f.obs_s < {_CUTOFF_S} AND v.status = 'completed'
      AND (SELECT count(*) FROM products p WHERE p.volume_id = v.volume_id AND p.status = 'completed'
           AND p.product_type IN ('image', 'raw_cog')) = 2"""


def _old_files(spark, sf):
    files = _files(spark, sf)
    volumes = tables.volumes_of(files)
    return ledger.files_for_cleanup(files, volumes, tables.products_of(volumes), ["image", "raw_cog"], ts(_CUTOFF))


@register("files_for_cleanup", query(("files", "volumes", "products"), _FILES_OLD))
def files_for_cleanup(spark, sf):
    return _old_files(spark, sf).select("filename", "radar", seconds("obs"), "volume_id")


@register("volumes_for_cleanup", query(("volumes", "products"), f"""SELECT volume_id, obs_s, stored_path FROM volumes v
    WHERE status = 'completed' AND stored_path IS NOT NULL AND obs_s < {_CUTOFF_S}
      AND (cleanup_status = 'active' OR cleanup_status IS NULL)
      AND (SELECT count(*) FROM products p WHERE p.volume_id = v.volume_id AND p.status = 'completed'
           AND p.product_type IN ('image', 'raw_cog')) = 2"""))  # fmt: skip
def volumes_for_cleanup(spark, sf):
    volumes = _volumes(spark, sf)
    found = ledger.volumes_for_cleanup(volumes, tables.products_of(volumes), ["image", "raw_cog"], ts(_CUTOFF))
    return found.select("volume_id", seconds("obs"), "stored_path")


@register("cleanup_plan",
          query(("files", "volumes", "products"), f"{_FILES_OLD} ORDER BY obs_s, filename LIMIT 20"))
def cleanup_plan(spark, sf):
    plan = ledger.cleanup_plan(_old_files(spark, sf), 20, "filename")
    return plan.select("filename", "radar", seconds("obs"), "volume_id")


@register("cleanup_plan_per_radar", query(("files", "volumes", "products"), f"""SELECT filename, radar, obs_s,
    volume_id, CAST(row_number() OVER (PARTITION BY radar ORDER BY obs_s, filename) AS INT) AS rank
    FROM ({_FILES_OLD}) o QUALIFY rank <= 5"""))  # fmt: skip
def cleanup_plan_per_radar(spark, sf):
    plan = ledger.cleanup_plan_per_radar(_old_files(spark, sf), 5, "filename")
    return plan.select("filename", "radar", seconds("obs"), "volume_id", "rank")


@register("cleanup_stats", query(("files", "volumes"), """SELECT kind,
    count(*) FILTER (state = 'active') AS active, count(*) FILTER (state = 'cleaned') AS cleaned,
    count(*) FILTER (state = 'cleanup_failed') AS cleanup_failed,
    count(*) FILTER (state = 'pending_cleanup') AS pending_cleanup
    FROM (SELECT 'file' AS kind, coalesce(cleanup_status, 'active') AS state FROM files UNION ALL
          SELECT 'volume', coalesce(cleanup_status, 'active') FROM volumes) q GROUP BY kind"""))  # fmt: skip
def cleanup_stats(spark, sf):
    files = _files(spark, sf)
    return ledger.cleanup_stats(files, tables.volumes_of(files))


@register("redownloadable", query(("files",), """SELECT filename, 'L2/' || radar || '/' ||
    strftime(make_timestamp(obs_s*1000000), '%Y/%m/%d/%H/%M%S') || '/' || filename AS remote_path
    FROM files WHERE cleanup_status = 'cleaned'"""))  # fmt: skip
def redownloadable(spark, sf):
    found = ledger.redownloadable(_files(spark, sf), names.build_tree_path(F.col("filename")))
    return found.select("filename", "remote_path")


@register("retry_queue", query(("files",), f"""SELECT filename, field, created_s FROM files WHERE status = 'failed'
    AND created_s > {AS_OF_S} - 86400*20 ORDER BY created_ts DESC, event_id DESC LIMIT 50"""))  # fmt: skip
def retry_queue(spark, sf):
    return ledger.retry_queue(_files(spark, sf), ts(tables.AS_OF), 20).select("filename", "field", seconds("created"))


@register("retry_exhausted", query(("files",), f"""
    SELECT w.radar, w.strategy, w.vol_nr, w.obs_s, w.field, w.filename, coalesce(f.retry_count, 0) AS attempts,
           coalesce(f.retry_count, 0) >= 2 AS give_up,
           CASE WHEN coalesce(f.retry_count, 0) < 2 THEN coalesce(f.retry_count, 0) + 1 END AS next_attempt
    FROM (SELECT radar, strategy, vol_nr, obs_s, field, radar || '_' || strategy || '_' || vol_nr || '_' || field ||
            '_' || strftime(make_timestamp(obs_s*1000000), '%Y%m%dT%H%M%SZ') || '.BUFR' AS filename
          FROM (SELECT radar, strategy, vol_nr, obs_s, unnest(missing) AS field FROM ({_COMPLETE}) c
                WHERE NOT is_complete) m) w
    LEFT JOIN files f USING (filename)"""))  # fmt: skip
def retry_exhausted(spark, sf):
    files = _files(spark, sf)
    volumes = ledger.volume_completeness(files, CATALOGUE, start=ts(START)).filter(~F.col("is_complete"))
    done = ledger.by_status(files, "completed")
    sample = done.groupBy(*ledger.VOLUME_KEY).agg(F.min("filename").alias("sample"))
    found = ledger.retry_exhausted(volumes.join(sample, list(ledger.VOLUME_KEY)), files, 2)
    return found.withColumn("obs_s", F.unix_timestamp("obs_ts")).drop("obs_ts")


_PROFILE = """SELECT event_id, radar, strftime(make_timestamp(obs_s*1000000), '%Y-%m-%d') AS obs_date, strategy,
    vol_nr, field, filename, obs_s, created_s, created_ts, created_s - obs_s AS delay_s,
    coalesce(obs_s < lag(obs_s) OVER (PARTITION BY radar, obs_s // 86400, strategy, vol_nr, field
                                      ORDER BY created_ts, event_id), false) AS out_of_order FROM arrivals"""


@register("arrival_profile", query(("arrivals",), f"""SELECT event_id, radar, obs_date, filename, delay_s,
    out_of_order FROM ({_PROFILE}) p"""))  # fmt: skip
def arrival_profile(spark, sf):
    found = ledger.arrival_profile(tables.arrivals(spark, sf))
    return found.select("event_id", "radar", "obs_date", "filename", "delay_s", "out_of_order")


@register("arrival_summary", query(("arrivals",), f"""SELECT radar, obs_date, strategy, vol_nr, field,
    count(*) AS files, count(*) FILTER (out_of_order) AS out_of_order,
    count(*) FILTER (out_of_order)*100.0::DOUBLE/count(*) AS out_of_order_percent,
    min(delay_s) AS min_delay_s, max(delay_s) AS max_delay_s, round(avg(delay_s), 6) AS avg_delay_s,
    arg_max(obs_s, created_ts) - arg_min(obs_s, created_ts) AS obs_span_s,
    max(created_s) - min(created_s) AS arrival_span_s,
    max(delay_s) - min(delay_s) > 600 AS delay_alert FROM ({_PROFILE}) p GROUP BY ALL"""))  # fmt: skip
def arrival_summary(spark, sf):
    found = ledger.arrival_summary(ledger.arrival_profile(tables.arrivals(spark, sf)))
    return found.withColumn("avg_delay_s", F.round("avg_delay_s", 6))


@register("pipeline_stats", query(("volumes",), """SELECT count(*) FILTER (status = 'completed') AS processed,
    count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'pending') AS pending,
    count(*) FILTER (NOT is_complete) AS incomplete,
    count(*) FILTER (status = 'pending' AND is_complete) AS complete_unprocessed FROM volumes"""))  # fmt: skip
def pipeline_stats(spark, sf):
    return ledger.pipeline_stats(_volumes(spark, sf))


@register("missing_rows", query(("arrivals", "files"), """SELECT filename FROM arrivals EXCEPT
    SELECT filename FROM files WHERE status = 'completed'"""))  # fmt: skip
def missing_rows(spark, sf):
    """Row form of expected minus downloaded."""
    done = ledger.by_status(_files(spark, sf), "completed").select("filename")
    return tables.arrivals(spark, sf).select("filename").distinct().exceptAll(done)

"""Queries over the ledgers of files, volumes and products.

Writes are appended events; the current state of a key is its latest event.
"Now" is always a parameter.  Newest-per-group is an aggregate (it combines
map-side), never a window over a radar, which may own a third of all files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echolattice.functions.inline import inline_table

VOLUME_KEY = ("radar", "strategy", "vol_nr", "obs_ts")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], rest: Sequence[str] | None = None) -> DataFrame:
    """The row of each key with the greatest order columns."""
    kept = [c for c in (rest or df.columns) if c not in keys]
    best = F.max_by(F.struct(*kept), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in kept])


def current_files(events: DataFrame, order: Sequence[str] = ("created_ts", "event_id")) -> DataFrame:
    """Last writer wins by file name; every column is taken from that write."""
    return latest(events, ["filename"], order)


def in_range(
    files: DataFrame, start: Column, end: Column, include_start: bool = True, include_end: bool = True
) -> DataFrame:
    """Files observed between two instants, either bound inclusive or not."""
    obs = F.col("obs_ts")
    return files.filter((obs >= start) if include_start else (obs > start)).filter(
        (obs <= end) if include_end else (obs < end)
    )


def files_in_range(files: DataFrame, start: Column, end: Column, radar: str | None = None) -> DataFrame:
    out = in_range(files.filter(F.col("status") == "completed"), start, end)
    return out if radar is None else out.filter(F.col("radar") == radar)


def latest_file(files: DataFrame, before: Column, by: Sequence[str] = ("radar",), **equal: str) -> DataFrame:
    """Newest file at or before an instant per group; ties to the greater name."""
    found = files.filter(F.col("obs_ts") <= before)
    for name, value in equal.items():
        found = found.filter(F.col(name) == value)
    return latest(found, list(by), ("obs_ts", "filename"))


def files_exist(wanted: DataFrame, files: DataFrame, on: str = "filename") -> DataFrame:
    """Each wanted path with a flag."""
    have = files.select(on).distinct().withColumn("__have", F.lit(True))
    return wanted.join(have, on, "left").withColumn("present", F.col("__have").isNotNull()).drop("__have")


def nearest_complete_slot(
    targets: DataFrame, files: DataFrame, fields: Sequence[str], max_offset: int = 30, step: int = 5
) -> DataFrame:
    """For every target the first slot near it holding all fields: 0, +step, -step, ...

    Targets have the volume key with ``target_ts``.  Offsets are unrolled on the
    target side, so the search is one equi-join.
    """
    offsets = [0]
    for minutes in range(step, max_offset + 1, step):
        offsets += [minutes, -minutes]
    complete = (
        files.filter(F.col("field").isin(list(fields)))
        .groupBy(*VOLUME_KEY)
        .agg(F.collect_set("field").alias("found"))
        .filter(F.size("found") == len(set(fields)))
        .select(*VOLUME_KEY)
    )
    tried = targets.select("*", F.posexplode(F.array(*[F.lit(o) for o in offsets])).alias("rank", "offset_min"))
    tried = tried.withColumn(
        "obs_ts", F.timestamp_seconds(F.unix_timestamp("target_ts") + F.col("offset_min") * 60)
    )
    hits = tried.join(complete, list(VOLUME_KEY), "left_semi")
    return hits.groupBy("radar", "strategy", "vol_nr", "target_ts").agg(
        F.min_by("obs_ts", "rank").alias("slot_ts"), F.min_by("offset_min", "rank").alias("offset_min")
    )


def resume_point(files: DataFrame, start: Column, buffer_minutes: int = 60) -> DataFrame:
    """Where each radar resumes: the oldest of its volumes' newest files less a buffer, else the start."""
    newest = files.groupBy("radar", "vol_nr").agg(
        F.max(F.when(F.col("status") == "completed", F.col("obs_ts"))).alias("newest")
    )
    back = newest.groupBy("radar").agg(F.min("newest").alias("oldest"))
    resumed = F.timestamp_seconds(F.unix_timestamp("oldest") - buffer_minutes * 60)
    return back.select("radar", F.coalesce(resumed, start).alias("resume_ts"))


def catalogue_table(df: DataFrame, catalogue: Mapping[str, Mapping[str, Sequence[str]]]) -> DataFrame:
    """Expected fields per (strategy, vol_nr)."""
    rows = [(s, v, ",".join(sorted(f))) for s, vols in catalogue.items() for v, f in vols.items()]
    listed = inline_table(df.sparkSession, ("strategy", "vol_nr", "fields"), rows)
    return listed.select("strategy", "vol_nr", F.split("fields", ",").alias("expected"))


def volume_completeness(
    files: DataFrame, catalogue: Mapping[str, Mapping[str, Sequence[str]]], start: Column | None = None,
    floors: DataFrame | None = None,
) -> DataFrame:
    """Expected against downloaded fields of each volume; complete iff they are equal.

    ``floors`` (radar, floor_ts) is the latest registered volume of each radar: one
    row per radar, joined, with ``start`` as the least floor.
    """
    done = files.filter(F.col("status") == "completed")
    if floors is not None:
        done = done.join(floors, "radar", "left").filter(
            F.col("floor_ts").isNull() | (F.col("obs_ts") >= F.col("floor_ts"))
        )
    if start is not None:
        done = done.filter(F.col("obs_ts") >= start)
    per_volume = done.groupBy(*VOLUME_KEY).agg(F.array_sort(F.collect_set("field")).alias("downloaded"))
    listed = per_volume.join(F.broadcast(catalogue_table(files, catalogue)), ["strategy", "vol_nr"])
    return listed.select(
        *VOLUME_KEY, "expected", "downloaded",
        (F.col("expected") == F.col("downloaded")).alias("is_complete"),
        F.array_except("expected", "downloaded").alias("missing"),
    )


def unprocessed(volumes: DataFrame) -> DataFrame:
    return volumes.filter(F.col("status") == "pending")


def complete_unprocessed(volumes: DataFrame) -> DataFrame:
    return unprocessed(volumes).filter(F.col("is_complete"))


def incomplete(volumes: DataFrame) -> DataFrame:
    return volumes.filter(~F.col("is_complete"))


def by_status(rows: DataFrame, status: str) -> DataFrame:
    return rows.filter(F.col("status") == status)


def volume_files(files: DataFrame, volumes: DataFrame) -> DataFrame:
    """Completed files of the given volumes, by the four keys of a volume."""
    done = files.filter(F.col("status") == "completed").drop("status", "cleanup_status")
    return done.join(volumes.select("volume_id", *VOLUME_KEY), list(VOLUME_KEY))


def stuck(rows: DataFrame, as_of: Column, timeout_minutes: int) -> DataFrame:
    """Rows still processing that were last touched before the timeout."""
    limit = as_of - F.expr(f"INTERVAL {timeout_minutes} MINUTES")
    return rows.filter((F.col("status") == "processing") & (F.col("updated_ts") < limit))


def reset_stuck(rows: DataFrame, as_of: Column, timeout_minutes: int) -> DataFrame:
    """New states of the stuck rows."""
    return stuck(rows, as_of, timeout_minutes).withColumns({"status": F.lit("pending"), "updated_ts": as_of})


def ready_for_products(volumes: DataFrame, products: DataFrame, product_type: str) -> DataFrame:
    """Completed volumes whose product is absent, pending or failed."""
    made = products.filter(F.col("product_type") == product_type).select(
        "volume_id", F.col("status").alias("product_status")
    )
    return (
        volumes.filter(F.col("status") == "completed")
        .join(made, "volume_id", "left")
        .filter(F.col("product_status").isNull() | F.col("product_status").isin("pending", "failed"))
    )


def products_by_status(products: DataFrame, volumes: DataFrame, status: str, product_type: str) -> DataFrame:
    chosen = products.filter((F.col("status") == status) & (F.col("product_type") == product_type))
    return chosen.join(volumes.select("volume_id", *VOLUME_KEY, "stored_path"), "volume_id")


def reset_products(products: DataFrame, recovered: DataFrame, as_of: Column) -> DataFrame:
    """Completed products of recovered volumes, pending again with their results cleared."""
    chosen = products.filter(F.col("status") == "completed").join(
        recovered.select("volume_id").distinct(), "volume_id", "left_semi"
    )
    return chosen.withColumns({
        "status": F.lit("pending"), "error_type": F.lit(None).cast("string"),
        "generated_ts": F.lit(None).cast("timestamp"), "updated_ts": as_of,
    })


def _all_made(products: DataFrame, product_types: Sequence[str]) -> DataFrame:
    made = products.filter((F.col("status") == "completed") & F.col("product_type").isin(list(product_types)))
    counted = made.groupBy("volume_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") == len(product_types)).select("volume_id")


def _in_use(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("cleanup_status").isNull() | (F.col("cleanup_status") == "active"))


def files_for_cleanup(
    files: DataFrame, volumes: DataFrame, products: DataFrame, product_types: Sequence[str], cutoff: Column
) -> DataFrame:
    """Old completed files of completed volumes all of whose listed products exist.

    The count per row of the ledger is written as one grouped count and a semi-join.
    """
    old = _in_use(files.filter((F.col("status") == "completed") & (F.col("obs_ts") < cutoff)))
    done = volumes.filter(F.col("status") == "completed").select("volume_id", *VOLUME_KEY, "stored_path")
    ready = done.join(_all_made(products, product_types), "volume_id", "left_semi")
    return old.join(ready, list(VOLUME_KEY))


def volumes_for_cleanup(
    volumes: DataFrame, products: DataFrame, product_types: Sequence[str], cutoff: Column
) -> DataFrame:
    old = _in_use(
        volumes.filter(
            (F.col("status") == "completed") & F.col("stored_path").isNotNull() & (F.col("obs_ts") < cutoff)
        )
    )
    return old.join(_all_made(products, product_types), "volume_id", "left_semi")


def cleanup_plan(rows: DataFrame, per_cycle: int, tie: str) -> DataFrame:
    """The oldest rows of a cycle."""
    return rows.orderBy("obs_ts", tie).limit(per_cycle)


def cleanup_plan_per_radar(rows: DataFrame, per_cycle: int, tie: str) -> DataFrame:
    """The oldest rows of each radar; the rank limit is applied before the shuffle."""
    order = Window.partitionBy("radar").orderBy("obs_ts", tie)
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_cycle)


def cleanup_stats(files: DataFrame, volumes: DataFrame) -> DataFrame:
    """Counts by cleanup status; no status counts as active."""
    known = ["active", "cleaned", "cleanup_failed", "pending_cleanup"]

    def counted(rows: DataFrame, kind: str) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), F.coalesce("cleanup_status", F.lit("active")).alias("state"))

    both = counted(files, "file").unionByName(counted(volumes, "volume"))
    counts = [F.count(F.when(F.col("state") == s, 1)).alias(s) for s in known]
    return both.groupBy("kind").agg(*counts)


def redownloadable(files: DataFrame, path: Column) -> DataFrame:
    return files.filter(F.col("cleanup_status") == "cleaned").withColumn("remote_path", path)


def retry_queue(files: DataFrame, as_of: Column, retention_days: int, limit: int = 50) -> DataFrame:
    """The newest failed files within retention."""
    recent = F.col("created_ts") > as_of - F.expr(f"INTERVAL {retention_days} DAYS")
    return files.filter((F.col("status") == "failed") & recent).orderBy(
        F.col("created_ts").desc(), F.col("event_id").desc()
    ).limit(limit)


def retry_exhausted(incomplete_volumes: DataFrame, files: DataFrame, max_attempts: int) -> DataFrame:
    """Missing fields of incomplete volumes: next attempt, or give up.

    ``incomplete_volumes`` has the volume key, ``missing`` and a ``sample`` file
    name whose field token is swapped to name the missing file.
    """
    wanted = incomplete_volumes.withColumn("field", F.explode("missing"))
    parts = F.split("sample", "_")
    wanted = wanted.withColumn("filename", F.concat_ws("_", parts[0], parts[1], parts[2], F.col("field"), parts[4]))
    tried = files.select("filename", F.col("retry_count").alias("attempts"))
    joined = wanted.join(tried, "filename", "left").withColumn("attempts", F.coalesce("attempts", F.lit(0)))
    give_up = F.col("attempts") >= max_attempts
    return joined.select(
        *VOLUME_KEY, "field", "filename", "attempts",
        give_up.alias("give_up"), F.when(~give_up, F.col("attempts") + 1).alias("next_attempt"),
    )


PROFILE_KEY = ("radar", "obs_date", "strategy", "vol_nr", "field")


#: Seconds of arrivals that are put in order together.
SEGMENT_SECONDS = 3600


def with_previous(
    rows: DataFrame, keys: Sequence[str], value: str, at: Column, order: Sequence[str], width_seconds: int = SEGMENT_SECONDS
) -> DataFrame:
    """Rows with ``previous`` (the value of the row before, among equal keys) and ``is_first`` (there is none).

    Order is by ``order``, whose first column rises with the time ``at``.  Time is cut into segments: rows are ordered within
    a segment of a key, and the last row of the segment before is carried over by a join,
    so no task holds more of a key than a segment, however long the log.
    """
    segment = F.floor(F.unix_timestamp(at) / width_seconds)
    within = Window.partitionBy(*keys, "__segment").orderBy(*order)
    ordered = rows.withColumn("__segment", segment).withColumns({
        "previous": F.lag(value).over(within), "__place": F.row_number().over(within), "__next": F.lead("__segment").over(within),
    })
    # One row for each segment of a key.
    last = ordered.filter(F.col("__next").isNull()).select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__segment").alias("__of"), F.col(value).alias("__value"))
    along = Window.partitionBy(*[f"__{k}" for k in keys]).orderBy("__of")
    carried = last.withColumns({"__carried": F.lag("__value").over(along), "__rank": F.row_number().over(along)})
    same = F.col("__segment") == F.col("__of")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"__{key}"))
    starts = F.col("__place") == 1
    return ordered.join(carried, same).select(
        *rows.columns, F.when(starts, F.col("__carried")).otherwise(F.col("previous")).alias("previous"),
        (starts & (F.col("__rank") == 1)).alias("is_first"),
    )


def arrival_profile(files: DataFrame, hourly: bool = False) -> DataFrame:
    """Arrival delay of every file and whether it is older than the one before it.

    Order is by arrival within a (radar, day, kind), found by segments of arrival time.
    """
    dated = files.withColumn("obs_date", F.date_format("obs_ts", "yyyy-MM-dd"))
    keys = list(PROFILE_KEY)
    if hourly:
        dated = dated.withColumn("obs_hour", F.hour("obs_ts"))
        keys.append("obs_hour")
    dated = dated.select(*keys, "event_id", "filename", "obs_ts", "created_ts")
    return with_previous(dated, keys, "obs_ts", F.col("created_ts"), ["created_ts", "event_id"]).select(
        *keys, "event_id", "filename", "obs_ts", "created_ts",
        (F.unix_timestamp("created_ts") - F.unix_timestamp("obs_ts")).alias("delay_s"),
        F.coalesce(F.col("obs_ts") < F.col("previous"), F.lit(False)).alias("out_of_order"),
    )


def arrival_summary(profile: DataFrame, keys: Sequence[str] = PROFILE_KEY, alert_seconds: int = 600) -> DataFrame:
    first_obs, last_obs = F.min_by("obs_ts", "created_ts"), F.max_by("obs_ts", "created_ts")
    delay = F.col("delay_s")
    return profile.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("files"),
        F.count(F.when(F.col("out_of_order"), 1)).alias("out_of_order"),
        (F.count(F.when(F.col("out_of_order"), 1)) * 100.0 / F.count(F.lit(1))).alias("out_of_order_percent"),
        F.min(delay).alias("min_delay_s"), F.max(delay).alias("max_delay_s"), F.avg(delay).alias("avg_delay_s"),
        (F.unix_timestamp(last_obs) - F.unix_timestamp(first_obs)).alias("obs_span_s"),
        (F.unix_timestamp(F.max("created_ts")) - F.unix_timestamp(F.min("created_ts"))).alias("arrival_span_s"),
        (F.max(delay) - F.min(delay) > alert_seconds).alias("delay_alert"),
    )


def pipeline_stats(volumes: DataFrame) -> DataFrame:
    """Counts of the states of all volumes in one pass."""

    def n(condition: Column, name: str) -> Column:
        return F.count(F.when(condition, 1)).alias(name)

    status = F.col("status")
    return volumes.agg(
        n(status == "completed", "processed"), n(status == "failed", "failed"), n(status == "pending", "pending"),
        n(~F.col("is_complete"), "incomplete"),
        n((status == "pending") & F.col("is_complete"), "complete_unprocessed"),
    )


def new_files(listed: DataFrame, files: DataFrame) -> DataFrame:
    """Listed files that are not yet completed in the ledger."""
    done = files.filter(F.col("status") == "completed").select("filename", "radar")
    return listed.join(done, ["filename", "radar"], "left_anti")

"""Source and sink queries: written by Spark, read back by Spark."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pandas as pd
from datetime import datetime

from pyspark.sql import functions as F

from echolattice.functions import names
from echolattice.functions.colours import Scale
from echolattice.operators import volumes
from echolattice.session import shared_folder
from echolattice.sources import commits, files, geometry_store, payload, sinks, strategy_xml, tree_source
from echolattice.streaming import ledger as live
from echolattice.streaming import runner
from workload import detection, grids, tables
from workload.registry import register
from workload.rasters import BLOCK
from workload.sqltables import query, table

table("tiles", ("colmax",), f"""
  SELECT volume_id, CAST(1 AS INT) AS zoom, iy, ix, value FROM colmax UNION ALL
  SELECT volume_id, factor, iy, ix, avg(value) FROM {BLOCK} b GROUP BY 1, 2, 3, 4""")


def folder(spark, name: str) -> str:
    """A new folder of the shared space for one run."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _payloads(spark, sf):
    """Sweep payloads packed from the gates: dense values, some sweeps damaged."""
    dense = volumes.uniform_gates(tables.sweeps(spark, sf), tables.gates(spark, sf), ["DBZH"])
    order = F.struct((F.col("ray") * tables.GATES + F.col("gate")).alias("at"), F.col("DBZH").alias("v"))
    packed = dense.groupBy("volume_id", "sweep").agg(F.sort_array(F.collect_list(order)).alias("cells"))
    values = F.transform("cells", lambda c: F.coalesce(c["v"], F.lit(payload.SENTINEL)))

    @F.pandas_udf("binary")
    def squeeze(column: pd.Series) -> pd.Series:
        return column.map(lambda v: zlib.compress(np.asarray(v, dtype="<f8").tobytes()))

    key = F.col("volume_id") * 7 + F.col("sweep")
    return packed.select(
        "volume_id", "sweep", F.lit(tables.RAYS).alias("nrays"),
        F.when(key % 11 == 5, 9000).when(key % 11 == 7, tables.GATES + 1).otherwise(tables.GATES).alias("ngates"),
        F.when(key % 11 == 9, F.lit(b"damaged")).otherwise(squeeze(values)).alias("payload"),
    )


_KEY = "(volume_id*7 + sweep) % 11"


@register("payload_to_gates", query(("gates",), f"""SELECT volume_id, sweep, ray, gate, DBZH AS value FROM gates
    WHERE {_KEY} NOT IN (5, 7, 9)"""))  # fmt: skip
def payload_to_gates(spark, sf):
    return payload.decoded_gates(payload.decode_sweeps(_payloads(spark, sf)))


@register("payload_rejects", query(("sweeps",), f"""SELECT volume_id, sweep, CASE {_KEY}
    WHEN 5 THEN 'more than 8400 gates' WHEN 7 THEN 'expected 1476 values, found 1440'
    ELSE 'payload does not inflate' END AS reject FROM sweeps WHERE {_KEY} IN (5, 7, 9)"""))  # fmt: skip
def payload_rejects(spark, sf):
    found = payload.decoded_rejects(payload.decode_sweeps(_payloads(spark, sf)))
    return found.withColumn("reject", F.split("reject", ":")[0])


def observed(df):
    """Volumes follow each other every ten minutes."""
    return df.withColumn("obs_ts", F.timestamp_seconds(F.lit(1704067200) + F.col("volume_id") * 600))


_OBS = "make_timestamp(CAST((1704067200 + volume_id*600)*1000000 AS BIGINT))"


@register("write_volumes", query(("gates",), f"""SELECT volume_id, radar, strftime({_OBS}, '%Y%m%d%H') AS stored_hour,
    count(*) AS gates, max(DBZH) AS max_dbz FROM gates GROUP BY ALL"""))  # fmt: skip
def write_volumes(spark, sf):
    path = folder(spark, "volumes")
    sinks.write_volumes(observed(tables.gates(spark, sf)), path)
    stored = commits.held(spark, path)
    text = [F.lpad(F.col(c).cast("string"), n, "0") for c, n in (("year", 4), ("month", 2), ("day", 2), ("hour", 2))]
    hour = F.concat(*text).alias("stored_hour")
    return stored.groupBy("volume_id", "radar", hour).agg(
        F.count(F.lit(1)).alias("gates"), F.max("DBZH").alias("max_dbz")
    )


@register("write_features", query(detection.FEATURE_TABLES, f"""SELECT volume_id, kind, intensity_dbz, altitude_m,
    lon, lat, radar, strftime({_OBS}, '%Y-%m-%dT%H:%M:%SZ') AS observed FROM (SELECT *,
    'RAD' || CAST(volume_id % 4 + 1 AS VARCHAR) AS radar FROM ({detection.FEATURES}) f) g"""))  # fmt: skip
def write_features(spark, sf):
    path = folder(spark, "features")
    ids = observed(tables.sites(spark, sf)).select(
        "volume_id", tables.radar_of(F.col("volume_id")).alias("radar"), F.lit("0315").alias("strategy"),
        F.lit("01").alias("vol_nr"), "obs_ts",
    )
    sinks.write_features(sinks.feature_collections(detection.features(spark, sf), ids), path)
    schema = """type STRING, features ARRAY<STRUCT<type STRING, geometry STRUCT<type STRING, coordinates ARRAY<DOUBLE>>,
        properties STRUCT<type STRING, intensity_dbz INT, altitude_m INT, radar_code STRING, observation_time STRING>>>"""
    stored = commits.held(spark, path, "text").select(F.from_json("value", schema).alias("c"))
    each = stored.select(F.explode("c.features").alias("f"))
    seconds = F.unix_timestamp(F.to_timestamp("f.properties.observation_time", "yyyy-MM-dd'T'HH:mm:ssX"))
    return each.select(
        F.expr("0").cast("bigint").alias("zero"), ((seconds - 1704067200) / 600).cast("bigint").alias("volume_id"),
        F.col("f.properties.type").alias("kind"), F.col("f.properties.intensity_dbz").alias("intensity_dbz"),
        F.col("f.properties.altitude_m").alias("altitude_m"),
        F.round(F.col("f.geometry.coordinates")[0], 4).alias("lon"),
        F.round(F.col("f.geometry.coordinates")[1], 4).alias("lat"),
        F.col("f.properties.radar_code").alias("radar"), F.col("f.properties.observation_time").alias("observed"),
    ).drop("zero")


@register("write_raster_tiles", query(("tiles", "colmax"), """SELECT 'COLMAX' AS product, zoom,
    CAST(iy // 16 AS INT) AS tile_y, CAST(ix // 16 AS INT) AS tile_x, volume_id, count(*) AS pixels,
    round(sum(value) + 1e-6, 4) AS total, any_value(vmin) AS vmin, any_value(vmax) AS vmax, 'th' AS scale
    FROM tiles JOIN (SELECT volume_id, min(value) AS vmin, max(value) AS vmax FROM colmax GROUP BY 1) r
    USING (volume_id) GROUP BY ALL"""))  # fmt: skip
def write_raster_tiles(spark, sf):
    path = folder(spark, "tiles")
    sinks.write_tiles(sinks.tile_table(grids.colmax(spark, sf), "COLMAX", Scale("th"), tile=16), path)
    stored = commits.held(spark, path)
    return stored.groupBy("product", "zoom", "tile_y", "tile_x", "volume_id").agg(
        F.count(F.lit(1)).alias("pixels"), F.round(F.sum("value") + 1e-6, 4).alias("total"),
        F.first("vmin").alias("vmin"), F.first("vmax").alias("vmax"), F.first("scale").alias("scale"),
    )


@register("rewrite_features", query(("gates",), """SELECT volume_id, count(*) AS features FROM gates
    WHERE DBZH > 55 AND volume_id % 3 <> 1 GROUP BY 1"""))  # fmt: skip
def rewrite_features(spark, sf):
    """Features of strong gates, written again for every third volume with none: the old ones are gone."""
    path = folder(spark, "rewritten")
    strong = tables.gates(spark, sf).filter("DBZH > 55")
    lines = strong.select(F.lit("2024-01-01").alias("day"), "volume_id", F.concat_ws(",", "sweep", "ray", "gate").alias("value"))
    commits.publish(lines, path, ("day", "volume_id"), kind="text")
    again = tables.sweeps(spark, sf).select("volume_id").distinct().filter("volume_id % 3 = 1")
    commits.publish(lines.limit(0), path, ("day", "volume_id"), again, kind="text")
    return commits.held(spark, path, "text").groupBy("volume_id").agg(F.count(F.lit(1)).alias("features"))


@register("window_read_tiles", query(("colmax",), f"""SELECT volume_id, factor AS zoom, iy, ix, round(avg(value) + 1e-8, 6) AS value
    FROM {BLOCK} b WHERE (factor = 2 AND iy BETWEEN 4 AND 15 AND ix BETWEEN 3 AND 12) OR (factor = 4 AND iy BETWEEN 2 AND 7 AND ix BETWEEN 5 AND 9)
    GROUP BY ALL"""))  # fmt: skip
def window_read_tiles(spark, sf):
    """Windows of stored tiles at two overview levels."""
    path = folder(spark, "pyramid")
    sinks.write_tiles(sinks.tile_table(grids.colmax(spark, sf), "COLMAX", Scale("th"), tile=4), path)
    found = sinks.read_window(spark, path, "COLMAX", 2, (4, 15), (3, 12), tile=4).unionByName(sinks.read_window(spark, path, "COLMAX", 4, (2, 7), (5, 9), tile=4))
    return found.select("volume_id", "zoom", "iy", "ix", F.round(F.col("value") + 1e-8, 6).alias("value"))


@register("scan_strategy_xml", query(("sweeps",), """SELECT CAST(volume_id AS VARCHAR) AS strategy_id,
    CAST(sweep AS INT) AS position, 'vol' || CAST(volume_id % 3 AS VARCHAR) AS scan_strategy,
    CASE sweep % 3 WHEN 0 THEN 'intensidad' WHEN 1 THEN 'staggered' ELSE 'otro' END AS processing,
    '6000' AS gate_length_m, CASE WHEN sweep % 3 < 2 THEN 400 + sweep END AS prp1,
    CASE WHEN sweep % 3 < 2 THEN 1000 END AS pw1, CASE WHEN sweep % 3 < 2 THEN 240 END AS max_range1,
    CASE sweep % 3 WHEN 0 THEN 32 WHEN 1 THEN 0 END AS npulses,
    CASE sweep % 3 WHEN 0 THEN 0 WHEN 1 THEN 600 + sweep END AS prp2,
    CASE sweep % 3 WHEN 0 THEN 0 WHEN 1 THEN 800 END AS pw2,
    CASE sweep % 3 WHEN 0 THEN 0 WHEN 1 THEN 180 END AS max_range2,
    CASE sweep % 3 WHEN 0 THEN 0 WHEN 1 THEN 8 END AS nsets FROM sweeps"""))  # fmt: skip
def scan_strategy_xml(spark, sf):
    path = folder(spark, "strategies")
    sweep = F.col("sweep")
    group = "<grupo pulsos=\"32\" prp_us=\"%d\" pw_ns=\"%d\" alcance_km=\"%d\"/>"
    first = F.format_string(group, 400 + sweep, F.lit(1000), F.lit(240))
    second = F.format_string(group, 600 + sweep, F.lit(800), F.lit(180))
    body = (
        F.when(sweep % 3 == 0, F.concat(F.lit('<procesamiento tipo="intensidad"><barrido>'), first))
        .when(sweep % 3 == 1, F.concat(F.lit('<procesamiento tipo="staggered"><barrido conjuntos="8">'), first, second))
        .otherwise(F.concat(F.lit('<procesamiento tipo="otro"><barrido>'), first))
    )
    one = F.struct("sweep", F.concat(body, F.lit("</barrido></procesamiento>")).alias("text"))
    per_volume = tables.sweeps(spark, sf).groupBy("volume_id").agg(F.sort_array(F.collect_list(one)).alias("parts"))
    text = F.concat(
        F.format_string('<volumen id="%d" tipo="vol%d" longitud_celda_m="6000">', "volume_id", F.col("volume_id") % 3),
        F.array_join(F.transform("parts", lambda p: p["text"]), ""),
        F.lit("</volumen>"),
    )
    per_volume.select(text.alias("value")).write.text(path)
    return strategy_xml.pulse_parameters(strategy_xml.read_strategies(spark, path))


@register("geometry_store", query(("map1", "sweeps"), """SELECT geometry_id, nz, ny, nx, toa, min_radius, pairs, gate_sum
    FROM (SELECT DISTINCT geometry_id, 6 AS nz, 41 AS ny, 41 AS nx, 15000.0::DOUBLE AS toa, '6000.0' AS min_radius
          FROM sweeps) s, (SELECT count(*) AS pairs, CAST(sum(gate_id) AS BIGINT) AS gate_sum FROM map1) m"""))
def geometry_store_(spark, sf):
    path = folder(spark, "geometry")
    ids = tables.scans(spark, sf).select("geometry_id").distinct()
    geometry_store.save_geometry(grids.build_geometry(spark, sf), geometry_store.geometry_meta(ids, tables.LATTICE), path)
    held = geometry_store.load_geometry(spark, path).groupBy("geometry_id").agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("gate_id").alias("gate_sum")
    )
    meta = geometry_store.peek_geometry(spark, path).select(
        "geometry_id", "nz", "ny", "nx", "toa", F.col("params")["min_radius"].alias("min_radius")
    )
    return meta.join(held, "geometry_id")


@register("scan_tree_files", query(("sweeps",), """SELECT radar, filename, obs_s, field FROM (
    SELECT DISTINCT 'RAD' || CAST(volume_id % 4 + 1 AS VARCHAR) AS radar, 1704067200 + volume_id*600 AS obs_s, 'DBZH' AS field,
      'RAD' || CAST(volume_id % 4 + 1 AS VARCHAR) || '_0315_01_DBZH_' ||
      strftime(make_timestamp(CAST((1704067200 + volume_id*600)*1000000 AS BIGINT)), '%Y%m%dT%H%M%SZ') || '.BUFR' AS filename
    FROM sweeps) f WHERE obs_s > 1704067200"""))  # fmt: skip
def scan_tree_files(spark, sf):
    """A file tree laid down from the volumes, then listed through the file source."""
    base = folder(spark, "L2")
    stamp = F.date_format("obs_ts", names.STAMP)
    named = observed(tables.sites(spark, sf)).select(
        F.concat(F.concat_ws("_", tables.radar_of(F.col("volume_id")), F.lit("0315_01_DBZH"), stamp), F.lit(".BUFR")).alias("name"),
        tables.radar_of(F.col("volume_id")).alias("radar"), "obs_ts",
    )
    _lay_tree(named.select(names.build_tree_path(F.col("name"), base).alias("path")))
    found = files.scan_tree(spark, base, start=datetime(2024, 1, 1), include_start=False)
    return found.select("radar", "filename", F.unix_timestamp("obs_ts").alias("obs_s"), "field")


def _lay_tree(paths) -> None:
    """Files at the given paths, made where the rows are."""

    def touch(rows):
        for row in rows:
            system, path = tree_source.file_system(row.path)
            system.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(path) as out:
                out.write(b"BUFR")

    paths.foreachPartition(touch)


@register("tree_source", query(("sweeps",), """SELECT way, radar, filename, obs_s, field FROM (
    SELECT DISTINCT 'RAD' || CAST(volume_id % 4 + 1 AS VARCHAR) AS radar, 1704067200 + volume_id*600 AS obs_s, 'DBZH' AS field,
      'RAD' || CAST(volume_id % 4 + 1 AS VARCHAR) || '_0315_01_DBZH_' ||
      strftime(make_timestamp(CAST((1704067200 + volume_id*600)*1000000 AS BIGINT)), '%Y%m%dT%H%M%SZ') || '.BUFR' AS filename
    FROM sweeps) f, (SELECT unnest(['batch', 'stream']) AS way) w
    WHERE way = 'stream' OR (obs_s >= 1704067200 + 1200 AND radar IN ('RAD1', 'RAD3'))"""))  # fmt: skip
def tree_source_(spark, sf):
    """The tree as a data source: a filtered batch, and a stream that follows it while files arrive, each name kept once."""
    base, path = folder(spark, "L2"), folder(spark, "tree")
    stamp = F.date_format("obs_ts", names.STAMP)
    named = observed(tables.sites(spark, sf)).select(
        F.concat(F.concat_ws("_", tables.radar_of(F.col("volume_id")), F.lit("0315_01_DBZH"), stamp), F.lit(".BUFR")).alias("name"), "volume_id",
    )
    tree_source.register(spark)
    stream = spark.readStream.format("radar_tree").option("buffer_minutes", 10**6).load(base)
    for part in (0, 1):
        _lay_tree(named.filter(F.col("volume_id") % 2 == part).select(names.build_tree_path(F.col("name"), base).alias("path")))
        runner.drain(stream.select("filename", "radar", "field", "obs_ts"), live.dedup_sink(f"{path}/files"), f"{path}/checkpoint")
    late = F.col("obs_ts") >= F.timestamp_seconds(F.lit(1704067200 + 1200))
    batch = spark.read.format("radar_tree").load(base).filter(late & F.col("radar").isin("RAD1", "RAD3"))
    row = ["radar", "filename", F.unix_timestamp("obs_ts").alias("obs_s"), "field"]
    kept = spark.read.parquet(f"{path}/files")
    return batch.select(F.lit("batch").alias("way"), *row).unionByName(kept.select(F.lit("stream").alias("way"), *row))

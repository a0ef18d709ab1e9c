"""Sinks: volumes, features and raster tiles as partitioned files, each a store with a commit log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from echolattice.functions.colours import Scale
from echolattice.operators.rasters import FACTORS, overviews, value_range
from echolattice.sources import commits

VOLUME_PARTITIONS = ("radar", "year", "month", "day", "hour", "volume_id")


def write_volumes(gates: DataFrame, path: str, obs_ts: str = "obs_ts", volumes: DataFrame | None = None) -> None:
    """Gate rows by radar, hour and volume.  A volume written again replaces itself; others stay.

    ``volumes`` lists what is written, if some may have no rows (here and below); :func:`commits.held` reads a store.

    Partitions are spread by volume, so a radar with a third of all rows
    is written by many tasks.
    """
    dated = gates.withColumns({
        "year": F.date_format(obs_ts, "yyyy"), "month": F.date_format(obs_ts, "MM"),
        "day": F.date_format(obs_ts, "dd"), "hour": F.date_format(obs_ts, "HH"),
    })
    ordered = dated.repartition(*VOLUME_PARTITIONS).sortWithinPartitions(*VOLUME_PARTITIONS, "gate_id")
    commits.publish(ordered, path, VOLUME_PARTITIONS, volumes, placed=True)


def feature_collections(features: DataFrame, volumes: DataFrame) -> DataFrame:
    """One feature collection per volume that has features, cores before tops.

    ``volumes`` gives ``radar``, ``strategy``, ``vol_nr`` and ``obs_ts``.  Features
    are few: they keep a least distance from each other.
    """
    placed = features.join(volumes, "volume_id")
    stamp = F.date_format("obs_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"),
        F.struct(
            F.col("kind").alias("type"), "intensity_dbz", "altitude_m",
            F.col("radar").alias("radar_code"), stamp.alias("observation_time"),
        ).alias("properties"),
    )
    order = F.struct("kind", -F.coalesce("intensity_dbz", "altitude_m"), "level_index", "label")
    per_volume = placed.groupBy("volume_id", "radar", "strategy", "vol_nr", "obs_ts").agg(
        F.sort_array(F.collect_list(F.struct(order.alias("place"), feature.alias("feature")))).alias("held")
    )
    collection = F.struct(
        F.lit("FeatureCollection").alias("type"), F.transform("held", lambda h: h["feature"]).alias("features")
    )
    name = F.concat_ws(
        "_", "radar", "strategy", "vol_nr", F.date_format("obs_ts", "yyyyMMdd'T'HHmmss'Z'"), F.lit("TOPS_CORES.geojson")
    )
    return per_volume.select(
        "volume_id", F.date_format("obs_ts", "yyyy/MM/dd").alias("folder"), name.alias("name"),
        F.to_json(collection).alias("geojson"),
    )


def write_features(collections: DataFrame, path: str, volumes: DataFrame | None = None) -> None:
    """Compact collections as text, by day and volume; a volume written again replaces itself, if by no features."""
    lines = collections.select(F.translate("folder", "/", "-").alias("day"), "volume_id", F.col("geojson").alias("value"))
    commits.publish(lines, path, ("day", "volume_id"), volumes, kind="text")


def tile_table(
    pixels: DataFrame, product: Column | str, scale: Scale, tile: int = 256,
    vmin: float | None = None, vmax: float | None = None, method: str = "average",
) -> DataFrame:
    """Full-resolution pixels (zoom 1) and their overviews, with tile indices and display metadata."""
    base = pixels.filter(F.col("value").isNotNull()).select(
        "volume_id", F.lit(1).alias("zoom"), "iy", "ix", "value"
    )
    coarse = overviews(pixels, method, FACTORS).withColumnRenamed("factor", "zoom")
    named = product if isinstance(product, Column) else F.lit(product)
    tiled = base.unionByName(coarse).withColumns({
        "product": named,
        "tile_y": F.floor(F.col("iy") / tile).cast("int"), "tile_x": F.floor(F.col("ix") / tile).cast("int"),
        "scale": F.lit(scale.name), "data_type": F.lit("raw"),
    })
    return tiled.join(value_range(pixels, vmin, vmax), "volume_id")


TILE_PARTITIONS = ("product", "volume_id", "zoom")


def morton(y: Column, x: Column) -> Column:
    """Tiles of 16-bit indices in an order in which neighbours lie near each other."""

    def spread_bits(v: Column) -> Column:
        v = v.cast("bigint").bitwiseAND(0xFFFF)
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
        return v

    return F.shiftleft(spread_bits(y), 1).bitwiseOR(spread_bits(x))


#: Bytes of a row group of stored pixels: so small that statistics of tiles tell most groups apart.
TILE_GROUP = 256 << 10


def write_tiles(tiles: DataFrame, path: str, volumes: DataFrame | None = None) -> None:
    """Pixels by product, volume and zoom, tiles in Morton order; a volume written again replaces itself, all its products, if by nothing.

    Row groups are small and their statistics tell which tiles they hold, so a window is read without the rest of its file.
    """
    ordered = tiles.repartition(*TILE_PARTITIONS).sortWithinPartitions(*TILE_PARTITIONS, morton(F.col("tile_y"), F.col("tile_x")), "iy", "ix")
    spark = tiles.sparkSession
    before = spark.conf.get("parquet.block.size", None)
    spark.conf.set("parquet.block.size", str(TILE_GROUP))
    try:
        commits.publish(ordered, path, TILE_PARTITIONS, volumes, placed=True)
    finally:
        spark.conf.unset("parquet.block.size") if before is None else spark.conf.set("parquet.block.size", before)


def read_window(
    spark: SparkSession, path: str, product: str, zoom: int, rows: tuple[int, int], cols: tuple[int, int], tile: int = 256
) -> DataFrame:
    """A rectangle (inclusive, in pixels of the zoom level) of stored tiles: folders of the product and zoom, row groups of tiles it touches."""
    stored = commits.held(spark, path).filter((F.col("product") == product) & (F.col("zoom") == zoom))
    touched = stored.filter(F.col("tile_y").between(rows[0] // tile, rows[1] // tile) & F.col("tile_x").between(cols[0] // tile, cols[1] // tile))
    return touched.filter(F.col("iy").between(*rows) & F.col("ix").between(*cols))

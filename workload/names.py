"""Name and identity queries over the arrival log's file names."""

from __future__ import annotations

from pyspark.sql import functions as F

from echolattice.config import VOLUME_TYPES
from echolattice.functions import names
from workload import tables
from workload.registry import register
from workload.sqltables import query

# Some names are bent on purpose: lower case, a part missing, a part too many.
_BENT = """CASE WHEN event_id % 17 = 0 THEN lower(filename)
  WHEN event_id % 19 = 0 THEN replace(filename, '_0315', '')
  WHEN event_id % 23 = 0 THEN replace(filename, '_0315', '_0315_X') ELSE filename END"""
RAW = r"^([A-Z0-9]+)_(\d{4})_(\d{2})_([A-Z]{2,10})_(\d{8}T\d{6}Z)\.BUFR$"
VOL = r"^([A-Z0-9]+)_(\d{4})_(\d{2})_(\d{8}T\d{6}Z)\.nc$"
PROD = r"^([A-Z0-9]+)_(\d{8}T\d{6}Z)_([A-Z0-9]+?)(o?)_(\d{2})\.tif$"


def _bent(spark, sf):
    return tables.arrivals(spark, sf).select("event_id", F.expr(_BENT).alias("name"))


def _sql_groups(column: str, pattern: str, parts: dict[str, int]) -> str:
    return ", ".join(f"nullif(regexp_extract({column}, '{pattern}', {g}, 'i'), '') AS {p}" for p, g in parts.items())


@register(
    "parse_raw_name",
    query(("arrivals",), f"""SELECT event_id, {_sql_groups('name', RAW, {'radar': 1, 'strategy': 2, 'vol_nr': 3,
          'field': 4, 'stamp': 5})} FROM (SELECT event_id, {_BENT} AS name FROM arrivals) q"""),
)
def parse_raw_name(spark, sf):
    bent = _bent(spark, sf)
    return bent.select("event_id", *[c.alias(n) for n, c in names.parse_raw_name(F.col("name")).items()])


_VOLUME_NAME = """CASE WHEN event_id % 17 = 0 THEN 'x' ELSE '' END
  || radar || '_0315_' || vol_nr || '_' || STAMP || CASE WHEN event_id % 19 = 0 THEN '.txt' ELSE '.nc' END"""
_PRODUCT_NAME = """radar || '_' || STAMP || '_' || field || CASE WHEN event_id % 2 = 0 THEN 'o' ELSE '' END
  || CASE WHEN event_id % 19 = 0 THEN '_0' ELSE '_00' END || '.tif'"""
_SPARK_STAMP = "date_format(obs_ts, \"yyyyMMdd'T'HHmmss'Z'\")"
_SQL_STAMP = "strftime(make_timestamp(obs_s*1000000), '%Y%m%dT%H%M%SZ')"


@register(
    "parse_volume_name",
    query(("arrivals",), f"""SELECT event_id, {_sql_groups('name', VOL, {'radar': 1, 'strategy': 2, 'vol_nr': 3,
          'stamp': 4})} FROM (SELECT event_id, {_VOLUME_NAME.replace('STAMP', _SQL_STAMP)} AS name FROM arrivals) q"""),
)
def parse_volume_name(spark, sf):
    named = tables.arrivals(spark, sf).withColumn("name", F.expr(_VOLUME_NAME.replace("STAMP", _SPARK_STAMP)))
    return named.select("event_id", *[c.alias(n) for n, c in names.parse_volume_name(F.col("name")).items()])


@register(
    "parse_product_name",
    query(("arrivals",), f"""SELECT event_id, {_sql_groups('name', PROD, {'radar': 1, 'stamp': 2, 'field': 3,
          'sweep': 5})}, CASE WHEN regexp_matches(name, '{PROD}', 'i')
          THEN regexp_extract(name, '{PROD}', 4, 'i') = '' END AS filtered
          FROM (SELECT event_id, {_PRODUCT_NAME.replace('STAMP', _SQL_STAMP)} AS name FROM arrivals) q"""),
)
def parse_product_name(spark, sf):
    named = tables.arrivals(spark, sf).withColumn("name", F.expr(_PRODUCT_NAME.replace("STAMP", _SPARK_STAMP)))
    return named.select("event_id", *[c.alias(n) for n, c in names.parse_product_name(F.col("name")).items()])


@register(
    "parse_raw_name_loose",
    query(("arrivals",), f"""SELECT event_id, CASE WHEN good THEN p[1] END AS radar, CASE WHEN good THEN p[2] END AS
          strategy, CASE WHEN good THEN p[3] END AS vol_nr, CASE WHEN good THEN p[4] END AS field,
          CASE WHEN good THEN name END AS filename,
          CASE WHEN NOT good THEN 'unexpected name: ' || path END AS reject
          FROM (SELECT *, len(p) = 5 AS good FROM (SELECT event_id, name, '/data/' || name AS path,
          string_split(string_split(name, '.')[1], '_') AS p
          FROM (SELECT event_id, {_BENT} AS name FROM arrivals) a) b) c"""),
)
def parse_raw_name_loose(spark, sf):
    path = _bent(spark, sf).withColumn("path", F.concat(F.lit("/data/"), "name"))
    return path.select("event_id", *[c.alias(n) for n, c in names.parse_raw_name_loose(F.col("path")).items()])


@register(
    "raw_name_matches",
    query(("arrivals",), f"""SELECT event_id, name FROM (SELECT event_id, {_BENT} AS name FROM arrivals) q
          WHERE regexp_extract(name, '{RAW}', 2, 'i') = '0315' AND regexp_extract(name, '{RAW}', 3, 'i') = '01'
            AND regexp_extract(name, '{RAW}', 4, 'i') = 'DBZH'"""),
)
def raw_name_matches(spark, sf):
    bent = _bent(spark, sf)
    parts = names.parse_raw_name(F.col("name"))
    return bent.filter(names.raw_name_matches(parts, strategy="0315", vol_nr=1, field="DBZH"))


@register(
    "volume_name_from_raw",
    query(("arrivals",), f"""SELECT event_id, name, '/store/' || radar || '/' || strftime(t, '%Y/%m/%d/%H') AS folder
          FROM (SELECT event_id, radar, make_timestamp(obs_s*1000000) AS t,
                radar || '_0315_' || vol_nr || '_' || {_SQL_STAMP} || '.nc' AS name FROM arrivals) q"""),
)
def volume_name_from_raw(spark, sf):
    named = tables.arrivals(spark, sf).select("event_id", names.volume_name_from_raw(F.col("filename")).alias("name"))
    return named.withColumn("folder", names.volume_path(F.col("name"), "/store"))


@register(
    "time_from_name",
    query(("arrivals",), """SELECT event_id, obs_s, strftime(make_timestamp(obs_s*1000000) - INTERVAL 3 HOUR,
          '%Y-%m-%d %H:%M:%S') AS local_clock FROM arrivals"""),
)
def time_from_name(spark, sf):
    name = names.volume_name_from_raw(F.col("filename"))
    local = names.time_from_name(name, utc=False)
    return tables.arrivals(spark, sf).select(
        "event_id",
        F.unix_timestamp(names.time_from_name(name)).alias("obs_s"),
        F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("local_clock"),
    )


@register(
    "build_tree_path",
    query(("arrivals",), """SELECT event_id, 'L2/' || radar || '/' || strftime(make_timestamp(obs_s*1000000),
          '%Y/%m/%d/%H/%M%S') || '/' || filename AS path FROM arrivals"""),
)
def build_tree_path(spark, sf):
    return tables.arrivals(spark, sf).select("event_id", names.build_tree_path(F.col("filename")).alias("path"))


@register(
    "parse_tree_path",
    query(("arrivals",), "SELECT event_id, radar, filename, obs_s, field FROM arrivals"),
)
def parse_tree_path(spark, sf):
    paths = tables.arrivals(spark, sf).select("event_id", names.build_tree_path(F.col("filename")).alias("path"))
    parts = names.parse_tree_path(F.col("path"))
    return paths.select(
        "event_id", parts["radar"].alias("radar"), parts["filename"].alias("filename"),
        F.unix_timestamp(parts["obs_ts"]).alias("obs_s"), parts["field"].alias("field"),
    )


@register(
    "volume_id",
    query(("arrivals",), """SELECT DISTINCT radar || '_' || strategy || '_' || vol_nr || '_' ||
          strftime(make_timestamp(obs_s*1000000), '%Y-%m-%dT%H:%M:%SZ') AS volume_id FROM arrivals"""),
)
def volume_id(spark, sf):
    key = names.volume_id(F.col("radar"), F.col("strategy"), F.col("vol_nr"), F.col("obs_ts"))
    return tables.arrivals(spark, sf).select(key.alias("volume_id")).distinct()


@register(
    "product_slot",
    query(("arrivals",), """SELECT event_id, strftime(r, '%Y/%m/%d') AS folder,
          radar || '_' || strftime(c, '%Y%m%dT%H%M00Z') || '_' || shown || '_' || num || '.tif' AS ceiled_name,
          radar || '_' || strftime(r, '%Y%m%dT%H%M00Z') || '_' || shown || '_' || num || '.tif' AS rounded_name
          FROM (SELECT event_id, radar, field || CASE WHEN event_id % 3 = 0 THEN 'o' ELSE '' END AS shown,
            lpad(CAST(event_id % 12 AS VARCHAR), 2, '0') AS num,
            make_timestamp(CAST(((created_s + 600)//600)*600000000 AS BIGINT)) AS c,
            make_timestamp(CAST(round_even((created_s//60)/10.0::DOUBLE, 0) AS BIGINT)*600000000) AS r FROM arrivals) q"""),
)
def product_slot(spark, sf):
    parts = names.product_slot(
        F.col("radar"), F.col("field"), F.col("event_id") % 12, F.col("created_ts"), F.col("event_id") % 3 != 0, "tif"
    )
    return tables.arrivals(spark, sf).select("event_id", *[c.alias(n) for n, c in parts.items()])


@register(
    "filter_volume_types",
    query(("arrivals",), """SELECT event_id, filename FROM arrivals
          WHERE strategy = '0315' AND ((vol_nr = '01' AND field IN ('DBZH','DBZV','ZDR','RHOHV','PHIDP','KDP'))
                OR (vol_nr = '02' AND field IN ('VRAD','WRAD')))"""),
)
def filter_volume_types(spark, sf):
    return names.filter_volume_types(tables.arrivals(spark, sf), VOLUME_TYPES).select("event_id", "filename")


@register(
    "geometry_key",
    query(("arrivals",), """SELECT DISTINCT radar || '_' || strategy || '_' || vol_nr ||
          '_RES12000x3000_TOA15000_HF1p0200_MR6000_MN1_NB8p00_BSP1p20_nearest_geometry' AS geometry_key
          FROM arrivals"""),
)
def geometry_key(spark, sf):
    kinds = tables.arrivals(spark, sf).select("radar", "strategy", "vol_nr").distinct()
    parameters = names.lattice_parameters(tables.LATTICE)
    parameters.update({c: F.col(c) for c in ("radar", "strategy", "vol_nr")})
    return kinds.select(names.geometry_key(parameters).alias("geometry_key"))

"""Scan strategies from XML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: element and attribute names of a strategy file ---------
SCHEMA = """
  _id STRING, _tipo STRING, _longitud_celda_m STRING,
  procesamiento ARRAY<STRUCT<_tipo STRING, barrido ARRAY<STRUCT<_conjuntos INT,
    grupo ARRAY<STRUCT<_pulsos INT, _prp_us INT, _pw_ns INT, _alcance_km INT>>>>>>
"""
ONE_PERIOD = ("intensidad", "doppler", "surv", "doppler-sfr")
TWO_PERIODS = "staggered"


def read_strategies(spark: SparkSession, path: str) -> DataFrame:
    """Volumes of strategy files; large files are split at their volume elements."""
    return (
        spark.read.format("xml").option("rowTag", "volumen").option("multiLine", "false").schema(SCHEMA).load(path)
    )


def pulse_parameters(strategies: DataFrame) -> DataFrame:
    """One row per processing of each volume.

    Processing with one repetition period fills one group of parameters, staggered
    fills two; other kinds have no pulse parameters.
    """
    each = strategies.select(
        F.col("_id").alias("strategy_id"), F.col("_tipo").alias("scan_strategy"),
        F.col("_longitud_celda_m").alias("gate_length_m"), F.posexplode("procesamiento").alias("position", "p"),
    )
    kind = F.col("p._tipo")
    scan = F.get(F.col("p.barrido"), F.lit(0))
    groups = scan["grupo"]
    one, two = F.get(groups, F.lit(0)), F.get(groups, F.lit(1))
    single, staggered = kind.isin(*ONE_PERIOD), kind == TWO_PERIODS
    known = single | staggered

    def second(name: str):
        return F.when(staggered, two[name]).when(single, 0)

    return each.select(
        "strategy_id", "position", "scan_strategy", kind.alias("processing"), "gate_length_m",
        F.when(known, one["_prp_us"]).alias("prp1"), F.when(known, one["_pw_ns"]).alias("pw1"),
        F.when(known, one["_alcance_km"]).alias("max_range1"),
        F.when(single, one["_pulsos"]).when(staggered, 0).alias("npulses"),
        second("_prp_us").alias("prp2"), second("_pw_ns").alias("pw2"), second("_alcance_km").alias("max_range2"),
        F.when(staggered, scan["_conjuntos"]).when(single, 0).alias("nsets"),
    )

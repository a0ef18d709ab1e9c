"""Small tables for the tests."""

from __future__ import annotations


def documents(spark, rows):
    """Documents over several partitions."""
    frame = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return frame.repartition(4)

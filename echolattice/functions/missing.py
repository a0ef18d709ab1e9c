"""One missing value: NULL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 100000.0


def valid_or_null(value: Column, limit: float = LIMIT) -> Column:
    """NaN, infinities and anything beyond the limit become NULL."""
    return F.when(~F.isnan(value) & (F.abs(value) <= limit), value)


def mask_invalid(df: DataFrame, fields: Iterable[str], limit: float = LIMIT) -> DataFrame:
    return df.withColumns({name: valid_or_null(F.col(name), limit) for name in fields if name in df.columns})

"""Missing values are NULL in all operators; NaN and infinities are turned into NULL where data enters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_if_nan(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def without_nan(df: DataFrame) -> DataFrame:
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: null_if_nan(F.col(c)) for c in floating})

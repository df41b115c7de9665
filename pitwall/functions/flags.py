"""Per-lap flag and row-wise helper expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def caution_flag(df: DataFrame, name: str = "track_status") -> Column:
    """0 when the track status is the clear code 1, else 1 (NULL and combined
    codes such as 12 included). Text codes are read as numbers first."""
    if name not in df.columns:
        return F.lit(1)
    dtype = df.schema[name].dataType
    col = F.col(name)
    code = col if isinstance(dtype, T.NumericType) else col.try_cast("double")
    return F.when(code == 1, F.lit(0)).otherwise(F.lit(1))


def rain_flag(df: DataFrame, candidates=("weather_rainfall", "rainfall")) -> Column:
    """Rain sample of the lap as 0/1; NULL or no rain column gives 0."""
    for name in candidates:
        if name in df.columns:
            dtype = df.schema[name].dataType
            col = F.col(name)
            if isinstance(dtype, T.StringType):
                col = col.try_cast("boolean")
            return F.coalesce(col.cast("int"), F.lit(0))
    return F.lit(0)


def is_true(cond: Column) -> Column:
    """A comparison as 0/1 where NULL counts as false."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def least_present(cols: list[Column]) -> Column:
    """Row-wise minimum skipping NULLs; NULL only when every input is NULL."""
    if not cols:
        return F.lit(None).cast("double")
    if len(cols) == 1:
        return cols[0]
    return F.least(*cols)


def normalise_nan(col: Column) -> Column:
    """Map floating NaN to NULL so aggregates treat it as missing."""
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)

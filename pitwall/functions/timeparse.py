"""Lap-time text to seconds as a single JVM-side column expression (no UDF).

Rules: numbers pass through as double; text is trimmed; '' -> NULL;
'm:ss.xxx' -> 60 * int(m) + float(ss) (minus is not spread, '-1:30' = -30);
a printed duration 'd days hh:mm:ss.ffffff' -> its seconds (days may be negative,
the rest then counts forward); other text with more than one ':' -> NULL;
anything unparsable -> NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


DURATION = r"^(-?\d+) days?(?: \+?(\d+):(\d+):(\d+(?:\.\d+)?))?$"


def _duration(c: Column) -> Column:
    days, hours, minutes, seconds = (F.regexp_extract(c, DURATION, i).try_cast("double") for i in range(1, 5))
    rest = hours * 3600 + minutes * 60 + seconds
    return days * 86400 + F.coalesce(rest, F.lit(0.0))


def text_to_seconds(col: Column | str) -> Column:
    """Parse a string column holding 'm:ss.xxx' or plain seconds."""
    c = F.trim(F.col(col) if isinstance(col, str) else col)
    parts = F.split(c, ":")
    minutes = parts.getItem(0).try_cast("bigint").cast("double")
    seconds = parts.getItem(1).try_cast("double")
    return (
        F.when(c == "", F.lit(None).cast("double"))
        .when(F.instr(c, " day") > 0, F.when(c.rlike(DURATION), _duration(c)))
        .when(
            F.instr(c, ":") > 0,
            F.when(F.size(parts) == 2, minutes * 60 + seconds),
        )
        .otherwise(c.try_cast("double"))
    )


def to_seconds(df: DataFrame, name: str) -> Column:
    """Type-directed coercion of ``df[name]`` to double seconds.

    Numeric columns are cast, string columns parsed with :func:`text_to_seconds`,
    interval columns converted through their microsecond count.
    """
    dtype = df.schema[name].dataType
    col = F.col("`" + name.replace("`", "``") + "`")
    if isinstance(dtype, T.StringType):
        return text_to_seconds(col)
    if isinstance(dtype, T.DayTimeIntervalType):
        return F.unix_micros(F.timestamp_seconds(F.lit(0)) + col) / F.lit(1_000_000.0)
    if isinstance(dtype, T.NumericType):
        return col.cast("double")
    return F.lit(None).cast("double")


def seconds_sql(expr: str) -> str:
    """The same rule written as DuckDB SQL, for oracle queries."""
    t = f"trim({expr})"
    return (
        f"(case when {t} = '' then null "
        f"when strpos({t}, ':') > 0 then "
        f"case when len(string_split({t}, ':')) = 2 then "
        f"try_cast(split_part({t}, ':', 1) as bigint) * 60.0 "
        f"+ try_cast(split_part({t}, ':', 2) as double) end "
        f"else try_cast({t} as double) end)"
    )

"""Single race measures straight from the lap log.

Each function reads only the columns of its measure and reduces the laps in one
partial aggregate per (year, round, driver, team); nothing of the other race
features is built. Values that hold for a driver whatever the team (first position,
lap-1 position, compound shares) and for the whole race (its distance) come from a
second aggregate over those few groups. Results equal the columns of the race block.
Groups with a NULL key are left out at the end, as they still define the race
distance and the driver's values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.functions import caution_flag, is_true, named, rain_flag

KEYS = ["year", "round", "driver", "team"]


def _per_team(laps: DataFrame, **measures: Column) -> DataFrame:
    race = laps.filter(F.col("session_type") == "R")
    return race.groupBy(*KEYS).agg(*[c.alias(n) for n, c in measures.items()])


def _keyed(groups: DataFrame) -> DataFrame:
    for k in KEYS:
        groups = groups.filter(F.col(k).isNotNull())
    return groups


def _driver() -> Window:
    """All teams of a driver in a race: a row per team."""
    return Window.partitionBy("year", "round", "driver")


def caution_share(laps: DataFrame) -> DataFrame:
    """Share of laps not under the clear code."""
    share = F.try_divide(F.sum(caution_flag(laps)), F.count(F.lit(1)))
    return _keyed(_per_team(laps, pct_caution_laps=share))


def rain_share(laps: DataFrame) -> DataFrame:
    """Share of laps with rain."""
    return _keyed(_per_team(laps, pct_rain_laps=F.try_divide(F.sum(rain_flag(laps)), F.count(F.lit(1)))))


def finish_flag(laps: DataFrame) -> DataFrame:
    """1 when the last lap is the race's last; the distance counts all laps."""
    last = _per_team(laps, total_laps=F.max("lap_number"))
    distance = last.groupBy("year", "round").agg(F.max("total_laps").alias("race_laps"))
    out = _keyed(last).join(distance, ["year", "round"], "left")
    return out.select(*KEYS, is_true(F.col("total_laps") == F.col("race_laps")).alias("finish_flag"))


def lap1_position(laps: DataFrame) -> DataFrame:
    """Position on lap 1."""
    first = _per_team(laps, _p=F.max(F.when(F.col("lap_number") == 1, F.col("position"))))
    return _keyed(first.select(*KEYS, F.max("_p").over(_driver()).alias("lap1_position")))


def first_last_position(laps: DataFrame) -> DataFrame:
    """The driver's first and the driver-team's last non-NULL position in lap order."""
    placed = F.when(F.col("position").isNotNull(), F.col("lap_number"))
    mark = F.struct(placed.alias("o"), F.col("position").alias("v"))
    ends = _per_team(laps, _first=F.min_by(mark, placed), _last=F.max_by(mark, placed))
    start = F.min_by(F.col("_first.v"), F.col("_first.o")).over(_driver())
    return _keyed(ends.select(*KEYS, start.alias("start_grid_race"), F.col("_last.v").alias("final_position")))


def compound_usage(laps: DataFrame, compounds: list[str]) -> DataFrame:
    """Share of a driver's numbered laps on each of ``compounds`` (lower case); NULL
    where no lap has a compound."""
    tyre, lap = F.lower("compound"), F.col("lap_number")
    counts = {f"n{i}": F.count(F.when(tyre == c, lap)) for i, c in enumerate(compounds)}
    groups = _per_team(laps, total=F.count(F.when(tyre.isNotNull(), lap)), **counts)
    total = F.sum("total").over(_driver())
    shares = [F.when(total > 0, F.sum(n).over(_driver()) / total).alias(f"pct_{c}") for n, c in zip(counts, compounds)]
    return _keyed(groups.select(*KEYS, *shares)).select(*KEYS, *[named(f"pct_{c}") for c in compounds])

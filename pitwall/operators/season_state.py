"""Season state: what inference needs of past races, kept as a small table.

One row per (year, round, driver, team): grid, final position, finish flag and best
qualifying time. The lap log is read once per race, in one aggregate over race and
qualifying laps; a race that is collected again replaces its partition only. Season
means are sums and counts over these rows, so they follow from the rows of any set of
races, and lookups of the latest season read its partitions alone and no lap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.functions import is_true, normalise_nan, to_seconds
from pitwall.operators.quali import apply_driver_aliases, driver_key, label_race, sheet_by_race, standardise_sheet

KEYS = ["year", "round", "driver", "team"]
VALUES = ["start_grid", "final_position", "finish_flag", "best_quali_time"]
DRIVER_MEANS = {"season_avg_pos_delta": "pos_change", "race_finish_pct": "finish_flag", "driver_strength": "final_position"}


def driver_race_state(
    laps: DataFrame,
    sheet: DataFrame | None = None,
    year: int | None = None,
    round_: int | None = None,
    aliases: DataFrame | None = None,
) -> DataFrame:
    """State rows of the races in ``laps``; they equal the feature table's columns."""
    race, lap = F.col("session_type") == "R", F.col("lap_number")
    placed = F.when(race & F.col("position").isNotNull(), lap)
    mark = F.struct(placed.alias("o"), F.col("position").cast("double").alias("v"))
    seconds = normalise_nan(to_seconds(laps, "lap_time"))
    groups = laps.filter(F.col("session_type").isin("R", "Q")).groupBy(*KEYS).agg(
        F.count(F.when(race, 1)).alias("_raced"),
        F.max(F.when(race, lap)).alias("_last_lap"),
        F.min_by(mark, placed).alias("_first"),
        F.max_by(mark, placed).alias("_last"),
        F.min(F.when(~race, seconds)).alias("_quali"),
    )
    distance = groups.groupBy("year", "round").agg(F.max("_last_lap").alias("_distance"))
    driver = Window.partitionBy("year", "round", "driver")  # a row per team
    rows = groups.select(
        *KEYS,
        "_raced",
        "_last_lap",
        F.min_by(F.col("_first.v"), F.col("_first.o")).over(driver).alias("_grid"),
        F.col("_last.v").alias("final_position"),
        F.min("_quali").over(driver).alias("_quali"),
    ).filter(F.col("_raced") > 0)
    for k in KEYS:
        rows = rows.filter(F.col(k).isNotNull())
    rows = rows.join(distance, ["year", "round"], "left")
    grid, quali = F.col("_grid"), F.col("_quali")
    if sheet is not None:
        std = standardise_sheet(label_race(sheet, laps, year, round_))
        if aliases is not None:
            std = apply_driver_aliases(std, aliases)
        std = std.withColumn("driver", driver_key(F.col("driver"), laps))
        rows = rows.join(sheet_by_race(std), ["year", "round", "driver"], "left")
        grid, quali = F.coalesce("sheet_grid", grid), F.coalesce(quali, "sheet_quali_time")
    finish = is_true(F.col("_last_lap") == F.col("_distance"))
    return rows.select(
        *KEYS, grid.alias("start_grid"), "final_position", finish.alias("finish_flag"), quali.alias("best_quali_time")
    )


def write_state(rows: DataFrame, path: str) -> str:
    """Adds races to the state, or replaces those in ``rows``."""
    ready = rows.select(*KEYS, *VALUES).repartition("year", "round")
    writer = ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("year", "round").parquet(path)
    return path


def read_state(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.parquet(path)
    ints = [F.col(k).cast(T.IntegerType()).alias(k) for k in ("year", "round")]
    return found.select(*ints, "driver", "team", *VALUES)


def _means(state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Season means per (year, driver) and per (year, team)."""
    moved = state.withColumn("pos_change", F.col("start_grid") - F.col("final_position"))
    by_driver = moved.groupBy("year", "driver").agg(*[F.avg(v).alias(n) for n, v in DRIVER_MEANS.items()])
    return by_driver, moved.groupBy("year", "team").agg(F.avg("final_position").alias("team_strength"))


def season_lookup(state: DataFrame) -> DataFrame:
    """Per driver of the latest season: its means, and the strength of the team of its
    first race (earliest round, then lowest team). Equals the lookup built from the
    feature table."""
    top = state.agg(F.max("year")).first()[0]  # one value; it prunes the partitions
    latest = state.filter(F.col("year") == F.lit(top)) if top is not None else state
    by_driver, by_team = _means(latest)
    first = latest.groupBy("driver").agg(F.min(F.struct("round", "team"))["team"].alias("team"))
    out = by_driver.drop("year").join(first, "driver").join(by_team.drop("year"), "team", "left")
    return out.select("driver", *DRIVER_MEANS, "team_strength")


def model_means(state: DataFrame, names: list[str]) -> dict[str, float]:
    """Means over all state rows of model inputs, season means included."""
    by_driver, by_team = _means(state)
    rows = state.join(by_driver, ["year", "driver"], "left").join(by_team, ["year", "team"], "left")
    return rows.agg(*[F.avg(F.col(n).cast("double")).alias(n) for n in names]).first().asDict()

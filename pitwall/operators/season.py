"""Season-level trends and lookups at driver-race grain.

Season means are aggregates joined back,
not windows over (year, team): a team-season can hold a large share of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.functions import named
from pitwall.operators.joins import join_small


def season_trends(features: DataFrame, prior_only: bool = False) -> DataFrame:
    """Add season_avg_pos_delta, driver_strength, race_finish_pct (per year,
    driver) and team_strength (per year, team).

    ``prior_only`` restricts each mean to earlier rounds of the season (no
    look-ahead): per-round sums, a running window with one row per round,
    joined back.
    """
    kept = [named(c) for c in features.columns]
    if prior_only:
        out = _prior_means(
            features, ["year", "driver"],
            {"season_avg_pos_delta": "pos_change", "driver_strength": "final_position",
             "race_finish_pct": "finish_flag"},
        )
        out = _prior_means(out, ["year", "team"], {"team_strength": "final_position"})
        return out.select(
            *kept,
            "season_avg_pos_delta", "driver_strength", "race_finish_pct", "team_strength",
        )
    by_driver = features.groupBy("year", "driver").agg(
        F.avg("pos_change").alias("season_avg_pos_delta"),
        F.avg("final_position").alias("driver_strength"),
        F.avg("finish_flag").alias("race_finish_pct"),
    )
    by_team = features.groupBy("year", "team").agg(
        F.avg("final_position").alias("team_strength")
    )
    out = join_small(features, by_driver, ["year", "driver"], "left")
    out = join_small(out, by_team, ["year", "team"], "left")
    return out.select(
        *kept,
        "season_avg_pos_delta",
        "driver_strength",
        "race_finish_pct",
        "team_strength",
    )


def _prior_means(features: DataFrame, key: list[str], outputs: dict[str, str]) -> DataFrame:
    """Mean of each source column over the rows of earlier rounds of the same
    (season, key). Rows are first summed per round, so the running window
    holds one row per round, then joined back by (key, round)."""
    sources = sorted(set(outputs.values()))
    per_round = features.groupBy(*key, "round").agg(
        *[F.sum(c).alias(f"_s_{c}") for c in sources],
        *[F.count(c).alias(f"_n_{c}") for c in sources],
    )
    earlier = Window.partitionBy(*key).orderBy("round").rowsBetween(Window.unboundedPreceding, -1)
    prior = per_round.select(
        *key,
        "round",
        *[
            F.try_divide(F.sum(f"_s_{src}").over(earlier), F.sum(f"_n_{src}").over(earlier)).alias(name)
            for name, src in outputs.items()
        ],
    )
    return join_small(features, prior, [*key, "round"], "left")


def latest_season(features: DataFrame) -> DataFrame:
    """Rows of the latest year (scalar max(year) subquery, broadcast semi join)."""
    top = features.agg(F.max("year").alias("year"))
    return features.join(F.broadcast(top), ["year"], "left_semi")


def season_lookup(features: DataFrame) -> DataFrame:
    """Per driver of the latest season: mean season_avg_pos_delta, and
    race_finish_pct / driver_strength / team_strength of the driver's first
    row (earliest round, then lowest team) of that season."""
    latest = latest_season(features)
    first_key = F.struct(F.col("round"), F.col("team"))
    cols = {}
    for c in ("race_finish_pct", "driver_strength", "team_strength"):
        if c in features.columns:
            cols[c] = F.min_by(F.col(c), first_key).alias(c)
    aggs = []
    if "season_avg_pos_delta" in features.columns:
        aggs.append(F.avg("season_avg_pos_delta").alias("season_avg_pos_delta"))
    aggs.extend(cols.values())
    return latest.filter(F.col("driver").isNotNull()).groupBy("driver").agg(*aggs)

"""Race-session operators: lap grain in, driver-race grain out.

Shuffle plan: every lap-grain step is keyed by
``(year, round, session_type, driver)`` (the key the lap log is already
clustered on), so the stint window and the aggregates need no further
exchange. Order-dependent work (stint changes) runs in windows over lap
blocks, so no window partition holds more than one block of a session;
everything else is a partial aggregate. Race-wide values (race distance)
are an aggregate joined back, never a window over a
whole race.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.functions import caution_flag, is_true, named, normalise_nan, rain_flag, to_seconds
from pitwall.operators.joins import join_small
from pitwall.operators.rank import prev_next

LAP_PARTITION = ["year", "round", "session_type", "driver"]
RACE_KEYS = ["year", "round", "driver"]


def race_laps(laps: DataFrame) -> DataFrame:
    """Race-session laps with lap_time coerced to seconds (NaN as NULL)."""
    r = laps.filter(F.col("session_type") == "R")
    return r.withColumn("lap_time", normalise_nan(to_seconds(r, "lap_time")))


def compound_values(race: DataFrame) -> list[str]:
    """Distinct lower-cased tyre compounds: the pivot's value list.

    Lower-casing happens before the pivot so two spellings of one compound
    become one column. Each value is an output column, so the list is as long
    as the schema must be.
    """
    rows = (
        race.select(F.lower("compound").alias("c"))
        .where(F.col("c").isNotNull())
        .distinct()
        .collect()
    )
    return sorted(r.c for r in rows)


LAP_BLOCK = 128
_NULL_LAP_BLOCK = 2**62  # laps without a number sort after every block


def with_stint_marks(race: DataFrame, block: int | None = None) -> DataFrame:
    """Order marks for stint counting, computed inside lap blocks.

    Laps are cut into blocks of ``block`` consecutive lap numbers; a window
    over (driver-session, block) gives each lap its row number ``_rn`` and,
    for every lap but the block's first, ``_chg_in`` = 1 when its compound
    differs from the previous lap's (NULL next to anything counts). A window
    partition therefore holds at most one block of laps, however long the
    session. Block boundaries are settled in :func:`stint_counts`.
    """
    block = block or LAP_BLOCK
    lap = F.col("lap_number")
    r = race.withColumn(
        "_blk", F.coalesce(F.floor(lap / F.lit(block)), F.lit(_NULL_LAP_BLOCK)).cast("long")
    )
    w = Window.partitionBy(*LAP_PARTITION, "_blk").orderBy(lap.asc_nulls_last())
    rn = F.row_number().over(w)
    prev = F.lag("compound").over(w)
    changed = F.coalesce(~(prev == F.col("compound")), F.lit(True)).cast("int")
    return r.select("*", rn.alias("_rn"), F.when(rn > 1, changed).alias("_chg_in"))


def _mark(order: Column, value: Column) -> Column:
    return F.struct(order.alias("o"), value.alias("v"))


def block_summaries(laps: DataFrame, compounds: list[str]) -> DataFrame:
    """The one lap-grain pass: per (year, round, session_type, driver, team,
    lap block) mergeable summaries.

    Lap time moments (count, mean, population variance) merge exactly into
    per-team mean and sample std; first/last marks are (order, value) structs
    merged with min_by/max_by; counts and sums add up. The stint window and
    this aggregate share the lap partition, so the laps are shuffled once.
    """
    race = race_laps(laps)
    race = race.select(
        "*",
        caution_flag(race).alias("is_caution"),
        rain_flag(race).alias("rain_lap"),
    )
    marked = with_stint_marks(race)
    lap = F.col("lap_number")
    pos, pos_ord = _position_order()
    comp = F.lower(F.col("compound"))
    rn = F.col("_rn")
    return marked.groupBy(*LAP_PARTITION, "team", "_blk").agg(
        F.count("lap_time").alias("_n"),
        F.avg("lap_time").alias("_mean"),
        F.var_pop("lap_time").alias("_vpop"),
        F.max_by(_mark(pos_ord, pos), pos_ord).alias("_lastpos"),
        F.min_by(_mark(pos_ord, pos), pos_ord).alias("_firstpos"),
        F.max("lap_number").alias("_maxlap"),
        F.count(F.lit(1)).alias("_rows"),
        F.sum("is_caution").alias("_caution"),
        F.sum("rain_lap").alias("_rain"),
        F.max(F.when(lap == 1, pos)).alias("_lap1"),
        F.count(F.when(comp.isNotNull(), lap)).alias("_comp_laps"),
        *[F.count(F.when(comp == c, lap)).alias(f"_n_{c}") for c in compounds],
        F.sum("_chg_in").alias("_inner"),
        F.min_by(_mark(rn, F.col("compound")), rn).alias("_firstc"),
        F.max_by(_mark(rn, F.col("compound")), rn).alias("_lastc"),
    )


def stint_counts(blocks: DataFrame) -> DataFrame:
    """Compound runs per driver-session (the first lap counts as a change).

    Changes inside blocks add up. Across blocks, the previous non-empty
    block comes from ``prev_next`` (a window only while a session's block
    rows fit one task, else numbering + an equi-join on index - 1): one change
    where a block's first compound differs from the previous block's last
    (NULL next to anything counts), and one for the first block. A window
    spans a session's block rows only after their count was checked.
    """
    per_block = blocks.groupBy(*LAP_PARTITION, "_blk").agg(
        F.sum("_inner").alias("_inner"),
        F.min_by("_firstc", F.col("_firstc.o")).alias("_first"),
        F.max_by("_lastc", F.col("_lastc.o")).alias("_last"),
    )
    per_block = per_block.withColumn("_lastv", F.col("_last.v"))
    joined = prev_next(per_block, LAP_PARTITION, "_blk", "_lastv", prev_name="_plast")
    edge = F.coalesce(~(F.col("_plast") == F.col("_first.v")), F.lit(True)).cast("int")
    runs = joined.select(*LAP_PARTITION, (F.coalesce(F.col("_inner"), F.lit(0)) + edge).alias("_runs"))
    return runs.groupBy(*LAP_PARTITION).agg(F.sum("_runs").alias("num_stops"))


def _position_order():
    pos = F.col("position")
    return pos, F.when(pos.isNotNull(), F.col("lap_number"))


def race_driver_team(blocks: DataFrame, compounds: list[str]) -> DataFrame:
    """Per (year, round, session_type, driver, team) race aggregates rolled up
    from :func:`block_summaries` (small: one row per block).

    Values the reference computes per driver-race regardless of team (stints,
    first position, lap-1 position, compound counts) roll up per driver-session
    and join back, so they stay exact when a driver's laps carry two teams or
    a NULL team. NULL-keyed groups are kept (they still define the race
    distance) and removed by :func:`race_features`.
    """
    team_key = [*LAP_PARTITION, "team"]
    n = F.col("_n")
    # merge lap-time moments (Chan et al.): M2 = sum(n_b var_b + n_b (mean_b - mean)^2).
    # The team mean is an aggregate of the block rows joined back null-safely
    # (no window over a whole driver-session).
    totals = blocks.groupBy(*team_key).agg(
        F.try_divide(F.sum(n * F.col("_mean")), F.sum(n)).alias("_gmean"),
    ).select(*[F.col(c).alias(f"_t_{c}") for c in team_key], "_gmean")
    cond = None
    for c in team_key:
        eq = F.col(c).eqNullSafe(F.col(f"_t_{c}"))
        cond = eq if cond is None else cond & eq
    joined = join_small(blocks, totals, cond, "left").drop(*[f"_t_{c}" for c in team_key])
    gmean = F.col("_gmean")
    moments = joined.select(
        "*",
        F.when(n > 0, n * F.col("_vpop") + n * (F.col("_mean") - gmean) ** 2).alias("_m2"),
    )
    per_team = moments.groupBy(*team_key).agg(
        F.sum("_n").alias("_cnt"),
        F.max("_gmean").alias("race_avg_lap"),
        F.sum("_m2").alias("_m2"),
        F.max_by(F.col("_lastpos.v"), F.col("_lastpos.o")).alias("final_position"),
        F.max("_maxlap").alias("total_laps"),
        F.try_divide(F.sum("_caution"), F.sum("_rows")).alias("pct_caution_laps"),
        F.try_divide(F.sum("_rain"), F.sum("_rows")).alias("pct_rain_laps"),
    )
    std = F.when(F.col("_cnt") > 1, F.sqrt(F.col("_m2") / (F.col("_cnt") - 1)))
    per_team = per_team.select(
        *team_key,
        F.when(F.col("_cnt") > 0, F.col("race_avg_lap")).alias("race_avg_lap"),
        std.alias("race_std_lap"),
        "final_position", "total_laps", "pct_caution_laps", "pct_rain_laps",
    )
    per_driver = blocks.groupBy(*LAP_PARTITION).agg(
        F.min_by(F.col("_firstpos.v"), F.col("_firstpos.o")).alias("start_grid_race"),
        F.max("_lap1").alias("lap1_position"),
        F.sum("_comp_laps").alias("compound_laps"),
        *[F.sum(named(f"_n_{c}")).alias(f"n_{c}") for c in compounds],
    )
    driver = per_driver.join(stint_counts(blocks), LAP_PARTITION, "left")
    return per_team.join(driver, LAP_PARTITION, "left").select(
        *team_key,
        "race_avg_lap",
        "race_std_lap",
        "num_stops",
        "final_position",
        "total_laps",
        "pct_caution_laps",
        "pct_rain_laps",
        "start_grid_race",
        "lap1_position",
        "compound_laps",
        *[named(f"n_{c}") for c in compounds],
    )


def race_distance(blocks: DataFrame) -> DataFrame:
    """Race distance = the highest lap number of any race lap of the race
    (from the block summaries, which keep NULL-driver and NULL-team laps)."""
    return blocks.groupBy("year", "round").agg(F.max("_maxlap").alias("race_laps"))


def race_features(base: DataFrame, compounds: list[str], dist: DataFrame) -> DataFrame:
    """Driver-race race block from :func:`race_driver_team` output and the
    race distance table (counted before it is broadcast, so it should come
    from materialised input such as the checkpointed block summaries)."""
    keyed = base.filter(F.col("driver").isNotNull() & F.col("team").isNotNull())
    for k in ("year", "round"):
        keyed = keyed.filter(F.col(k).isNotNull())
    j = join_small(keyed, dist, ["year", "round"], "left")
    total = F.col("compound_laps")
    return j.select(
        *RACE_KEYS,
        "team",
        "race_avg_lap",
        "race_std_lap",
        "num_stops",
        "final_position",
        is_true(F.col("total_laps") == F.col("race_laps")).alias("finish_flag"),
        "pct_caution_laps",
        "pct_rain_laps",
        (F.col("total_laps") / (F.col("num_stops") + 1)).alias("avg_stint_len"),
        "start_grid_race",
        "lap1_position",
        *[
            F.when(total > 0, named(f"n_{c}") / total).alias(f"pct_{c}")
            for c in compounds
        ],
    )


def race_targets(features: DataFrame) -> DataFrame:
    """winner, pos_change and lap1_pos_change from grid and positions."""
    return features.select(
        "*",
        is_true(F.col("final_position") == 1).alias("winner"),
        (F.col("start_grid") - F.col("final_position")).alias("pos_change"),
        (F.col("start_grid") - F.col("lap1_position")).alias("lap1_pos_change"),
    )

"""Driver-race feature table: laps in, one row per (year, round, driver, team).

Stages and their shuffles:
  1. lap grain -> mergeable per-block summaries: one exchange on
     (year, round, session_type, driver) shared with lap numbering; the
     block-bounded stint window and the aggregate run on it. The summaries
     are checkpointed to the shared checkpoint folder (lineage cut, survives
     executor loss); per-team / per-driver values roll up from them.
  2. quali and practice summaries: one conditional aggregate over the
     non-race laps (one scan), shuffled pre-reduced; the sheet joins by key.
  3. left joins at driver-race grain, targets, checkpoint.
  4. season means: aggregates joined back.
  5. sparse-column drop: one aggregate pass, schema decided on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.functions import named
from pitwall.operators.clean import drop_sparse_columns
from pitwall.operators.quali import (
    apply_driver_aliases,
    driver_key,
    label_race,
    session_summaries,
    sheet_by_race,
    standardise_sheet,
)
from pitwall.operators.race import (
    RACE_KEYS,
    compound_values,
    race_distance,
    block_summaries,
    race_driver_team,
    race_features,
    race_laps,
    race_targets,
)
from pitwall.operators.season import season_trends
from pitwall.session import checkpoint_dir


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the session's checkpoint folder and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def race_block(laps: DataFrame, compounds: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Race features per driver-race (finish flag, stints, positions, shares,
    compound usage); returns the frame and the compound list used."""
    if compounds is None:
        compounds = compound_values(race_laps(laps))
    blocks = materialise(block_summaries(laps, compounds))
    base = race_driver_team(blocks, compounds)
    return race_features(base, compounds, race_distance(blocks)), compounds


def assemble(
    laps: DataFrame,
    sheet: DataFrame | None = None,
    year: int | None = None,
    round_: int | None = None,
    compounds: list[str] | None = None,
    aliases: DataFrame | None = None,
) -> DataFrame:
    """Race block LEFT quali LEFT practice, start grid and targets (no trends)."""
    race, compounds = race_block(laps, compounds)
    f = race.join(session_summaries(laps), RACE_KEYS, "left")
    if sheet is not None:
        sheet_std = standardise_sheet(label_race(sheet, laps, year, round_))
        if aliases is not None:
            sheet_std = apply_driver_aliases(sheet_std, aliases)
        sheet_std = sheet_std.withColumn("driver", driver_key(F.col("driver"), laps))
        f = f.join(sheet_by_race(sheet_std), RACE_KEYS, "left")
        quali_time = F.coalesce(F.col("best_quali_time"), F.col("sheet_quali_time"))
        grid = F.coalesce(F.col("sheet_grid"), F.col("start_grid_race"))
    else:
        quali_time = F.col("best_quali_time")
        grid = F.col("start_grid_race")
    pct = [named(f"pct_{c}") for c in compounds]
    f = f.select(
        *RACE_KEYS,
        "team",
        "race_avg_lap",
        "race_std_lap",
        "num_stops",
        "final_position",
        "finish_flag",
        "pct_caution_laps",
        "pct_rain_laps",
        "avg_stint_len",
        quali_time.alias("best_quali_time"),
        "practice_avg_lap",
        "practice_std_lap",
        "practice_best_lap",
        grid.alias("start_grid"),
        *pct,
        "lap1_position",
    )
    return race_targets(f)


def driver_race_features(
    laps: DataFrame,
    sheet: DataFrame | None = None,
    year: int | None = None,
    round_: int | None = None,
    compounds: list[str] | None = None,
    prior_only: bool = False,
    drop_sparse: bool = True,
    aliases: DataFrame | None = None,
) -> DataFrame:
    """The feature table (see module docstring for the plan). ``aliases`` (name, driver)
    maps a sheet's names to the laps' driver keys."""
    f = materialise(assemble(laps, sheet, year, round_, compounds, aliases))
    f = season_trends(f, prior_only=prior_only)
    if drop_sparse:
        f = drop_sparse_columns(f)
    return f

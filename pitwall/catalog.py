"""Registered queries: one Spark callable and (where SQL can say it) one
DuckDB oracle text per operator key of the survey's inventory.

Every query reads the landed tables (through the fixture views) over their
whole extent. Doubles are rounded to 6 places on both sides so float noise of
different summation orders does not decide equality.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.functions import seconds_sql, text_to_seconds
from pitwall.operators import quali as Q
from pitwall.operators import race_measures as RM
from pitwall.operators import season_state as SS
from pitwall.operators.clean import sparse_report
from pitwall.operators.race import compound_values, race_laps
from pitwall.operators.season import season_trends
from pitwall.plans import features as FP
from pitwall.sources import fixtures as FX

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

DIGITS = 6
# Compound values of the fixture (l_returnflag lower-cased) for the oracle's
# explicit pivot columns; the Spark side discovers them from the data.
FIXTURE_COMPOUNDS = ["a", "n", "r"]


def rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f.name), DIGITS).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def round_sql(body: str, doubles: list[str]) -> str:
    if not doubles:
        return body
    rep = ", ".join(f"round({c}, {DIGITS}) as {c}" for c in doubles)
    return f"select * replace ({rep}) from ({body}) _q"


def laps_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.lap_view(spark, sf_dir)


# ---------------------------------------------------------------------------
# Shared oracle CTEs
# ---------------------------------------------------------------------------
_NN = "driver is not null and year is not null and round is not null"
_PCT = ", ".join(
    f"case when comp_laps > 0 then cast(n_{c} as double) / comp_laps end as pct_{c}"
    for c in FIXTURE_COMPOUNDS
)
_NCOUNT = ", ".join(
    f"count(case when lower(compound) = '{c}' then lap_number end) as n_{c}"
    for c in FIXTURE_COMPOUNDS
)
RACE_CTES = f"""{FX.LAPS_CTE},
r as (select *, case when track_status = 1 then 0 else 1 end as is_caution,
             coalesce(cast(rainfall as int), 0) as rain_lap
      from laps where session_type = 'R'),
rc as (select *, case when coalesce(not (lag(compound) over (partition by year, round, session_type, driver
             order by lap_number nulls last) = compound), true) then 1 else 0 end as compound_change from r),
rd as (select year, round, driver,
        cast(sum(compound_change) as bigint) as num_stops,
        arg_min(position, lap_number) filter (where position is not null and lap_number is not null) as start_grid_race,
        max(case when lap_number = 1 then position end) as lap1_position,
        count(case when compound is not null then lap_number end) as comp_laps,
        {_NCOUNT}
      from rc where {_NN} group by year, round, driver),
rt as (select year, round, driver, team,
        avg(lap_time) as race_avg_lap, stddev_samp(lap_time) as race_std_lap,
        arg_max(position, lap_number) filter (where position is not null and lap_number is not null) as final_position,
        max(lap_number) as total_laps,
        avg(is_caution) as pct_caution_laps, avg(rain_lap) as pct_rain_laps
      from r where {_NN} and team is not null group by year, round, driver, team),
rmax as (select year, round, max(lap_number) as race_laps from r group by year, round),
race as (select rt.year, rt.round, rt.driver, rt.team, race_avg_lap, race_std_lap, rd.num_stops,
         final_position, cast(coalesce(total_laps = race_laps, false) as int) as finish_flag,
         pct_caution_laps, pct_rain_laps,
         cast(total_laps as double) / (rd.num_stops + 1) as avg_stint_len,
         start_grid_race, lap1_position, {_PCT}
  from rt join rd on rt.year = rd.year and rt.round = rd.round and rt.driver = rd.driver
  left join rmax on rt.year = rmax.year and rt.round = rmax.round)"""

_T2S = {q: seconds_sql(q) for q in ("q1", "q2", "q3", "lap_time_text")}
QUALI_CTES = f"""{FX.SHEET_CTE},
qs as (select year, round, driver, min(lap_time) as best_quali_time
       from laps where session_type = 'Q' and {_NN} group by year, round, driver),
ss as (select year, round, driver, least({_T2S['q1']}, {_T2S['q2']}, {_T2S['q3']}) as best_quali_time,
              try_cast(start_grid as double) as start_grid from sheet),
qb as (select year, round, driver,
         coalesce(min(case when src = 'laps' then best_quali_time end),
                  min(case when src = 'sheet' then best_quali_time end)) as best_quali_time,
         min(case when src = 'sheet' then start_grid end) as sheet_grid
       from (select year, round, driver, best_quali_time, cast(null as double) as start_grid, 'laps' as src from qs
             union all select year, round, driver, best_quali_time, start_grid, 'sheet' from ss) u
       where {_NN} group by year, round, driver),
pr as (select year, round, driver, avg(lap_time) as practice_avg_lap,
         stddev_samp(lap_time) as practice_std_lap, min(lap_time) as practice_best_lap
       from laps where session_type in ('FP1', 'FP2', 'FP3') and {_NN} group by year, round, driver)"""

_PCT_COLS = ", ".join(f"pct_{c}" for c in FIXTURE_COMPOUNDS)
FEATURE_CTES = f"""{RACE_CTES},
{QUALI_CTES},
feat as (select race.year, race.round, race.driver, race.team, race_avg_lap, race_std_lap, num_stops,
           final_position, finish_flag, pct_caution_laps, pct_rain_laps, avg_stint_len,
           qb.best_quali_time, practice_avg_lap, practice_std_lap, practice_best_lap,
           coalesce(qb.sheet_grid, race.start_grid_race) as start_grid, {_PCT_COLS}, lap1_position
         from race left join qb on race.year = qb.year and race.round = qb.round and race.driver = qb.driver
         left join pr on race.year = pr.year and race.round = pr.round and race.driver = pr.driver),
tg as (select *, cast(coalesce(final_position = 1, false) as int) as winner,
         start_grid - final_position as pos_change, start_grid - lap1_position as lap1_pos_change from feat),
features as (select *,
         avg(pos_change) over (partition by year, driver) as season_avg_pos_delta,
         avg(final_position) over (partition by year, driver) as driver_strength,
         avg(finish_flag) over (partition by year, driver) as race_finish_pct,
         avg(final_position) over (partition by year, team) as team_strength from tg)"""

FEATURE_DOUBLES = [
    "race_avg_lap", "race_std_lap", "final_position", "pct_caution_laps", "pct_rain_laps",
    "avg_stint_len", "best_quali_time", "practice_avg_lap", "practice_std_lap",
    "practice_best_lap", "start_grid", *[f"pct_{c}" for c in FIXTURE_COMPOUNDS],
    "lap1_position", "pos_change", "lap1_pos_change", "season_avg_pos_delta",
    "driver_strength", "race_finish_pct", "team_strength",
]


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    laps = laps_of(spark, sf_dir)
    return FP.driver_race_features(laps, sheet=FX.sheet_view(laps))


def season_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The season state of all races, written and read back: lookups read no lap."""
    laps = laps_of(spark, sf_dir)
    path = SS.write_state(SS.driver_race_state(laps, FX.sheet_view(laps)), IO.new_scratch(spark, "season-state"))
    return SS.read_state(spark, path)


# ---------------------------------------------------------------------------
# Step 1: views, session filter, time parsing, best quali
# ---------------------------------------------------------------------------
@register(
    "time_to_seconds",
    round_sql(
        f"with {FX.LAPS_CTE} select year, round, session_type, driver, lap_number, lap_time_text, "
        f"{_T2S['lap_time_text']} as lap_seconds from laps",
        ["lap_seconds"],
    ),
)
def q_time_to_seconds(spark, sf_dir):
    laps = laps_of(spark, sf_dir)
    return laps.select(
        "year", "round", "session_type", "driver", "lap_number", "lap_time_text",
        text_to_seconds("lap_time_text").alias("lap_seconds"),
    )


@register(
    "session_filter",
    round_sql(
        f"with {FX.LAPS_CTE} select year, round, session_type, driver, lap_number, lap_time "
        "from laps where session_type in ('FP1', 'FP2', 'FP3')",
        ["lap_time"],
    ),
)
def q_session_filter(spark, sf_dir):
    laps = Q.session_filter(laps_of(spark, sf_dir), Q.PRACTICE_SESSIONS)
    return laps.select("year", "round", "session_type", "driver", "lap_number", "lap_time")


@register(
    "best_quali",
    round_sql(
        f"with {FX.LAPS_CTE}, {FX.SHEET_CTE} select year, round, driver, "
        f"least({_T2S['q1']}, {_T2S['q2']}, {_T2S['q3']}) as best_quali_time from sheet",
        ["best_quali_time"],
    ),
)
def q_best_quali(spark, sf_dir):
    sheet = FX.sheet_view(laps_of(spark, sf_dir))
    return sheet.select(
        "year", "round", "driver", Q.best_quali(sheet, ["q1", "q2", "q3"]).alias("best_quali_time")
    )


@register(
    "quali_sheet",
    round_sql(
        f"with {FX.LAPS_CTE}, {QUALI_CTES} select year, round, driver, best_quali_time, start_grid from ss",
        ["best_quali_time", "start_grid"],
    ),
)
def q_quali_sheet(spark, sf_dir):
    laps = laps_of(spark, sf_dir)
    return Q.standardise_sheet(Q.label_race(FX.sheet_view(laps), laps))


# ---------------------------------------------------------------------------
# Step 2: quali / practice summaries and the race block
# ---------------------------------------------------------------------------
@register(
    "quali_summary",
    round_sql(f"with {FX.LAPS_CTE}, {QUALI_CTES} select * from qs", ["best_quali_time"]),
)
def q_quali_summary(spark, sf_dir):
    return Q.quali_summary(laps_of(spark, sf_dir))


@register(
    "practice_summary",
    round_sql(
        f"with {FX.LAPS_CTE}, {QUALI_CTES} select * from pr",
        ["practice_avg_lap", "practice_std_lap", "practice_best_lap"],
    ),
)
def q_practice_summary(spark, sf_dir):
    return Q.practice_summary(laps_of(spark, sf_dir))


def _race(spark, sf_dir) -> DataFrame:
    race, _ = FP.race_block(laps_of(spark, sf_dir))
    return race


def _race_sql(cols: str, doubles: list[str]) -> str:
    return round_sql(f"with {RACE_CTES} select year, round, driver, team, {cols} from race", doubles)


@register("finish_flag", _race_sql("finish_flag", []))
def q_finish_flag(spark, sf_dir):
    return RM.finish_flag(laps_of(spark, sf_dir))


@register("stint_features", _race_sql("num_stops, avg_stint_len", ["avg_stint_len"]))
def q_stint_features(spark, sf_dir):
    return _race(spark, sf_dir).select(
        "year", "round", "driver", "team", "num_stops", "avg_stint_len"
    )


@register(
    "first_last_position",
    _race_sql("start_grid_race, final_position", ["start_grid_race", "final_position"]),
)
def q_first_last_position(spark, sf_dir):
    return RM.first_last_position(laps_of(spark, sf_dir))


@register("caution_share", _race_sql("pct_caution_laps", ["pct_caution_laps"]))
def q_caution_share(spark, sf_dir):
    return RM.caution_share(FX.lap_view(spark, sf_dir, number=False))


@register("rain_share", _race_sql("pct_rain_laps", ["pct_rain_laps"]))
def q_rain_share(spark, sf_dir):
    return RM.rain_share(FX.lap_view(spark, sf_dir, number=False))


@register("lap1_position", _race_sql("lap1_position", ["lap1_position"]))
def q_lap1_position(spark, sf_dir):
    return RM.lap1_position(laps_of(spark, sf_dir))


_RACE_SUMMARY_D = [
    "race_avg_lap", "race_std_lap", "final_position", "pct_caution_laps", "pct_rain_laps",
    "avg_stint_len",
]


@register(
    "race_summary",
    _race_sql(
        "race_avg_lap, race_std_lap, num_stops, final_position, finish_flag, "
        "pct_caution_laps, pct_rain_laps, avg_stint_len",
        _RACE_SUMMARY_D,
    ),
)
def q_race_summary(spark, sf_dir):
    return _race(spark, sf_dir).select(
        "year", "round", "driver", "team", "race_avg_lap", "race_std_lap", "num_stops",
        "final_position", "finish_flag", "pct_caution_laps", "pct_rain_laps", "avg_stint_len",
    )


@register("compound_usage", _race_sql(_PCT_COLS, [f"pct_{c}" for c in FIXTURE_COMPOUNDS]))
def q_compound_usage(spark, sf_dir):
    laps = laps_of(spark, sf_dir)
    return RM.compound_usage(laps, compound_values(race_laps(FX.lap_view(spark, sf_dir, number=False))))


# ---------------------------------------------------------------------------
# Step 3: quali union / fallback, grid, targets, trends, the feature table
# ---------------------------------------------------------------------------
@register(
    "quali_union",
    round_sql(
        f"with {FX.LAPS_CTE}, {QUALI_CTES} "
        "select year, round, driver, best_quali_time, cast(null as double) as start_grid, 'laps' as source from qs "
        "union all select year, round, driver, best_quali_time, start_grid, 'sheet' as source from ss",
        ["best_quali_time", "start_grid"],
    ),
)
def q_quali_union(spark, sf_dir):
    laps = laps_of(spark, sf_dir)
    sheet = Q.standardise_sheet(FX.sheet_view(laps))
    return Q.quali_union(Q.quali_summary(laps), sheet)


@register(
    "quali_fallback",
    round_sql(
        f"with {FX.LAPS_CTE} select year, round, driver, min(lap_time) as best_quali_time from laps "
        f"where session_type = 'Q' and {_NN} and (year, round) in "
        "(select distinct year, round from laps where session_type = 'R') group by year, round, driver",
        ["best_quali_time"],
    ),
)
def q_quali_fallback(spark, sf_dir):
    laps = laps_of(spark, sf_dir)
    landed_quali = Q.session_filter(laps, ["Q"])
    return Q.quali_fallback(laps, landed_quali)


def _assembled(spark, sf_dir) -> DataFrame:
    laps = laps_of(spark, sf_dir)
    return FP.assemble(laps, sheet=FX.sheet_view(laps))


@register(
    "start_grid",
    round_sql(
        f"with {FEATURE_CTES} select year, round, driver, team, start_grid from feat", ["start_grid"]
    ),
)
def q_start_grid(spark, sf_dir):
    return _assembled(spark, sf_dir).select("year", "round", "driver", "team", "start_grid")


@register(
    "race_targets",
    round_sql(
        f"with {FEATURE_CTES} select year, round, driver, team, winner, pos_change, lap1_pos_change from tg",
        ["pos_change", "lap1_pos_change"],
    ),
)
def q_race_targets(spark, sf_dir):
    return _assembled(spark, sf_dir).select(
        "year", "round", "driver", "team", "winner", "pos_change", "lap1_pos_change"
    )


_TREND_D = ["season_avg_pos_delta", "driver_strength", "race_finish_pct", "team_strength"]


@register(
    "season_trends",
    round_sql(
        f"with {FEATURE_CTES} select year, round, driver, team, {', '.join(_TREND_D)} from features",
        _TREND_D,
    ),
)
def q_season_trends(spark, sf_dir):
    f = FP.materialise(_assembled(spark, sf_dir))
    return season_trends(f).select("year", "round", "driver", "team", *_TREND_D)


@register("driver_race_features", round_sql(f"with {FEATURE_CTES} select * from features", FEATURE_DOUBLES))
def q_driver_race_features(spark, sf_dir):
    return feature_table(spark, sf_dir)


@register(
    "sparse_columns",
    None,  # filled below: one UNION ALL branch per feature column
)
def q_sparse_columns(spark, sf_dir):
    laps = laps_of(spark, sf_dir)
    f = FP.driver_race_features(laps, sheet=FX.sheet_view(laps), drop_sparse=False)
    return sparse_report(f)


FEATURE_COLUMNS = [
    "year", "round", "driver", "team", "race_avg_lap", "race_std_lap", "num_stops",
    "final_position", "finish_flag", "pct_caution_laps", "pct_rain_laps", "avg_stint_len",
    "best_quali_time", "practice_avg_lap", "practice_std_lap", "practice_best_lap", "start_grid",
    *[f"pct_{c}" for c in FIXTURE_COMPOUNDS], "lap1_position", "winner", "pos_change",
    "lap1_pos_change", "season_avg_pos_delta", "driver_strength", "race_finish_pct",
    "team_strength",
]
_SPARSE_BRANCHES = " union all ".join(
    f"select '{c}' as column_name, avg(case when {c} is null or (typeof({c}) = 'DOUBLE' and isnan(cast({c} as double))) "
    f"then 1.0 else 0.0 end) as null_frac from features"
    for c in FEATURE_COLUMNS
)
ORACLE["sparse_columns"] = round_sql(
    f"with {FEATURE_CTES} select column_name, null_frac, "
    "coalesce(null_frac > 0.7 and column_name <> 'best_quali_time', false) as dropped "
    f"from ({_SPARSE_BRANCHES}) s",
    ["null_frac"],
)


# ---------------------------------------------------------------------------
# Step 4: collection - as-of weather, session dimension, records, grid
# ---------------------------------------------------------------------------
from pitwall.operators.joins import asof_nearest  # noqa: E402
from pitwall.plans import collection as CL  # noqa: E402
from pitwall.sources import io as IO  # noqa: E402
from pitwall.sources.tables import read_table  # noqa: E402


@register(
    "asof_nearest",
    round_sql(
        """with p as (select event_id, user_id, ts from events where event_type = 'purchase'),
v as (select event_id as view_id, user_id as v_user, ts as view_ts from events where event_type = 'view'),
c as (select p.*, v.view_id, v.view_ts,
        row_number() over (partition by p.event_id
          order by abs(epoch_us(v.view_ts) - epoch_us(p.ts)), v.view_ts, v.view_id) as rn
      from p left join v on p.user_id = v.v_user and p.ts is not null and v.view_ts is not null)
select event_id, user_id, ts, view_id, view_ts,
       cast(abs(epoch_us(view_ts) - epoch_us(ts)) as double) / 1000000 as asof_distance
from c where rn = 1""",
        ["asof_distance"],
    ),
)
def q_asof_nearest(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    purchases = ev.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    views = ev.filter(F.col("event_type") == "view").select(
        F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("view_ts")
    )
    return asof_nearest(
        purchases, views, by=["user_id"], left_time="ts", right_time="view_ts",
        right_id="view_id", bucket_width=86400.0,
    )


@register(
    "accurate_laps",
    round_sql(
        f"with {FX.LAPS_CTE} select year, round, session_type, driver, lap_number, lap_time "
        "from laps where coalesce(is_accurate, false)",
        ["lap_time"],
    ),
)
def q_accurate_laps(spark, sf_dir):
    return CL.accurate_laps(laps_of(spark, sf_dir)).select(
        "year", "round", "session_type", "driver", "lap_number", "lap_time"
    )


_EVENT_SQL = "concat(cast({a}.year as varchar), '-R', lpad(cast({a}.round as varchar), 2, '0'))"
_RESULTS_SQL = (
    "res as (select year, round, session_type, driver, arg_max(position, lap_number) "
    "filter (where position is not null and lap_number is not null) as grid_position "
    "from laps where session_type in ('R') and driver is not null "
    "group by year, round, session_type, driver)"
)
_LAP_KEY_JOIN = (
    "{a}.year = {b}.year and {a}.round = {b}.round and {a}.session_type = {b}.session_type "
    "and {a}.driver = {b}.driver"
)


@register(
    "session_dim",
    round_sql(
        f"""with {FX.LAPS_CTE}, {_RESULTS_SQL}
select s.year, s.round, s.session_type, {_EVENT_SQL.format(a='s')} as event_name,
       s.driver, su.s_name as driver_name, s.team, n.n_name as team_name, s.lap_number, res.grid_position
from laps s left join res on {_LAP_KEY_JOIN.format(a='s', b='res')}
left join supplier su on res.driver = su.s_suppkey
left join nation n on s.team = n.n_nationkey
where s.session_type in ('R')""",
        ["grid_position"],
    ),
)
def q_session_dim(spark, sf_dir):
    return CL.session_dim(
        laps_of(spark, sf_dir), read_table(spark, sf_dir, "supplier"), read_table(spark, sf_dir, "nation")
    )


_RECORD_DOUBLES = [
    "lap_time", "grid_position", "position", "start_time", "weather_air_temp",
    "weather_track_temp", "weather_humidity", "weather_wind_speed",
]
LAP_RECORDS_SQL = round_sql(
    f"""with {FX.LAPS_CTE}, {FX.WEATHER_CTE}, {_RESULTS_SQL},
acc as (select * from laps where session_type in ('R') and coalesce(is_accurate, false)),
wd as (select * from (select *, row_number() over (partition by year, round, session_type, time
         order by sample_id) as k from weather where time is not null) where k = 1),
c as (select a.year, a.round, a.session_type, a.driver, a.team, a.lap_number, a.lap_time, a.position,
        a.compound, a.track_status, a.start_time, wd.air_temp, wd.track_temp, wd.humidity,
        wd.rainfall as w_rain, wd.wind_speed,
        row_number() over (partition by a.year, a.round, a.session_type, a.driver, a.lap_number
          order by abs(wd.time - a.start_time), wd.time, wd.sample_id) as rn
      from acc a left join wd on a.year = wd.year and a.round = wd.round
        and a.session_type = wd.session_type and a.start_time is not null)
select c.year, c.round, c.session_type, {_EVENT_SQL.format(a='c')} as event_name, c.driver, c.team,
       c.lap_number, c.lap_time, res.grid_position, c.position, c.compound, c.track_status, c.start_time,
       c.air_temp as weather_air_temp, c.track_temp as weather_track_temp,
       c.humidity as weather_humidity, c.w_rain as weather_rainfall, c.wind_speed as weather_wind_speed
from c left join res on {_LAP_KEY_JOIN.format(a='c', b='res')}
where rn = 1""",
    _RECORD_DOUBLES,
)


def _records(spark, sf_dir) -> DataFrame:
    return CL.lap_records(laps_of(spark, sf_dir), FX.weather_view(spark, sf_dir))


@register("lap_records", LAP_RECORDS_SQL)
def q_lap_records(spark, sf_dir):
    return _records(spark, sf_dir)


@register("scan_session_laps", LAP_RECORDS_SQL)
def q_scan_session_laps(spark, sf_dir):
    """Collected records written as CSV (the collector's sink) and read back
    with the declared raw schema; malformed lines would go to the reject frame."""
    path = IO.write_csv(_records(spark, sf_dir), IO.new_scratch(spark, "laps-csv"))
    good, _rejects = IO.read_laps_csv(spark, path)
    return good


@register(
    "season_grid",
    round_sql(
        f"with {FX.LAPS_CTE} select * exclude (lap_time_text, is_accurate) from laps "
        "where session_type in ('R') and round between 1 and 23",
        ["lap_time", "position", "start_time"],
    ),
)
def q_season_grid(spark, sf_dir):
    return CL.season_grid(laps_of(spark, sf_dir)).drop("lap_time_text", "is_accurate")


@register(
    "load_report",
    f"""with {FX.LAPS_CTE},
b as (select min(year) as y0, max(year) as y1 from laps),
y as (select cast(unnest(range(y0, y1 + 1)) as int) as year from b),
g as (select year, cast(unnest(range(1, 24)) as int) as round, 'R' as session_type from y),
cnt as (select year, round, session_type, count(*) as n_laps from laps group by year, round, session_type)
select g.year, g.round, g.session_type, coalesce(cnt.n_laps, 0) as n_laps,
       coalesce(cnt.n_laps > 0, false) as loaded
from g left join cnt on g.year = cnt.year and g.round = cnt.round and g.session_type = cnt.session_type""",
)
def q_load_report(spark, sf_dir):
    return CL.load_report(laps_of(spark, sf_dir))


@register("write_features", round_sql(f"with {FEATURE_CTES} select * from features", FEATURE_DOUBLES))
def q_write_features(spark, sf_dir):
    f = feature_table(spark, sf_dir)
    path = IO.write_features(f, IO.new_scratch(spark, "features"))
    return spark.read.parquet(path).select(*f.columns)


@register(
    "feature_scan",
    round_sql(
        f"with {FEATURE_CTES} select driver, year, season_avg_pos_delta from features",
        ["season_avg_pos_delta"],
    ),
)
def q_feature_scan(spark, sf_dir):
    f = feature_table(spark, sf_dir)
    path = IO.write_features(f, IO.new_scratch(spark, "features"))
    return IO.feature_scan(
        spark, path, ["driver", "year", "season_avg_pos_delta"], required="race_avg_lap"
    )


# ---------------------------------------------------------------------------
# Step 5: training frame - means, imputation, split, folds, lookups
# ---------------------------------------------------------------------------
from pitwall.operators import clean as C  # noqa: E402
from pitwall.operators.rank import rank_final_position, rank_race_time  # noqa: E402
from pitwall.plans import inference as INF  # noqa: E402
from pitwall.plans import training as TR  # noqa: E402

_PRERACE_LT = C.PRERACE_LAP_TIME
_PRERACE_POS = C.PRERACE_POSITION
_ALL_POS_FEATURES = [
    c for c in FEATURE_COLUMNS if c not in C.ID_COLS and c != C.POSITION_TARGET
]
_KEYS = "year, round, driver, team"


def _means_sql(cols: list[str], src: str = "features") -> str:
    return " union all ".join(
        f"select '{c}' as feature, avg(cast({c} as double)) as mean from {src}" for c in cols
    )


@register(
    "column_means",
    round_sql(f"with {FEATURE_CTES} {_means_sql(_PRERACE_LT)}", ["mean"]),
)
def q_column_means(spark, sf_dir):
    m = TR.training_matrix(feature_table(spark, sf_dir), C.LAP_TIME_TARGET)
    return C.column_means(m, _PRERACE_LT)


@register(
    "mean_impute",
    round_sql(
        f"with {FEATURE_CTES} select {_KEYS}, "
        + ", ".join(f"coalesce(cast({c} as double), avg(cast({c} as double)) over (), 0.0) as {c}" for c in _PRERACE_LT)
        + ", cast(race_avg_lap as double) as label from features",
        [*_PRERACE_LT, "label"],
    ),
)
def q_mean_impute(spark, sf_dir):
    m = TR.training_matrix(feature_table(spark, sf_dir), C.LAP_TIME_TARGET)
    return C.mean_impute(m, _PRERACE_LT)


@register(
    "training_matrix",
    round_sql(
        f"with {FEATURE_CTES} select {_KEYS}, "
        + ", ".join(f"cast({c} as double) as {c}" for c in _ALL_POS_FEATURES)
        + ", cast(start_grid - final_position as double) as label from features",
        [*_ALL_POS_FEATURES, "label"],
    ),
)
def q_training_matrix(spark, sf_dir):
    return TR.training_matrix(feature_table(spark, sf_dir), C.POSITION_TARGET, feature_set="all")


@register(
    "target_profile",
    round_sql(
        f"with {FEATURE_CTES} select avg(start_grid - final_position) as target_mean, "
        "stddev_samp(start_grid - final_position) as target_std from features",
        ["target_mean", "target_std"],
    ),
)
def q_target_profile(spark, sf_dir):
    f = C.with_position_target(feature_table(spark, sf_dir))
    return f.agg(
        F.avg(C.POSITION_TARGET).alias("target_mean"),
        F.stddev_samp(C.POSITION_TARGET).alias("target_std"),
    )


_MD5 = (
    "md5(concat_ws('|', cast(year as varchar), cast(round as varchar), "
    "cast(driver as varchar), cast(team as varchar), '42'))"
)


@register(
    "holdout_split",
    f"with {FEATURE_CTES} select {_KEYS}, substr({_MD5}, 1, 8) < '33333333' as is_test from features",
)
def q_holdout_split(spark, sf_dir):
    f = feature_table(spark, sf_dir).select(*TR.ROW_KEYS)
    return C.holdout_split(f, TR.ROW_KEYS)


@register(
    "cv_folds",
    f"with {FEATURE_CTES} select {_KEYS}, cast(((strpos('0123456789abcdef', substr({_MD5}, 9, 1)) - 1) * 16 "
    f"+ (strpos('0123456789abcdef', substr({_MD5}, 10, 1)) - 1)) % 5 as int) as fold from features",
)
def q_cv_folds(spark, sf_dir):
    f = feature_table(spark, sf_dir).select(*TR.ROW_KEYS)
    return C.cv_folds(f, TR.ROW_KEYS)


LOOKUP_CTES = f"""{FEATURE_CTES},
latest as (select * from features where year = (select max(year) from features)),
lk as (select driver, avg(season_avg_pos_delta) as season_avg_pos_delta from latest
       where driver is not null group by driver),
fr as (select driver, race_finish_pct, driver_strength, team_strength from
       (select *, row_number() over (partition by driver order by round, team) as rn from latest
        where driver is not null) x where rn = 1),
lookup as (select lk.driver, season_avg_pos_delta, race_finish_pct, driver_strength, team_strength
           from lk join fr on lk.driver = fr.driver)"""
_LOOKUP_D = ["season_avg_pos_delta", "race_finish_pct", "driver_strength", "team_strength"]


@register("season_lookup", round_sql(f"with {LOOKUP_CTES} select * from lookup", _LOOKUP_D))
def q_season_lookup(spark, sf_dir):
    return SS.season_lookup(season_state(spark, sf_dir))


@register(
    "regression_metrics",
    round_sql(
        f"""with {FEATURE_CTES},
m as (select cast(race_avg_lap as double) as label, substr({_MD5}, 1, 8) < '33333333' as is_test
      from features where race_avg_lap is not null),
mu as (select avg(label) as p from m where not is_test),
t as (select label, (select p from mu) as prediction from m where is_test),
tm as (select avg(label) as mu_t from t)
select count(*) as n, avg(abs(label - prediction)) as mae,
       1 - sum((label - prediction) * (label - prediction))
         / sum((label - (select mu_t from tm)) * (label - (select mu_t from tm))) as r2
from t""",
        ["mae", "r2"],
    ),
)
def q_regression_metrics(spark, sf_dir):
    """Metrics of a fixed baseline prediction (the training-rows mean label)
    on the held-out rows, so the metric operator itself is SQL-checkable."""
    m = TR.training_matrix(feature_table(spark, sf_dir), C.LAP_TIME_TARGET)
    m = C.holdout_split(m.filter(F.col("label").isNotNull()), TR.ROW_KEYS)
    mu = m.filter(~F.col("is_test")).agg(F.avg("label").alias("p")).first().p
    test = m.filter(F.col("is_test")).withColumn("prediction", F.lit(mu))
    return TR.regression_metrics(test)


# ---------------------------------------------------------------------------
# Step 7 (SQL-checkable part): inference frame and rankings
# ---------------------------------------------------------------------------
INFERENCE_CTES = f"""{LOOKUP_CTES},
mu as (select avg(cast(start_grid as double)) as m_start_grid, avg(best_quali_time) as m_best_quali_time,
       avg(season_avg_pos_delta) as m_season_avg_pos_delta, avg(race_finish_pct) as m_race_finish_pct,
       avg(driver_strength) as m_driver_strength, avg(team_strength) as m_team_strength from features),
inf as (select s.year, s.round, s.driver, s.start_grid as sheet_start_grid,
       coalesce(s.start_grid, mu.m_start_grid, 0.0) as start_grid,
       coalesce(s.best_quali_time, mu.m_best_quali_time, 0.0) as best_quali_time,
       coalesce(l.season_avg_pos_delta, mu.m_season_avg_pos_delta, 0.0) as season_avg_pos_delta,
       coalesce(l.race_finish_pct, mu.m_race_finish_pct, 0.0) as race_finish_pct,
       coalesce(l.driver_strength, mu.m_driver_strength, 0.0) as driver_strength,
       coalesce(l.team_strength, mu.m_team_strength, 0.0) as team_strength
   from ss s left join lookup l on s.driver = l.driver cross join mu)"""
_INF_D = ["sheet_start_grid", *_PRERACE_POS]


def _inference(spark, sf_dir) -> DataFrame:
    state, names = season_state(spark, sf_dir), list(_PRERACE_POS)
    meta = {"feature_names": names, "feature_means": SS.model_means(state, names)}
    return INF.lookup_frame(FX.sheet_view(laps_of(spark, sf_dir)), SS.season_lookup(state), meta)


@register("inference_frame", round_sql(f"with {INFERENCE_CTES} select * from inf", _INF_D))
def q_inference_frame(spark, sf_dir):
    return _inference(spark, sf_dir)


@register(
    "rank_race_time",
    round_sql(
        f"with {FX.LAPS_CTE}, {QUALI_CTES} select year, round, driver, best_quali_time, "
        "cast(case when best_quali_time is not null then row_number() over (partition by year, round "
        "order by best_quali_time asc nulls last, driver) end as bigint) as pred_race_pos from ss",
        ["best_quali_time"],
    ),
)
def q_rank_race_time(spark, sf_dir):
    """The ranking operator applied to a deterministic score (the sheet's best
    quali time) so the order is SQL-checkable."""
    s = INF.sheet_inputs(FX.sheet_view(laps_of(spark, sf_dir)))
    return rank_race_time(s, "best_quali_time").select(
        "year", "round", "driver", "best_quali_time", "pred_race_pos"
    )


@register(
    "rank_final_position",
    round_sql(
        f"with {INFERENCE_CTES} select year, round, driver, sheet_start_grid, "
        "season_avg_pos_delta as pred_delta, sheet_start_grid - season_avg_pos_delta as pred_score, "
        "cast(row_number() over (partition by year, round order by sheet_start_grid - season_avg_pos_delta "
        "asc nulls last, sheet_start_grid asc nulls last, driver) as bigint) as pred_final_position from inf",
        ["sheet_start_grid", "pred_delta", "pred_score"],
    ),
)
def q_rank_final_position(spark, sf_dir):
    """Position ranking with the season delta lookup as a deterministic
    stand-in for the model's predicted delta."""
    inf = _inference(spark, sf_dir).withColumn("pred_delta", F.col("season_avg_pos_delta"))
    ranked = rank_final_position(inf, "pred_delta", grid="sheet_start_grid")
    return ranked.select(
        "year", "round", "driver", "sheet_start_grid", "pred_delta", "pred_score", "pred_final_position"
    )


# ---------------------------------------------------------------------------
# Step 6-7: model searches, leaderboard, store, predictions (rows-only)
# ---------------------------------------------------------------------------
def _training_set(spark, sf_dir, target=C.LAP_TIME_TARGET) -> "TR.TrainingSet":
    return TR.prepare(feature_table(spark, sf_dir), target)


def _search_rows(spark, ts, search) -> DataFrame:
    found = TR.searched(ts, search)
    ts.release()
    return spark.createDataFrame(TR.cv_results(found), "params string, cv_mae double")


@register("search_lasso")
def q_search_lasso(spark, sf_dir):
    ts = _training_set(spark, sf_dir)
    return _search_rows(spark, ts, TR.search_lasso(ts))


@register("search_gbt")
def q_search_gbt(spark, sf_dir):
    ts = _training_set(spark, sf_dir)
    return _search_rows(spark, ts, TR.search_gbt(ts))


@register("search_third")
def q_search_third(spark, sf_dir):
    ts = _training_set(spark, sf_dir)
    return _search_rows(spark, ts, TR.search_third(ts))


@register("leaderboard")
def q_leaderboard(spark, sf_dir):
    board, _ = TR.leaderboard(_training_set(spark, sf_dir))
    return board


@register("model_store")
def q_model_store(spark, sf_dir):
    """Store the lasso model, load it back and score the held-out rows."""
    ts = _training_set(spark, sf_dir)
    _, paths = TR.leaderboard(ts, models=["lasso"])
    model, meta = TR.load_model(spark, paths["lasso"])
    test = ts.frame.filter(F.col("is_test"))
    return model.transform(test).select(*TR.ROW_KEYS, "label", "prediction")


@register("predict_race_time")
def q_predict_race_time(spark, sf_dir):
    feats = feature_table(spark, sf_dir)
    ts = TR.prepare(feats, C.LAP_TIME_TARGET)
    board, paths = TR.leaderboard(ts)
    model, meta = TR.load_model(spark, paths[TR.best_model(board)])
    return INF.predict_race_time(model, meta, FX.sheet_view(laps_of(spark, sf_dir)), feats)


@register("predict_position")
def q_predict_position(spark, sf_dir):
    feats = feature_table(spark, sf_dir)
    ts = TR.prepare(feats, C.POSITION_TARGET)
    board, paths = TR.leaderboard(ts)
    model, meta = TR.load_model(spark, paths[TR.best_model(board)])
    return INF.predict_position(model, meta, FX.sheet_view(laps_of(spark, sf_dir)), feats)


# ---------------------------------------------------------------------------
# Collection as a stream: the same records through Structured Streaming
# ---------------------------------------------------------------------------
from pitwall.operators.race import LAP_PARTITION  # noqa: E402
from pitwall.streaming.collect import LANDED_LAP_SCHEMA, start_collection  # noqa: E402


@register("collect_stream", LAP_RECORDS_SQL)
def q_collect_stream(spark, sf_dir):
    """Race sessions are landed as Parquet files, each driver's last lap marked, picked
    up by the streaming collector (availableNow trigger) and appended to a
    partitioned records table, which is returned. Files cut sessions anywhere."""
    import uuid

    laps = laps_of(spark, sf_dir).filter(F.col("session_type").isin(CL.SESSION_TYPES))
    ends = laps.groupBy(*LAP_PARTITION).agg(F.max("lap_number").alias("_last"))
    marked = laps.join(ends, LAP_PARTITION).withColumn("session_end", F.col("lap_number") == F.col("_last"))
    landed = IO.new_scratch(spark, "landed-sessions")
    marked.select(*[f.name for f in LANDED_LAP_SCHEMA.fields]).write.mode("overwrite").parquet(landed)
    sink = IO.new_scratch(spark, "records-sink")
    name = f"collect_{uuid.uuid4().hex[:8]}"
    q = start_collection(spark, landed, FX.weather_view(spark, sf_dir), sink, query_name=name, available_now=True)
    q.awaitTermination()
    return spark.read.parquet(sink).select(*CL.RECORD_COLUMNS)

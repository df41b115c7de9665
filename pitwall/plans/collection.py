"""Collection: landed lap and weather logs -> lap records.

Per lap: keep accurate laps of the collected session types, attach the
nearest weather sample of the session (bucketed as-of join, no lap x sample
pairs), the event label and the driver's classified position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.operators.joins import asof_nearest, join_small
from pitwall.operators.race import LAP_PARTITION

# The session types collected (race only is active) and the
# round range tried per season.
SESSION_TYPES = ["R"]
FIRST_ROUND, LAST_ROUND = 1, 23
SESSION_KEYS = ["year", "round", "session_type"]
WEATHER_BUCKET_SECONDS = 600.0

RECORD_COLUMNS = [
    "year", "round", "session_type", "event_name", "driver", "team", "lap_number",
    "lap_time", "grid_position", "position", "compound", "track_status", "start_time",
    "weather_air_temp", "weather_track_temp", "weather_humidity", "weather_rainfall",
    "weather_wind_speed",
]


def accurate_laps(laps: DataFrame) -> DataFrame:
    """Laps the timing feed marks as accurate."""
    return laps.filter(F.coalesce(F.col("is_accurate"), F.lit(False)))


def event_label(year: str = "year", round_: str = "round") -> F.Column:
    """Event name of a race weekend: '<year>-R<round, two digits>'."""
    return F.concat(
        F.col(year).cast("string"), F.lit("-R"), F.lpad(F.col(round_).cast("string"), 2, "0")
    )


def session_results(laps: DataFrame) -> DataFrame:
    """Classified position per driver-session: the last non-NULL position in
    lap order (aggregate, so a long session is reduced map-side)."""
    pos = F.col("position")
    return (
        laps.filter(F.col("driver").isNotNull())
        .groupBy(*LAP_PARTITION)
        .agg(F.max_by(pos, F.when(pos.isNotNull(), F.col("lap_number"))).alias("grid_position"))
    )


def with_classified_position(laps: DataFrame) -> DataFrame:
    """Attach grid_position: the driver's last non-NULL position in lap order
    over the whole session (every lap counts).

    The per driver-session result is an aggregate (reduced map-side, so a
    hot session is never one task) joined back on the lap partition
    (collected sessions always carry year, round and session type). AQE
    picks the join from the aggregate's runtime size: broadcast when small,
    else sort-merge with skewed partitions split.
    """
    # equi-join on the lap partition: both sides are already hash-partitioned
    # on it when the laps come from a lap-keyed stage, so no exchange is added
    return laps.join(session_results(laps), LAP_PARTITION, "left")


def session_dim(laps: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Laps of the collected sessions with event name, driver and team names
    and the driver's classified position.

    The classified position is an aggregate joined back; driver and team
    names come from the dimensions by joins that AQE broadcasts when small.
    """
    sess = with_classified_position(laps.filter(F.col("session_type").isin(SESSION_TYPES)))
    drivers = supplier.select(F.col("s_suppkey").alias("driver"), F.col("s_name").alias("driver_name"))
    teams = nation.select(F.col("n_nationkey").alias("team"), F.col("n_name").alias("team_name"))
    out = join_small(sess, drivers, ["driver"], "left")
    out = join_small(out, teams, ["team"], "left")
    return out.select(
        *SESSION_KEYS,
        event_label().alias("event_name"),
        "driver",
        "driver_name",
        "team",
        "team_name",
        "lap_number",
        "grid_position",
    )


def weather_samples(weather: DataFrame) -> DataFrame:
    """Weather log columns renamed to the record's weather_* names."""
    return weather.select(
        *SESSION_KEYS,
        F.col("time").alias("weather_time"),
        F.col("sample_id").alias("weather_sample_id"),
        F.col("air_temp").alias("weather_air_temp"),
        F.col("track_temp").alias("weather_track_temp"),
        F.col("humidity").alias("weather_humidity"),
        F.col("rainfall").alias("weather_rainfall"),
        F.col("wind_speed").alias("weather_wind_speed"),
    )


def lap_records(laps: DataFrame, weather: DataFrame) -> DataFrame:
    """The collected lap log (one record per accurate lap of the collected
    sessions) with nearest weather, event label and classified position.

    The classified position is an aggregate per driver-session joined back
    (see :func:`with_classified_position`), taken before the accuracy filter
    (results count every lap).
    """
    return classified_records(with_classified_position(laps.filter(F.col("session_type").isin(SESSION_TYPES))), weather)


def classified_records(sess: DataFrame, weather: DataFrame, *carried: str) -> DataFrame:
    """Records of laps that hold their grid_position already; ``carried`` columns of
    the laps are added."""
    acc = accurate_laps(sess)
    matched = asof_nearest(
        acc.select(*LAP_PARTITION, "team", "lap_number", "lap_time", "grid_position", "position",
                   "compound", "track_status", "start_time", *carried),
        weather_samples(weather),
        by=SESSION_KEYS,
        left_time="start_time",
        right_time="weather_time",
        right_id="weather_sample_id",
        bucket_width=WEATHER_BUCKET_SECONDS,
    )
    return matched.select(
        *[event_label().alias(c) if c == "event_name" else F.col(c) for c in RECORD_COLUMNS], *carried
    )


def session_grid(laps: DataFrame, start_year: int | None = None, end_year: int | None = None) -> DataFrame:
    """Every (year, round, session_type) the collector tries: seasons (from
    the arguments, else the span of the data) x rounds 1..23 x collected
    session types. Built by generators from one row, no cross join."""
    span = laps.agg(F.min("year").alias("y0"), F.max("year").alias("y1"))
    y0 = F.lit(start_year) if start_year is not None else F.col("y0")
    y1 = F.lit(end_year) if end_year is not None else F.col("y1")
    years = span.select(F.explode(F.sequence(y0.cast("int"), y1.cast("int"))).alias("year"))
    rounds = years.select("year", F.explode(F.sequence(F.lit(FIRST_ROUND), F.lit(LAST_ROUND))).alias("round"))
    return rounds.select(
        "year", "round", F.explode(F.array(*[F.lit(s) for s in SESSION_TYPES])).alias("session_type")
    )


def season_grid(laps: DataFrame, start_year: int | None = None, end_year: int | None = None) -> DataFrame:
    """All laps of the grid's sessions (the collected data set). The grid is
    applied as plain predicates, which Catalyst pushes below the lap window."""
    yr = F.col("year")
    cond = F.col("session_type").isin(SESSION_TYPES) & F.col("round").between(FIRST_ROUND, LAST_ROUND)
    if start_year is not None:
        cond = cond & (yr >= start_year)
    if end_year is not None:
        cond = cond & (yr <= end_year)
    return laps.filter(cond)


def load_report(laps: DataFrame, start_year: int | None = None, end_year: int | None = None) -> DataFrame:
    """Per tried session: lap count and whether it loaded; a missing session
    contributes zero rows instead of failing the collection."""
    counts = laps.groupBy(*SESSION_KEYS).agg(F.count(F.lit(1)).alias("n_laps"))
    grid = session_grid(laps, start_year, end_year)
    return grid.join(counts, SESSION_KEYS, "left").select(
        *SESSION_KEYS,
        F.coalesce(F.col("n_laps"), F.lit(0).cast("bigint")).alias("n_laps"),
        F.coalesce(F.col("n_laps") > 0, F.lit(False)).alias("loaded"),
    )

"""Physical-plan checks: no Python in the hot path, pushdown, shared shuffle."""

from pitwall.operators.race import block_summaries, compound_values, race_laps
from pitwall.plans.collection import lap_records
from pitwall.sources import fixtures as FX


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_race_block_shuffles_laps_once(spark, sf_small):
    laps = FX.lap_view(spark, sf_small)
    comps = compound_values(race_laps(laps))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(block_summaries(laps, comps))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # one exchange for the lap partition (plus the planner's choice for the
    # supplier dimension join); window and aggregate reuse it
    hashed = [
        ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln and "ReusedExchange" not in ln
    ]
    lap_keyed = [ln for ln in hashed if "session_type" in ln]
    assert len(lap_keyed) == 1, plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_feature_scan_prunes_partitions_and_columns(spark, sf_small):
    from pyspark.sql import functions as F

    from pitwall.sources import io as IO

    df = spark.createDataFrame(
        [(1995, 1, 7, 1.0, 2.0), (1996, 2, 8, 3.0, 4.0)],
        "year int, round int, driver long, race_avg_lap double, season_avg_pos_delta double",
    )
    path = IO.write_features(df, IO.new_scratch(spark, "scan-test"))
    q = IO.feature_scan(spark, path, ["driver", "year", "season_avg_pos_delta"], required="race_avg_lap")
    q = q.filter((F.col("year") == 1995) & (F.col("season_avg_pos_delta") > 0))
    scan = [ln for ln in plan_of(q).splitlines() if "FileScan parquet" in ln][0]
    assert "PartitionFilters: [isnotnull(year" in scan and "= 1995" in scan
    assert "PushedFilters: [IsNotNull(season_avg_pos_delta), GreaterThan(season_avg_pos_delta" in scan
    assert "race_avg_lap" not in scan.split("ReadSchema")[1]
    assert [tuple(r) for r in q.collect()] == [(7, 1995, 2.0)]


def test_lap_records_has_no_cartesian(spark, sf_small):
    rec = lap_records(FX.lap_view(spark, sf_small), FX.weather_view(spark, sf_small))
    plan = plan_of(rec)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "PythonUDF" not in plan


def test_number_rows_picks_window_or_distributed_path(spark):
    """Bounded groups: a plain window, no Python. Over the limit: no window
    over the groups; the Arrow numbering is behind the checkpoint and the
    offsets (one row per partition) are broadcast."""
    from pyspark.sql import functions as F

    from pitwall.operators.rank import number_rows

    df = spark.range(500).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    small = plan_of(number_rows(df, ["k"], [F.col("o")], "rn"))
    assert "Window" in small and "MapInArrow" not in small and "PythonUDF" not in small
    big = number_rows(df, ["k"], [F.col("o")], "rn", max_group_rows=10)
    plan = plan_of(big)
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    windows = [ln for ln in plan.splitlines() if "Window [" in ln or ln.strip().startswith("Window")]
    assert all("_pid" in ln or "_last" in ln for ln in windows), windows  # summary rows only
    assert sorted(r.rn for r in big.filter("k = 0").collect()) == list(range(1, 168))

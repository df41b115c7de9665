"""Single measures equal the race block's columns, and read the laps once."""

import pytest
from pyspark.sql import functions as F

from pitwall import catalog
from pitwall.operators import race_measures as RM
from pitwall.plans.features import race_block
from pitwall.sources import fixtures as FX

COLUMNS = {
    "finish_flag": ["finish_flag"],
    "lap1_position": ["lap1_position"],
    "first_last_position": ["start_grid_race", "final_position"],
    "caution_share": ["pct_caution_laps"],
    "rain_share": ["pct_rain_laps"],
}
ROW = "year int, round int, session_type string, driver string, team string, lap_number int, lap_time double, position double, compound string, track_status string, rainfall boolean"


@pytest.fixture(scope="module")
def odd(spark):
    """Two teams for one driver, NULL keys that hold the race distance, NULLs everywhere."""
    rows = [
        (1, 1, "R", "A", "T", 1, 90.0, None, "Soft", "1", None), (1, 1, "R", "A", "T", 2, 91.0, 2.0, None, "12", True),
        (1, 1, "R", "A", "U", 3, None, 3.0, "c3.5", None, False), (1, 1, "R", "B", "T", 1, 95.0, 1.0, "SOFT", "1", False),
        (1, 1, "R", None, "T", 9, 95.0, 1.0, "SOFT", "1", False), (1, 1, "Q", "B", "T", 20, 95.0, 1.0, "SOFT", "1", True),
        (1, 1, "R", "C", None, 1, 95.0, 5.0, "SOFT", "x", False), (2, 1, "R", "A", "T", None, 95.0, 4.0, None, "1", None),
        (None, 1, "R", "A", "T", 1, 95.0, 4.0, None, "1", None), (1, 1, "R", "C", "T", 9, 95.0, None, None, "2", False),
    ]
    return spark.createDataFrame(rows, ROW)


@pytest.mark.parametrize("name", COLUMNS)
def test_measure_equals_the_race_block(odd, name):
    block, _ = race_block(odd)
    got = getattr(RM, name)(odd)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, block.select(*RM.KEYS, *COLUMNS[name]).collect()), key=str)


def test_compound_usage_equals_the_race_block(odd):
    block, compounds = race_block(odd)
    got = RM.compound_usage(odd, compounds)
    assert compounds == ["c3.5", "soft"] and got.columns == [*RM.KEYS, "pct_c3.5", "pct_soft"]
    want = block.select(*RM.KEYS, *[F.col(f"`pct_{c}`") for c in compounds])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_shares_read_the_log_once_and_shuffle_groups_only(spark, sf_small):
    for measure in (RM.caution_share, RM.rain_share):
        plan = measure(FX.lap_view(spark, sf_small, number=False))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("lineitem") == 1 and "Window" not in plan and "partial_sum" in plan
        assert "l_extendedprice" not in plan  # only the measure's columns
    # the whole query runs one shuffle of groups, as a listener of its jobs would see
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("caution", "caution")
    catalog.QUERIES["caution_share"](spark, sf_small).write.format("noop").mode("overwrite").save()
    jobs = tracker.getJobIdsForGroup("caution")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 5  # two table schemas, supplier broadcast, map side, result

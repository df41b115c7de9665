"""The season state equals the feature table, is updated race by race, and serves the
lookups without a lap."""

import pytest
from pyspark.sql import functions as F

from pitwall.operators import season_state as SS
from pitwall.operators.season import season_lookup
from pitwall.plans import inference as INF
from pitwall.plans.features import driver_race_features
from pitwall.sources import fixtures as FX
from pitwall.sources import io as IO

NAMES = ["start_grid", "best_quali_time", "season_avg_pos_delta", "race_finish_pct", "driver_strength", "team_strength"]


@pytest.fixture(scope="module")
def laps(spark, sf_small):
    return FX.lap_view(spark, sf_small).cache()


@pytest.fixture(scope="module")
def features(laps):
    return driver_race_features(laps, FX.sheet_view(laps), drop_sparse=False).cache()


def rows(df, columns):
    out = df.select(*[F.round(F.col(c).cast("double"), 6).alias(c) if c not in SS.KEYS else F.col(c) for c in columns])
    return sorted(map(tuple, out.collect()), key=str)


def test_state_equals_the_feature_table(laps, features):
    state = SS.driver_race_state(laps, FX.sheet_view(laps))
    assert rows(state, [*SS.KEYS, *SS.VALUES]) == rows(features, [*SS.KEYS, *SS.VALUES])


def test_races_are_replaced_one_by_one(spark, laps, features):
    path = IO.new_scratch(spark, "state")
    sheet, last = FX.sheet_view(laps), laps.agg(F.max("year")).first()[0]
    whole = SS.driver_race_state(laps, sheet)
    SS.write_state(whole.withColumn("start_grid", F.lit(99.0)), path)  # an older collection of the same races
    for part in (F.col("year") < last, F.col("year") == last):
        SS.write_state(SS.driver_race_state(laps.filter(part), sheet), path)
    state = SS.read_state(spark, path)
    assert rows(state, [*SS.KEYS, *SS.VALUES]) == rows(whole, [*SS.KEYS, *SS.VALUES])
    got, want = SS.season_lookup(state), season_lookup(features)
    assert rows(got, ["driver", *SS.DRIVER_MEANS, "team_strength"]) == rows(want, ["driver", *SS.DRIVER_MEANS, "team_strength"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and plan.count("PartitionFilters: [isnotnull(year") >= 1
    means = SS.model_means(state, NAMES)
    for n, v in features.agg(*[F.avg(F.col(n).cast("double")).alias(n) for n in NAMES]).first().asDict().items():
        assert means[n] == pytest.approx(v)
    meta = {"feature_names": NAMES, "feature_means": means}
    frames = [INF.lookup_frame(sheet, got, meta), INF.inference_frame(sheet, features, meta)]
    one, two = (rows(f, ["year", "round", "driver", *NAMES]) for f in frames)
    assert one == two


def test_state_of_nothing(spark, laps):
    state = SS.driver_race_state(laps.filter("year < 0"))
    assert state.count() == 0 and SS.season_lookup(state).count() == 0

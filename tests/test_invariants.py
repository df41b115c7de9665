"""Properties of the feature path on the real test tables."""

import pytest
from pyspark.sql import functions as F

from pitwall.plans import features as FP
from pitwall.sources import fixtures as FX


@pytest.fixture(scope="module")
def features(spark, sf_small):
    laps = FX.lap_view(spark, sf_small)
    return FP.driver_race_features(laps, sheet=FX.sheet_view(laps)).cache()


def test_one_row_per_key(features):
    assert features.count() == features.select("year", "round", "driver", "team").distinct().count()


def test_shares_in_unit_interval(features):
    for c in ("pct_caution_laps", "pct_rain_laps", "race_finish_pct", "finish_flag"):
        row = features.agg(F.min(c).alias("lo"), F.max(c).alias("hi")).first()
        assert 0.0 <= row.lo <= row.hi <= 1.0, c


def test_compound_fractions_sum_to_one(features):
    pct = [c for c in features.columns if c.startswith("pct_") and c not in ("pct_caution_laps", "pct_rain_laps")]
    assert pct
    total = sum(F.coalesce(F.col(c), F.lit(0.0)) for c in pct)
    with_any = features.filter(F.col(pct[0]).isNotNull())
    bad = with_any.filter(F.abs(total - 1.0) > 1e-9).count()
    assert bad == 0


def test_same_answer_under_other_partitioning(spark, sf_small, features):
    laps = FX.lap_view(spark, sf_small)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        one = FP.driver_race_features(laps, sheet=FX.sheet_view(laps))
        cols = sorted(features.columns)
        def norm(df):
            rows = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(cols).collect()]
            return sorted(rows, key=repr)

        a, b = norm(features), norm(one)
        assert a == b
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_prior_only_trends_do_not_look_ahead(spark, features):
    from pitwall.operators.season import season_trends

    base = features.drop("season_avg_pos_delta", "driver_strength", "race_finish_pct", "team_strength")
    prior = season_trends(base, prior_only=True)
    first_round = prior.groupBy("year", "driver").agg(F.min("round").alias("round"))
    firsts = prior.join(first_round, ["year", "driver", "round"], "left_semi")
    assert firsts.filter(F.col("driver_strength").isNotNull()).count() == 0


def test_prior_only_equals_window_definition(spark, features):
    from pyspark.sql import Window

    from pitwall.operators.season import season_trends

    base = features.drop("season_avg_pos_delta", "driver_strength", "race_finish_pct", "team_strength")
    got = season_trends(base, prior_only=True)
    earlier = (Window.unboundedPreceding, -1)
    wd = Window.partitionBy("year", "driver").orderBy("round").rangeBetween(*earlier)
    wt = Window.partitionBy("year", "team").orderBy("round").rangeBetween(*earlier)
    exp = base.select(
        "*",
        F.avg("pos_change").over(wd).alias("season_avg_pos_delta"),
        F.avg("final_position").over(wd).alias("driver_strength"),
        F.avg("finish_flag").over(wd).alias("race_finish_pct"),
        F.avg("final_position").over(wt).alias("team_strength"),
    )
    keys = ["year", "round", "driver", "team"]
    j = got.alias("g").join(exp.alias("e"), keys)
    for c in ("season_avg_pos_delta", "driver_strength", "race_finish_pct", "team_strength"):
        diff = j.filter(
            ~(F.col(f"g.{c}").eqNullSafe(F.col(f"e.{c}")) | (F.abs(F.col(f"g.{c}") - F.col(f"e.{c}")) < 1e-9))
        ).count()
        assert diff == 0, c
    assert got.count() == base.count()

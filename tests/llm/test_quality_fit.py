"""The robust fit: its determinant against many random starts, its verdicts on planted
outliers in each statistic, the same fit by broadcast and by salted join."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitwall.llm import quality
from pitwall.llm.common import save

COLUMNS = "_rid bigint, lang string, source string, base_failed boolean, " + ", ".join(f"x{i} bigint" for i in range(5))


def clean(rng, n):
    rare = np.abs(rng.normal([[0.05], [0], [0]], [[0.03], [0.02], [0.02]], (3, n)))
    x = np.column_stack([rng.normal(6, 0.7, n), rng.normal(5, 0.3, n), *rare])
    return np.floor(x * quality.SCALE + 0.5).astype(int)


def frame(spark, whole):
    return save(spark.createDataFrame([(k, "en", "s", False, *map(int, r)) for k, r in enumerate(whole)], COLUMNS), "fit-test")


def spread(whole, mean, cov, steps):
    """Half the logarithm of the determinant after concentration steps in numpy."""
    z, ridge = whole / quality.SCALE, np.diag(np.square(quality.FLOORS))
    for _ in range(steps):
        d = np.einsum("ij,jk,ik->i", z - mean, np.linalg.inv(cov), z - mean)
        inner = z[np.argsort(d)[: int(np.ceil(len(z) * quality.H))]]
        mean, cov = inner.mean(0), quality.CONSISTENCY * np.cov(inner.T, bias=True) + ridge
    return np.linalg.slogdet(cov)[1] / 2


def test_determinant_is_as_small_as_that_of_many_starts(spark):
    rng = np.random.default_rng(1)
    whole = clean(rng, 500)
    whole[:200, 0] += 6000  # a second cloud that draws medians and quartiles to itself
    whole[:200, 1] += 4000
    fit = [r for r in quality.fit_mcd(frame(spark, whole)).collect() if '"=s"' in r["_g"]][0]
    ridge = np.diag(np.square(quality.FLOORS))
    best = np.inf
    for _ in range(200):
        some = whole[rng.choice(len(whole), 6, replace=False)] / quality.SCALE
        best = min(best, spread(whole, some.mean(0), np.cov(some.T, bias=True) + ridge, 10))
    assert fit.spread <= best + 0.02


@pytest.mark.parametrize("statistic, value", [(0, 12.0), (0, 1.0), (1, 8.5), (2, 0.6), (3, 0.95), (4, 0.547)])
def test_each_statistic_alone_can_reject(spark, statistic, value):
    whole = clean(np.random.default_rng(2), 600)
    whole[:30, statistic] = int(value * quality.SCALE)
    stats = frame(spark, whole)
    kept = {r._rid: r.kept for r in quality.scored(stats, quality.fit_mcd(stats)).collect()}
    assert not any(kept[k] for k in range(30))
    assert np.mean([kept[k] for k in range(30, 600)]) >= 0.98


def test_salted_join_gives_the_same_fit(spark, monkeypatch):
    whole = clean(np.random.default_rng(4), 300)
    stats = frame(spark, whole)
    one = quality.fit_mcd(stats, steps=2, starts=3).drop("_s")
    monkeypatch.setattr(quality, "FIT_ROWS", 0)
    monkeypatch.setattr(quality, "SALTS", 5)
    two = quality.fit_mcd(stats, steps=2, starts=3).drop("_s")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_rows_are_not_dealt_by_group(spark):
    """The hot group is aggregated where its rows lie: no exchange below the join."""
    stats = frame(spark, clean(np.random.default_rng(5), 300))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = stats.select("_rid", quality._groups(2).alias("_g"), *[f"x{i}" for i in range(5)])
        fit = quality.fit_mcd(stats, steps=1, starts=0)
        plan = quality.with_fit(rows, fit, 1).groupBy("_g").agg(F.sum("x0"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_small_tables_reject_nothing(spark):
    stats = frame(spark, clean(np.random.default_rng(6), 20))
    assert quality.scored(stats, quality.fit_mcd(stats)).where("not kept").isEmpty()
    fitted = quality.fit_mcd(stats, min_rows=10)
    assert fitted.count() == 3

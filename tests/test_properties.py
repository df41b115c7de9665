"""Property tests: the lap-time parser against a small Python model of the
rule, the as-of join and ranking against brute force on random inputs."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitwall.functions import text_to_seconds
from pitwall.operators.joins import asof_nearest


def model_seconds(text):
    """The parsing rule written directly in Python (test oracle)."""
    if text is None:
        return None
    s = text.strip()
    if s == "":
        return None
    if ":" in s:
        parts = s.split(":")
        if len(parts) != 2:
            return None
        m, sec = parts[0].strip(), parts[1].strip()
        if not (m.lstrip("+-").isdigit()):
            return None
        try:
            return int(m) * 60 + float(sec)
        except ValueError:
            return None
    try:
        return float(s)
    except ValueError:
        return None


TEXT = st.one_of(
    st.none(),
    st.builds(lambda m, s: f"{m}:{s:06.3f}", st.integers(0, 200), st.floats(0, 59.999, allow_nan=False)),
    st.builds(lambda x: f"{x:.3f}", st.floats(0, 10000, allow_nan=False)),
    st.builds(lambda m, s: f" {m}:{s} ", st.integers(-5, 5), st.integers(0, 59)),
    st.sampled_from(["", " ", "x", "1:2:3", ":", "1:", ":30", "12", "-1:30", "abc:12"]),
)


@settings(max_examples=30, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=25))
def test_time_parser_matches_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.s for r in df.select(text_to_seconds("t").alias("s")).collect()]
    for t, g in zip(texts, got):
        exp = model_seconds(t)
        if exp is None:
            assert g is None, t
        else:
            assert g == pytest.approx(exp, rel=1e-12, abs=1e-9), t


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_asof_random_timestamps(spark, seed):
    rng = random.Random(seed)
    users = list(range(6))
    base = 1_700_000_000
    left = [(i, rng.choice(users), base + rng.randint(0, 86400 * 3)) for i in range(200)]
    right = [(1000 + i, rng.choice(users[:4]), base + rng.randint(0, 86400 * 3) // 60 * 60) for i in range(80)]
    L = spark.createDataFrame(left, "event_id long, user_id long, secs long").select(
        "event_id", "user_id", F.timestamp_seconds("secs").alias("ts")
    )
    R = spark.createDataFrame(right, "view_id long, user_id long, secs long").select(
        "view_id", "user_id", F.timestamp_seconds("secs").alias("view_ts")
    )
    out = asof_nearest(L, R, ["user_id"], "ts", "view_ts", "view_id", bucket_width=3600.0)
    got = {r.event_id: r.view_id for r in out.collect()}
    assert len(got) == len(left)
    for eid, uid, t in left:
        cands = sorted((abs(rt - t), rt, rid) for rid, ru, rt in right if ru == uid)
        assert got[eid] == (cands[0][2] if cands else None)

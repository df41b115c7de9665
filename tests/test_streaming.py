"""The streaming collector writes the same records as the batch collector, however files
cut the sessions, and closes each driver-session once."""

import glob
import os
import time
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.plans.collection import RECORD_COLUMNS, lap_records
from pitwall.session import checkpoint_dir
from pitwall.sources import fixtures as FX
from pitwall.sources import io as IO
from pitwall.streaming.collect import LANDED_LAP_SCHEMA, start_collection

COLUMNS = [f.name for f in LANDED_LAP_SCHEMA.fields]
KEYS = ["year", "round", "session_type", "driver"]


@pytest.fixture(scope="module")
def race(spark, sf_small):
    """Race laps of one race and some of another, last laps marked."""
    laps = FX.lap_view(spark, sf_small).filter("session_type = 'R' and year = 1995 and (round = 1 or round = 2 and driver < 4)")
    ends = laps.groupBy(*KEYS).agg(F.max("lap_number").alias("_last"))
    return laps.join(ends, KEYS).withColumn("session_end", F.col("lap_number") == F.col("_last")).select(COLUMNS).cache()


def land(df, folder):
    df.select(COLUMNS).coalesce(1).write.mode("append").parquet(folder)


class Collector:
    def __init__(self, spark, weather, **options):
        self.spark, self.weather, self.options = spark, weather, options
        self.landed, self.sink = IO.new_scratch(spark, "landed"), IO.new_scratch(spark, "records")
        self.name = f"collect_{uuid.uuid4().hex[:8]}"

    def run(self):
        q = start_collection(
            self.spark, self.landed, self.weather, self.sink, query_name=self.name, files_per_trigger=1, available_now=True, **self.options
        )
        q.awaitTermination(300)
        assert q.exception() is None
        schema = lap_records(self.spark.createDataFrame([], LANDED_LAP_SCHEMA), self.weather).schema
        schema = schema.add("late", T.BooleanType()).add("epoch", T.IntegerType())
        return self.spark.read.schema(schema).parquet(self.sink)


def same(got, want):
    got, want = got.select(RECORD_COLUMNS), want.select(RECORD_COLUMNS)
    return got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_sessions_split_over_triggers_match_batch(spark, sf_small, race):
    weather = FX.weather_view(spark, sf_small)
    c = Collector(spark, weather)
    for part in (1, 0, 2):  # last laps do not come last, a driver-session is in three files
        land(race.filter(F.col("lap_number") % 3 == part), c.landed)
        got = c.run()
    # laps wait in the state over two triggers and leave together
    assert got.agg(F.min("epoch")).first()[0] == 2 and got.filter("late").isEmpty()
    assert same(got, lap_records(race, weather))
    assert got.groupBy(*KEYS).agg(F.count_distinct("grid_position").alias("n")).filter("n > 1").isEmpty()
    # a batch whose commit is lost is replayed and leaves the same rows
    commits = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "streams", c.name, "commits")
    last = max(int(os.path.basename(f)) for f in glob.glob(f"{commits}/[0-9]*"))
    for f in glob.glob(f"{commits}/{last}") + glob.glob(f"{commits}/.{last}.crc"):
        os.unlink(f)
    assert same(c.run(), lap_records(race, weather))


def test_unmarked_sessions_close_after_the_wait_and_late_laps_agree(spark, sf_small, race):
    weather = FX.weather_view(spark, sf_small)
    c = Collector(spark, weather, late_after_ms=500)
    unmarked = race.withColumn("session_end", F.lit(False))
    one = unmarked.groupBy(*KEYS).count().orderBy(F.desc("count"), *KEYS).first()
    mine = unmarked.filter((F.col("round") == one["round"]) & (F.col("driver") == one["driver"])).cache()
    other = unmarked.filter(F.col("driver") != one["driver"])
    last = mine.agg(F.max("lap_number")).first()[0]
    land(mine.filter(F.col("lap_number") < last), c.landed)
    assert c.run().isEmpty()  # not complete, and the wait is not over
    time.sleep(1)
    land(other.limit(1), c.landed)
    closed = c.run()
    want = lap_records(mine.filter(F.col("lap_number") < last), weather)
    assert same(closed, want)
    land(mine.filter(F.col("lap_number") == last), c.landed)
    time.sleep(1)
    got = c.run().filter((F.col("round") == one["round"]) & (F.col("driver") == one["driver"]))
    assert got.select("grid_position").distinct().count() == 1
    assert got.filter("late").count() == lap_records(mine, weather).filter(F.col("lap_number") == last).count()


def test_a_file_that_lands_twice_counts_once(spark, sf_small, race):
    weather = FX.weather_view(spark, sf_small)
    c = Collector(spark, weather)
    some = race.filter("round = 1")
    early = some.filter(F.col("lap_number") == 1)
    land(early, c.landed)
    land(early, c.landed)
    land(some.filter(F.col("lap_number") > 1), c.landed)
    got = c.run().filter("not late")
    assert same(got.filter("lap_number > 1"), lap_records(some, weather).filter("lap_number > 1"))
    assert got.groupBy(*KEYS, "lap_number").count().filter("count > 1").isEmpty()


def test_drivers_share_a_group_of_the_state(spark, sf_small, race, monkeypatch):
    """One bucket a session: fewer calls than driver-sessions, each of which still closes by itself."""
    from pitwall.streaming import collect

    monkeypatch.setattr(collect, "BUCKETS", 1)
    weather = FX.weather_view(spark, sf_small)
    c = Collector(spark, weather)
    held = race.filter("driver % 2 = 0 and lap_number = 1").cache()
    land(race.exceptAll(held), c.landed)
    got = c.run()
    waiting = [tuple(r) for r in held.select(KEYS).collect()]
    assert waiting and not {tuple(r) for r in got.select(KEYS).distinct().collect()} & set(waiting)
    land(held, c.landed)
    assert same(c.run(), lap_records(race, weather))
    kept = spark.read.format("statestore").load(os.path.join(checkpoint_dir(spark), "streams", c.name))
    assert kept.count() == race.select(KEYS[:3]).distinct().count()  # not one a driver

"""Incremental collection with Structured Streaming.

Landed lap files are picked up as they arrive, however they cut sessions. A stateful
operator holds each driver-session's laps until the session is complete: the lap
marked ``session_end`` has come and as many lap numbers as it counts, or no lap has
come for ``late_after_ms``. Then all its laps leave at once, with the one classified
position (the last non-NULL position in lap order) that the batch plan would give
them. Laps that come after that leave with the same position, marked late; so no
driver-session ever has two. State is keyed by session and bucket of drivers
(``BUCKETS`` a session), so a hot session spreads over its buckets, and holds each
driver-session apart; what a closed one keeps (its position) expires after
``forget_after_ms``.

Each micro-batch joins what left the state with the weather log by the batch job's
as-of join and writes a Parquet table partitioned by epoch, year and round. An
epoch's folder is overwritten and the state is versioned by epoch, so a batch
replayed after a lost commit leaves the same rows. Progress lives in the stream
checkpoint under the shared checkpoint folder, so a restarted query continues where
it stopped.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pitwall.operators.race import LAP_PARTITION
from pitwall.plans.collection import SESSION_TYPES, classified_records
from pitwall.session import checkpoint_dir

LATE_AFTER_MS = 10 * 60_000
FORGET_AFTER_MS = 7 * 24 * 3600_000
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"

LANDED_LAP_SCHEMA = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("round", T.IntegerType()),
        T.StructField("session_type", T.StringType()),
        T.StructField("driver", T.LongType()),
        T.StructField("team", T.IntegerType()),
        T.StructField("lap_time", T.DoubleType()),
        T.StructField("lap_time_text", T.StringType()),
        T.StructField("compound", T.StringType()),
        T.StructField("position", T.DoubleType()),
        T.StructField("track_status", T.IntegerType()),
        T.StructField("rainfall", T.IntegerType()),
        T.StructField("is_accurate", T.BooleanType()),
        T.StructField("start_time", T.DoubleType()),
        T.StructField("lap_number", T.IntegerType()),
        T.StructField("session_end", T.BooleanType()),
    ]
)


#: Groups a session's drivers are dealt to. A call costs milliseconds whatever it holds, so drivers share groups.
BUCKETS = 256
_SESSION = T.StructType([f for f in LANDED_LAP_SCHEMA.fields if f.name in LAP_PARTITION and f.name != "driver"])
_KEPT = T.StructType([f for f in LANDED_LAP_SCHEMA.fields if f.name not in LAP_PARTITION])

#: What leaves the state: a driver-session's landed laps, each as JSON, with its position.
LEAVING = "session string, driver bigint, laps array<string>, grid_position double, late boolean"


def is_complete(laps: list[dict]) -> bool:
    """Whether the marked last lap and as many lap numbers as it counts are there."""
    numbers = {lap["lap_number"] for lap in laps if "lap_number" in lap}
    ends = [lap["lap_number"] for lap in laps if lap.get("session_end") and "lap_number" in lap]
    return bool(ends) and len(numbers) >= max(ends)


def classified(laps: list[dict]) -> float | None:
    """The last position in lap order; NULL and NaN positions and unnumbered laps do not count."""
    placed = [lap for lap in laps if "lap_number" in lap and lap.get("position", "NaN") != "NaN"]
    return float(max(placed, key=lambda lap: lap["lap_number"])["position"]) if placed else None


def _driver_sessions(late_after_ms: int, forget_after_ms: int):
    """Holds the laps of a session's drivers of one bucket, each until complete. State: by
    driver the laps so far (JSON texts), whether it is closed, its position, and when its
    wait is over. One row a driver-session leaves."""

    def step(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else {}
        now, new, leaving = state.getCurrentProcessingTimeMs(), {}, []
        for part in () if state.hasTimedOut else rows:
            for driver, lap in zip(part["driver"].tolist(), part["lap"].tolist()):
                new.setdefault(str(driver), []).append(lap)
        for driver, come in new.items():
            laps, closed, grid, _ = held.get(driver, ([], False, None, 0))
            if closed:
                leaving.append((driver, come, grid, True))
                held[driver] = [], True, grid, now + forget_after_ms
                continue
            laps = list(dict.fromkeys(laps + come))  # a file may land twice
            read = [json.loads(lap) for lap in laps]
            if is_complete(read):
                leaving.append((driver, laps, classified(read), False))
                held[driver] = [], True, leaving[-1][2], now + forget_after_ms
            else:
                held[driver] = laps, False, None, now + late_after_ms
        for driver in [d for d, (_, _, _, due) in held.items() if due <= now and d not in new]:
            laps, closed, _, _ = held.pop(driver)
            if not closed:
                leaving.append((driver, laps, classified([json.loads(lap) for lap in laps]), False))
                held[driver] = [], True, leaving[-1][2], now + forget_after_ms
        if held:
            state.update((json.dumps(held),))
            state.setTimeoutDuration(max(1, min(due for _, _, _, due in held.values()) - now))
        else:
            state.remove()
        if leaving:
            drivers, laps, grids, late = zip(*leaving)
            grids = [float("nan") if g is None else g for g in grids]
            yield pd.DataFrame(
                {"session": key[0], "driver": list(map(int, drivers)), "laps": list(laps), "grid_position": grids, "late": list(late)}
            )

    return step


def classified_stream(laps: DataFrame, late_after_ms: int = LATE_AFTER_MS, forget_after_ms: int = FORGET_AFTER_MS) -> DataFrame:
    """Streamed landed laps -> laps of complete driver-sessions with grid_position and late.
    A lap passes through the state as one JSON text; its columns are read outside."""
    keyed = laps
    for k in LAP_PARTITION:
        keyed = keyed.filter(F.col(k).isNotNull())
    session = F.to_json(F.struct(*_SESSION.names)).alias("session")
    bucket = F.pmod(F.hash("driver"), F.lit(BUCKETS)).alias("bucket")
    texts = keyed.select(session, bucket, "driver", F.to_json(F.struct(*_KEPT.names)).alias("lap"))
    left = texts.groupBy("session", "bucket").applyInPandasWithState(
        _driver_sessions(late_after_ms, forget_after_ms),
        LEAVING,
        "held string",
        "append",
        GroupStateTimeout.ProcessingTimeTimeout,
    )
    left = left.select(F.from_json("session", _SESSION).alias("_session"), "driver", F.explode("laps").alias("_lap"), "grid_position", "late")
    left = left.withColumn("_lap", F.from_json("_lap", _KEPT))
    place = {"driver": F.col("driver"), **{c: F.col("_session")[c] for c in _SESSION.names}, **{c: F.col("_lap")[c] for c in _KEPT.names}}
    whole = [place[c].alias(c) for c in LANDED_LAP_SCHEMA.names]
    return left.select(*whole, F.nanvl("grid_position", F.lit(None)).alias("grid_position"), "late")


def start_collection(
    spark: SparkSession,
    landed_dir: str,
    weather: DataFrame,
    sink_dir: str,
    query_name: str = "lap_collection",
    files_per_trigger: int = 64,
    available_now: bool = False,
    late_after_ms: int = LATE_AFTER_MS,
    forget_after_ms: int = FORGET_AFTER_MS,
) -> StreamingQuery:
    """Start the incremental collector.

    ``weather`` is a static DataFrame (the weather log); every micro-batch is
    joined to it with the bucketed as-of join. ``available_now`` processes
    what has landed and stops (batch-style backfill with the same code path); sessions
    that are not complete by then stay in the state for the next run.
    """
    laps = (
        spark.readStream.schema(LANDED_LAP_SCHEMA)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(landed_dir)
        .filter(F.col("session_type").isin(SESSION_TYPES))
    )

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        # one folder per epoch, overwritten: a replayed batch leaves the same rows
        batch.persist()
        try:
            records = classified_records(batch, weather, "late")
            records.write.mode("overwrite").partitionBy("year", "round").parquet(f"{sink_dir}/epoch={epoch_id}")
        finally:
            batch.unpersist()

    ckpt = os.path.join(checkpoint_dir(spark), "streams", query_name)
    ready = classified_stream(laps, late_after_ms, forget_after_ms)
    writer = ready.writeStream.queryName(query_name).option("checkpointLocation", ckpt).foreachBatch(write_batch)
    writer = writer.outputMode("append")
    if not available_now:
        return writer.trigger(processingTime="30 seconds").start()
    # waits that end without new data would keep such a run alive for ever
    idle = spark.conf.get(NO_DATA_BATCHES)
    spark.conf.set(NO_DATA_BATCHES, "false")
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(NO_DATA_BATCHES, idle)

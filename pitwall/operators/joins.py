"""Join operators: joins sized at run time and the nearest-in-time as-of join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left") -> DataFrame:
    """Join ``big`` to an aggregated ``small`` side without a hint: adaptive
    execution broadcasts it when its bytes at run time are under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``, else the join stays a
    shuffle join whose hot partitions are split."""
    return big.join(small, on, how)


def _epoch_micros(col: Column, dtype_name: str) -> Column:
    if dtype_name == "timestamp_ntz":
        col = col.cast("timestamp")
    if dtype_name in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(col).cast("double")
    return col.cast("double")


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    left_time: str,
    right_time: str,
    right_id: str,
    bucket_width: float = 3600.0,
) -> DataFrame:
    """For every left row, the right row of the same ``by`` key whose time is
    nearest (no tolerance). Ties: the earlier right time, then the lower right
    id. Left rows with a NULL time or no right rows under their key get NULLs.

    Returns the left columns plus every right column except the ``by`` keys
    (right names must not collide with left names) and ``asof_distance``.

    Plan: no pairs are formed and nothing is exploded.
      1. right rows are reduced to one per (key, time) (lowest id wins);
      2. both sides are merged in time order inside (key, time bucket), and the
         last right row before and the first one after each left row are
         carried along the order: linear after the sort, however the rows of
         the two sides are distributed;
      3. for the ends of a bucket, the nearest right rows of other buckets come
         from a summary with one row per occupied (key, bucket).
    ``bucket_width`` (in the time column's unit, seconds for timestamps) bounds
    how much of a hot key meets in one task; it changes no result.
    """
    lt_type = left.schema[left_time].dataType.simpleString()
    rt_type = right.schema[right_time].dataType.simpleString()
    right_cols = [c for c in right.columns if c not in by]
    in_micros = lt_type in ("timestamp", "timestamp_ntz")
    width = float(bucket_width) * (1_000_000.0 if in_micros else 1.0)
    keys = [f"_k{i}" for i in range(len(by))]
    bucket = F.floor(F.col("_t") / F.lit(width)).cast("long").alias("_b")

    # 1. one candidate per (key, time)
    r = right.select(
        *[F.col(k).alias(a) for k, a in zip(by, keys)],
        _epoch_micros(F.col(right_time), rt_type).alias("_t"),
        F.struct(*[F.col(c) for c in right_cols]).alias("_rp"),
        F.col(right_id).alias("_rid"),
    ).dropna(subset=[*keys, "_t"])
    r = r.groupBy(*keys, "_t").agg(F.min_by("_rp", F.col("_rid")).alias("_rp"))
    r = r.select(*keys, "_t", bucket, F.struct("_t", "_rp").alias("_r"))

    # 2. merged order inside (key, bucket); right rows come first at equal times
    rows = left.select(
        *[F.col(k).alias(a) for k, a in zip(by, keys)],
        _epoch_micros(F.col(left_time), lt_type).alias("_t"),
        F.struct(*[F.col(c) for c in left.columns]).alias("_l"),
    )
    timed = rows.where("_t is not null").select("*", bucket)
    merged = r.unionByName(timed, allowMissingColumns=True).withColumn("_side", F.col("_l").isNotNull().cast("int"))
    here = Window.partitionBy(*keys, "_b")
    ahead = here.orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = here.orderBy(F.desc("_t"), F.desc("_side")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = merged.select(
        *keys, "_b", "_t", "_l", F.last("_r", True).over(ahead).alias("_prev"), F.last("_r", True).over(back).alias("_next")
    ).where("_l is not null")

    # 3. neighbours in other buckets: one row per occupied (key, bucket)
    ends = r.groupBy(*keys, "_b").agg(F.min_by("_r", "_t").alias("_first"), F.max_by("_r", "_t").alias("_last"))
    ends = ends.unionByName(timed.select(*keys, "_b").distinct(), allowMissingColumns=True)
    ends = ends.groupBy(*keys, "_b").agg(F.max("_first").alias("_first"), F.max("_last").alias("_last"))
    per_key = Window.partitionBy(*keys)
    before = per_key.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    after = per_key.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(
        *[F.col(k).alias(f"_e{k}") for k in keys], F.col("_b").alias("_eb"),
        F.last("_last", True).over(before).alias("_far_prev"), F.last("_first", True).over(after).alias("_far_next"),
    )
    cond = F.col("_b") == F.col("_eb")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_e{k}"))
    j = merged.join(ends, cond, "left")
    j = j.withColumn("_p", F.coalesce("_prev", "_far_prev")).withColumn("_n", F.coalesce("_next", "_far_next"))
    t, pt, nt = F.col("_t"), F.col("_p._t"), F.col("_n._t")
    best = F.when(nt.isNull() | (t - pt <= nt - t), F.col("_p")).otherwise(F.col("_n")).alias("_best")
    untimed = rows.where("_t is null").select("_l", "_t", F.lit(None).cast(r.schema["_r"].dataType).alias("_best"))
    j = j.select("_l", "_t", best).unionAll(untimed)
    dist = F.abs(F.col("_best._t") - F.col("_t"))
    if in_micros:
        dist = dist / F.lit(1_000_000.0)
    return j.select(
        *[F.col("_l")[c].alias(c) for c in left.columns],
        *[F.col("_best._rp")[c].alias(c) for c in right_cols],
        dist.alias("asof_distance"),
    )

"""Exact row numbers inside groups, and ranking of predictions in a race.

``row_numbers`` is ``row_number() over (partition by keys order by ...)``
without a window over a whole group, so one group holding a third of all
rows still spreads over many tasks:

  1. rows are range-partitioned on (keys, order) and sorted inside each
     partition: a large group covers a run of consecutive partitions;
  2. one Arrow pass per partition numbers the rows of each group locally
     (the partition is sorted, so a group is a contiguous run of rows) and
     the result is checkpointed, so the numbering is fixed once;
  3. a summary with one row per non-empty partition (first key, last key
     and its local count) gives every partition the count of its first
     group in the partitions before it. That table is bounded by the
     partition count, so it is broadcast; the rows never shuffle again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RACE = ["year", "round"]

# Largest group a plain window may hold in one task; a larger group (a hot
# key) is numbered by the distributed path of :func:`row_numbers`.
WINDOW_MAX_GROUP_ROWS = 1_000_000


def _local_numberer(keys: list[str]):
    """mapInArrow body: per sorted partition, append the partition id, the
    1-based row number inside the current key run and the row position.
    Self-contained (imports inside), so executors need no pitwall install."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        def same_key(x, y):
            return all((a is None and b is None) or (a is not None and a == b) for a, b in zip(x, y))

        pid = TaskContext.get().partitionId()
        last, run_len, pos = None, 0, 0
        for rb in batches:
            m = rb.num_rows
            if m == 0:
                continue
            same = np.ones(m, dtype=bool)
            for c in keys:
                col = rb.column(c)
                a, b = col.slice(1), col.slice(0, m - 1)
                eq = pc.or_(
                    pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b))
                )
                same[1:] &= eq.to_numpy(zero_copy_only=False)
            first = [rb.column(c)[0].as_py() for c in keys]
            same[0] = last is not None and same_key(first, last)
            idx = np.arange(m, dtype=np.int64)
            start = np.maximum.accumulate(np.where(same, 0, idx))
            lrn = idx - start + 1
            lrn[np.cumsum(~same) == 0] += run_len  # rows continuing the last run
            run_len = int(lrn[-1])
            last = [rb.column(c)[m - 1].as_py() for c in keys]
            yield pa.RecordBatch.from_arrays(
                [*rb.columns, pa.array(np.full(m, pid, dtype=np.int32)), pa.array(lrn), pa.array(idx + pos)],
                names=[*rb.schema.names, "_pid", "_lrn", "_pos"],
            )
            pos += m

    return run


def row_numbers(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    name: str,
    partitions: int | None = None,
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``name`` = 1-based row number inside each group of ``keys`` under
    ``order`` (which should be total; tied rows are numbered in an arbitrary
    order). NULL keys form groups like any value. Columns in ``drop`` are
    used for ordering only and removed before the numbering pass."""
    from pitwall.plans.features import materialise

    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kcols = [F.col(c).asc_nulls_first() for c in keys]
    out_cols = [c for c in df.columns if c not in drop]
    ranged = df.repartitionByRange(n, *kcols, *order).sortWithinPartitions(*kcols, *order)
    ranged = ranged.select(*out_cols)
    schema = T.StructType(
        [
            *ranged.schema.fields,
            T.StructField("_pid", T.IntegerType(), False),
            T.StructField("_lrn", T.LongType(), False),
            T.StructField("_pos", T.LongType(), False),
        ]
    )
    s = materialise(ranged.mapInArrow(_local_numberer(list(keys)), schema))
    key = F.struct(*[F.col(c) for c in keys])
    summ = s.groupBy("_pid").agg(
        F.min_by(key, "_pos").alias("_fk"),
        F.max_by(F.struct(key.alias("k"), F.col("_lrn").alias("n")), "_pos").alias("_last"),
    )
    # at most one row per partition from here on
    run = Window.partitionBy(F.col("_last.k")).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    summ = summ.select("_pid", "_fk", F.col("_last.k").alias("_lk"), F.sum("_last.n").over(run).alias("_cum"))
    seq = Window.orderBy("_pid")
    offsets = summ.select(
        "_pid",
        "_fk",
        F.when(F.lag("_lk").over(seq).eqNullSafe(F.col("_fk")), F.lag("_cum").over(seq))
        .otherwise(F.lit(0))
        .alias("_off"),
    )
    j = s.join(F.broadcast(offsets), "_pid")
    number = F.col("_lrn") + F.when(key.eqNullSafe(F.col("_fk")), F.col("_off")).otherwise(F.lit(0))
    return j.select(*out_cols, number.cast("bigint").alias(name))


def number_rows(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    name: str,
    drop: tuple[str, ...] = (),
    max_group_rows: int | None = None,
) -> DataFrame:
    """``row_number() over (partition by keys order by ...)`` behind a size
    check: the largest group is counted first (a partial aggregate, one row
    per group before the max). Up to ``max_group_rows`` the plain window is
    used (one hash exchange, prunable when the number is unused); above it,
    the distributed :func:`row_numbers`. The default limit is read from
    ``WINDOW_MAX_GROUP_ROWS`` at call time."""
    limit = WINDOW_MAX_GROUP_ROWS if max_group_rows is None else max_group_rows
    biggest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if biggest > limit:
        return row_numbers(df, keys, order, name, drop=drop)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w).cast("bigint")).drop(*drop)


def ordered_rank(
    df: DataFrame, race: list[str], order: list[Column], name: str, partitions: int | None = None
) -> DataFrame:
    """Add ``name`` = 1-based row number of each row inside its race under
    ``order`` (which should be total; ties otherwise get an arbitrary order).
    ``partitions`` forces the distributed path over that many partitions."""
    if partitions:
        return row_numbers(df, list(race), order, name, partitions)
    return number_rows(df, list(race), order, name)


def rank_race_time(
    df: DataFrame, score: str, race: list[str] = RACE, tiebreak: list[str] = ("driver",)
) -> DataFrame:
    """PredRacePos: 1 = fastest predicted time inside each race; ties keep the
    tie-break order; a NULL prediction is left unranked (NULL)."""
    s = F.col(score)
    order = [s.asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tiebreak]]
    ranked = ordered_rank(df, list(race), order, "_rank")
    return ranked.select(
        *df.columns, F.when(s.isNotNull(), F.col("_rank")).cast("bigint").alias("pred_race_pos")
    )


def rank_final_position(
    df: DataFrame,
    delta: str = "pred_delta",
    grid: str = "start_grid",
    race: list[str] = RACE,
    tiebreak: list[str] = ("driver",),
) -> DataFrame:
    """PredScore = start_grid - predicted delta (lower is better), then
    PredFinalPosition numbered 1..n by (score, start_grid, driver); NULL scores
    come last. Needs a grid column (ValueError otherwise)."""
    if grid not in df.columns:
        raise ValueError(f"position ranking needs a '{grid}' column in the sheet")
    scored = df.withColumn("pred_score", F.col(grid) - F.col(delta))
    order = [
        F.col("pred_score").asc_nulls_last(),
        F.col(grid).asc_nulls_last(),
        *[F.col(c).asc_nulls_last() for c in tiebreak],
    ]
    return ordered_rank(scored, list(race), order, "pred_final_position")


def prev_next(
    df: DataFrame,
    keys: list[str],
    order: str,
    value: str,
    prev_name: str | None = None,
    next_name: str | None = None,
    max_group_rows: int | None = None,
) -> DataFrame:
    """Previous / next ``value`` in ``order`` inside each group of ``keys``
    (NULL at the ends; ``order`` should be unique inside a group).

    Size-checked like :func:`number_rows`: ``lag``/``lead`` over a window
    while the largest group is within the limit; above it the rows are
    numbered by the distributed path and neighbours come from equi-joins on
    (keys, index -+ 1), null-safe on the keys."""
    limit = WINDOW_MAX_GROUP_ROWS if max_group_rows is None else max_group_rows
    biggest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if biggest <= limit:
        w = Window.partitionBy(*keys).orderBy(order)
        extra = []
        if prev_name:
            extra.append(F.lag(value).over(w).alias(prev_name))
        if next_name:
            extra.append(F.lead(value).over(w).alias(next_name))
        return df.select("*", *extra)
    cols = df.columns
    out = row_numbers(df, keys, [F.col(order)], "_nb_i")
    nkeys = [f"_nb_k{i}" for i in range(len(keys))]
    for step, name in ((-1, prev_name), (1, next_name)):
        if not name:
            continue
        side = out.select(
            *[F.col(k).alias(a) for k, a in zip(keys, nkeys)],
            (F.col("_nb_i") - step).alias("_nb_at"),
            F.col(value).alias(name),
        )
        cond = F.col("_nb_i") == F.col("_nb_at")
        for k, a in zip(keys, nkeys):
            cond = cond & F.col(k).eqNullSafe(F.col(a))
        out = out.join(side, cond, "left").drop(*nkeys, "_nb_at")
    return out.select(*cols, *[n for n in (prev_name, next_name) if n])

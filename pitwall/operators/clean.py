"""Column hygiene for the feature table: sparse drop, means, imputation,
feature/target split and the deterministic hold-out / fold assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.functions import named

# The reference's sparse threshold, identifier columns, targets,
# split seed / share and fold count.
MISSING_THRESHOLD = 0.70
ALWAYS_KEEP = ("best_quali_time",)
ID_COLS = ["driver", "team", "year", "round", "final_position", "winner"]
LAP_TIME_TARGET = "race_avg_lap"
POSITION_TARGET = "position_delta"
RANDOM_SEED = 42
TEST_SHARE_HEX = "33333333"  # first 8 hex digits below this: 0x33333333 / 2**32 = 0.2
CV_FOLDS = 5
# Documented pre-race feature sets of the two predictors.
PRERACE_LAP_TIME = ["start_grid", "best_quali_time", "season_avg_pos_delta"]
PRERACE_POSITION = [
    "start_grid",
    "best_quali_time",
    "season_avg_pos_delta",
    "race_finish_pct",
    "driver_strength",
    "team_strength",
]


def _missing(df: DataFrame, name: str) -> Column:
    c = named(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return (c.isNull() | F.isnan(c)).cast("double")
    return c.isNull().cast("double")


def sparse_report(
    df: DataFrame, threshold: float = MISSING_THRESHOLD, keep=ALWAYS_KEEP
) -> DataFrame:
    """(column_name, null_frac, dropped) for every column, from one aggregate pass."""
    fr = df.agg(*[F.avg(_missing(df, c)).alias(c) for c in df.columns])
    long = fr.unpivot([], [named(c) for c in df.columns], "column_name", "null_frac")
    return long.select(
        "column_name",
        "null_frac",
        F.coalesce(
            (F.col("null_frac") > threshold) & ~F.col("column_name").isin(list(keep)), F.lit(False)
        ).alias("dropped"),
    )


def drop_sparse_columns(
    df: DataFrame, threshold: float = MISSING_THRESHOLD, keep=ALWAYS_KEEP
) -> DataFrame:
    """Drop columns whose missing share exceeds ``threshold`` (strictly).

    The schema decision needs the report on the driver: one row per column.
    """
    rows = sparse_report(df, threshold, keep).filter("dropped").select("column_name").collect()
    return df.drop(*[r.column_name for r in rows])


def with_position_target(df: DataFrame) -> DataFrame:
    """position_delta = start_grid - final_position (KeyError without them)."""
    missing = [c for c in ("start_grid", "final_position") if c not in df.columns]
    if missing:
        raise KeyError(f"both 'start_grid' and 'final_position' are needed, missing {missing}")
    return df.withColumn(POSITION_TARGET, F.col("start_grid") - F.col("final_position"))


def feature_columns(df: DataFrame, target: str, feature_set: str = "prerace") -> list[str]:
    """Model inputs: the documented pre-race set, or every numeric column that
    is neither an identifier nor the target (``feature_set='all'``)."""
    if target not in df.columns:
        raise KeyError(f"{target} missing from the feature table")
    if feature_set == "prerace":
        wanted = PRERACE_POSITION if target == POSITION_TARGET else PRERACE_LAP_TIME
        return [c for c in wanted if c in df.columns]
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    return [c for c in df.columns if c not in ID_COLS and c != target and c in numeric]


def column_means(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column: (feature, mean) over all rows, one aggregate pass."""
    wide = df.agg(*[F.avg(named(c).cast("double")).alias(c) for c in cols])
    return wide.unpivot([], [named(c) for c in cols], "feature", "mean")


def mean_impute(df: DataFrame, cols: list[str], means: dict[str, float] | None = None) -> DataFrame:
    """Replace NULL in ``cols`` with the column mean over all rows; a column
    with no values falls back to 0.0.

    The means are one scalar per column (computed in one aggregate pass when
    not given) and enter the plan as literals, so no join is needed.
    """
    if means is None:
        row = df.agg(*[F.avg(named(c).cast("double")).alias(c) for c in cols]).first()
        means = {c: row[c] for c in cols}
    return df.select(
        *[
            F.coalesce(
                named(c).cast("double"),
                F.lit(float(means[c]) if means.get(c) is not None else 0.0),
            ).alias(c)
            if c in cols
            else named(c)
            for c in df.columns
        ]
    )


def _hash_hex(keys: list[str], seed: int) -> Column:
    parts = [F.col(k).cast("string") for k in keys] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts))


def holdout_split(df: DataFrame, keys: list[str], seed: int = RANDOM_SEED) -> DataFrame:
    """is_test = first 8 hex digits of md5(keys|seed) < '33333333' (20% share).

    Deterministic per row under any partitioning, unlike randomSplit.
    """
    h = _hash_hex(keys, seed)
    return df.withColumn("is_test", F.substring(h, 1, 8) < F.lit(TEST_SHARE_HEX))


_HEX = "0123456789abcdef"


def cv_folds(df: DataFrame, keys: list[str], k: int = CV_FOLDS, seed: int = RANDOM_SEED) -> DataFrame:
    """fold in [0, k) from hex digits 9-10 of the same md5 (independent of the
    hold-out digits)."""
    h = _hash_hex(keys, seed)
    hi = F.instr(F.lit(_HEX), F.substring(h, 9, 1)) - 1
    lo = F.instr(F.lit(_HEX), F.substring(h, 10, 1)) - 1
    return df.withColumn("fold", ((hi * 16 + lo) % k).cast("int"))

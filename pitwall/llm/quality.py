"""Quality rules with robust multivariate outlier rejection (native Spark).

Counts of each text become a vector of ``P`` transformed statistics. For each
(language, source) the minimum covariance determinant estimate is searched from
several starts: medians with quartile ranges, and ``STARTS`` elemental subsets of
P + 1 rows (those with the least hashes). Concentration steps refit mean and
covariance on the ``H`` share of rows with the smallest Mahalanobis distance; each
lowers the determinant. After ``STEPS`` of them the start with the least determinant
goes on for as many more, and its estimate is the group's. A row is rejected when
its squared distance from the fit exceeds ``CUTOFF``.

All of it is DataFrame work. A step is one aggregate over (group, start, distance
bin); the bins are at most some thousand, so the h-subset is found by a running sum
over bins, never by sorting a group. The fits (a few numbers per group and start) are
broadcast where they are at most ``FIT_ROWS``, so rows are aggregated where they lie
and a hot source only means more partial aggregates; with more groups than that,
rows and fits are joined on (group, salt). Statistics are held as integers (``SCALE``
steps), so sums are exact and the verdicts do not depend on how rows are partitioned.

A group with fewer than ``min_rows`` rows that pass the base rules uses its
language's fit, then the fit over all rows; if that is too small as well, the
method rejects nothing. ``FLOORS`` (the least standard deviations) are added to
the covariance, so constant statistics do not make it singular and a deviation
must be large in absolute terms as well; each statistic alone can pass the cutoff.

Defined results: a null text has no words and fails the base rules; null
language or source is a group of its own; repeated rows each get a row. An
empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import row_id, save

P = 5
PAIRS = [(i, k) for i in range(P) for k in range(i + 1)]
SCALE = 1000
H = 0.75
#: H / P(chi2 with P + 2 degrees <= chi2 quantile H with P degrees): makes the
#: covariance of the inner H share consistent for normal data.
CONSISTENCY = 1.41
STEPS = 5
STARTS = 15
MIN_ROWS = 100
#: Fits of some 200 bytes that are broadcast at most; salts of a join beyond that.
FIT_ROWS, SALTS = 100_000, 64
#: ln words, word length, share of symbols, of equal lines, of repeated words
FLOORS = (0.6, 0.35, 0.05, 0.18, 0.1)
#: Chi-square with P degrees exceeds this with probability 1.4e-4; FLOORS make it rarer.
CUTOFF = 25.0
BINS_PER_OCTAVE = 64

SPACE = r"[\x20\x09-\x0D]"


def base_stats(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` plus n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines of each text."""
    text = F.coalesce(text_col, F.lit(""))
    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    first = docs.select(
        *keep,
        words.alias("_w"),
        lines.alias("_lines"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
    )
    windows = F.when(
        F.size("_w") >= 8,
        F.transform(F.sequence(F.lit(1), F.size("_w") - 7), lambda i: F.xxhash64(F.slice("_w", i, 8))),
    ).otherwise(F.array().cast("array<bigint>"))
    second = first.select(
        *keep,
        F.size("_w").cast("bigint").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        windows.alias("_h"),
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    # most texts repeat no window: only the others sort theirs
    some = F.size(F.array_distinct("_h")) < F.size("_h")
    ranked = F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    third = second.select(*keep, *counts, F.when(some, ranked).alias("_s"))

    def twice(j):
        here = F.get("_s", j)["h"]
        return (here == F.get("_s", j - 1)["h"]) | (here == F.get("_s", j + 1)["h"])

    places = F.filter(F.sequence(F.lit(0), F.size("_s") - 1), lambda j: F.coalesce(twice(j), F.lit(False)))
    places = F.array_sort(F.transform(places, lambda j: F.get("_s", j)["i"]))
    fourth = third.select(*keep, *counts, F.when(F.col("_s").isNotNull(), places).alias("_p"))
    # a place covers 8 words, or as many as there are before the next place
    step = F.transform(
        "_p", lambda p, k: F.least(F.lit(8), F.coalesce(F.get("_p", k + 1) - p, F.lit(8))).cast("bigint")
    )
    covered = F.coalesce(F.aggregate(step, F.lit(0).cast("bigint"), lambda a, b: a + b), F.lit(0).cast("bigint"))
    return fourth.select(*keep, *counts, covered.alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def transformed() -> list[Column]:
    """The statistics x0..x4, in whole SCALE steps."""
    n = F.col("n_words").cast("double")
    x = [
        F.log1p(n),
        (F.col("word_chars") + 200) / (n + 40),  # drawn to 5 where words are few
        F.sqrt(F.col("n_symbols") / (F.col("word_chars") + 100)),
        F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 1)),
        F.sqrt(F.col("n_repeat_words") / (n + 1)),
    ]
    # sqrt and ratios are exact to the last bit; log1p is held well inside a step
    return [F.floor(v * SCALE + 0.5).cast("bigint").alias(f"x{i}") for i, v in enumerate(x)]


def _inverse_root(fit: DataFrame) -> DataFrame:
    """w_ik, the inverse of the Cholesky root of the covariance c_ik, and ``spread``,
    half the logarithm of its determinant."""
    for k in range(P):  # a column of the root at a time
        rest = {i: f"c{i}{k}" + "".join(f" - l{i}{j} * l{k}{j}" for j in range(k)) for i in range(k, P)}
        fit = fit.selectExpr("*", f"sqrt({rest[k]}) as l{k}{k}")
        fit = fit.selectExpr("*", *[f"({rest[i]}) / l{k}{k} as l{i}{k}" for i in range(k + 1, P)])
    for i in range(P):  # a row of its inverse at a time
        row = []
        for k in range(i + 1):
            terms = "".join(f" - l{i}{j} * w{j}{k}" for j in range(k, i))
            row.append(f"({float(i == k)}D{terms}) / l{i}{i} as w{i}{k}")
        fit = fit.selectExpr("*", *row)
    spread = " + ".join(f"ln(l{i}{i})" for i in range(P))
    return fit.selectExpr("_g", "_s", "rows", *[f"m{i}" for i in range(P)], *[f"w{i}{k}" for i, k in PAIRS], f"{spread} as spread")


def _distance() -> str:
    """The squared Mahalanobis distance, as SQL."""
    rows = []
    for i in range(P):
        y = " + ".join(f"w{i}{k} * (x{k} / {SCALE}D - m{k})" for k in range(i + 1))
        rows.append(f"pow({y}, 2)")
    return " + ".join(rows)


def _groups(level: int) -> Column:
    """Key of a row's group: all rows, its language, its language and source."""
    part = [F.coalesce(F.concat(F.lit("="), c), F.lit("-")) for c in ("lang", "source")]
    return F.to_json(F.array(F.lit("all"), *part[:level]))


_SUMS = ["n", *[f"s{i}" for i in range(P)], *[f"s{i}{k}" for i, k in PAIRS]]
_TERMS = ["1", *[f"x{i}" for i in range(P)], *[f"x{i} * x{k}" for i, k in PAIRS]]


def _estimate(sums: DataFrame, consistency: float) -> DataFrame:
    """The fit of summed statistics (_g, _s, rows and ``_SUMS``)."""
    means = sums.selectExpr("*", *[f"s{i} / n / {SCALE}D as m{i}" for i in range(P)])
    cov = [
        f"{consistency}D * (s{i}{k} / n / {SCALE**2}D - m{i} * m{k}) + {FLOORS[i] ** 2 if i == k else 0.0}D as c{i}{k}"
        for i, k in PAIRS
    ]
    return _inverse_root(means.selectExpr("*", *cov))


def with_fit(rows: DataFrame, fit: DataFrame, fits: int) -> DataFrame:
    """Each row with the fits of its group, one per start."""
    if fits <= FIT_ROWS:
        return rows.join(F.broadcast(fit), "_g")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_rid"), F.lit(SALTS)).cast("int"))
    return salted.join(fit.withColumn("_salt", salts), ["_g", "_salt"])


def _concentrated(rows: DataFrame, fit: DataFrame, fits: int, steps: int) -> DataFrame:
    """``fit`` after ``steps`` refits on the rows nearest to it."""
    for _ in range(steps):
        cell = F.expr(f"cast(floor(log2(1 + {_distance()}) * {BINS_PER_OCTAVE}) as int) as _bin")
        binned = with_fit(rows, fit, fits).groupBy("_g", "_s", "rows", cell)
        binned = binned.agg(*[F.expr(f"sum({v}) as {c}") for c, v in zip(_SUMS, _TERMS)])
        nearer = "sum(n) over (partition by _g, _s order by _bin rows between unbounded preceding and 1 preceding)"
        inner = binned.selectExpr("*", f"coalesce({nearer}, 0) as _before").where(f"_before < ceil(rows * {H}D)")
        sums = inner.groupBy("_g", "_s", "rows").agg(*[F.expr(f"sum({c}) as {c}") for c in _SUMS])
        fit = save(_estimate(sums, CONSISTENCY), "quality-fit")
    return fit


def fit_mcd(stats: DataFrame, steps: int = STEPS, starts: int = STARTS, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per group of at least ``min_rows`` rows: _g, rows, the mean, the inverse
    root of the MCD covariance and spread. ``stats`` has _rid, lang, source, x0..x4."""
    xs = [f"x{i}" for i in range(P)]
    rows = stats.select("_rid", F.explode(F.array(*[_groups(k) for k in range(3)])).alias("_g"), *xs)
    rows = save(rows, "quality-rows")
    # exact percentiles of integers: the state is one count per distinct value
    start = rows.groupBy("_g").agg(
        F.expr("count(1) as rows"), *[F.expr(f"percentile({x}, array(0.25, 0.5, 0.75)) as q{i}") for i, x in enumerate(xs)]
    )
    start = save(start.where(F.col("rows") >= min_rows), "quality-start")
    spread = [f"pow((q{i}[2] - q{i}[0]) / {1.349 * SCALE}D, 2) + {FLOORS[i] ** 2}D as c{i}{i}" for i in range(P)]
    middle = start.selectExpr(
        "_g", "0 as _s", "rows", *[f"q{i}[1] / {SCALE}D as m{i}" for i in range(P)], *spread, *[f"0D as c{i}{k}" for i, k in PAIRS if i != k]
    )
    fit = _inverse_root(middle)
    if starts:
        by_hash = "row_number() over (partition by _g order by xxhash64(_rid), _rid)"
        few = rows.selectExpr("*", f"{by_hash} as _n").where(f"_n <= {starts * (P + 1)}")  # cut to these before the shuffle
        few = few.join(start.select("_g", "rows"), "_g").withColumn("_s", F.expr(f"cast((_n + {P}) div {P + 1} as int)"))
        few = few.groupBy("_g", "_s", "rows").agg(*[F.expr(f"sum({v}) as {c}") for c, v in zip(_SUMS, _TERMS)])
        fit = fit.unionAll(_estimate(few.where(f"n = {P + 1}"), 1.0))
    fit = save(fit, "quality-fit")
    fits = fit.count()
    fit = _concentrated(rows, fit, fits, steps)
    first = F.min(F.struct("spread", "_s", *[c for c in fit.columns if c not in ("_g", "_s", "spread")])).alias("b")
    best = fit.groupBy("_g").agg(first).select("_g", *[f"b.{c}" for c in fit.columns if c != "_g"])
    return _concentrated(rows, save(best, "quality-fit"), fits, steps)


def scored(stats: DataFrame, fit: DataFrame) -> DataFrame:
    """Adds distance and kept, by the finest fit that a row's groups have."""
    out, values = stats, [c for c in fit.columns if c not in ("_g", "_s", "rows", "spread")]
    small = fit.count() <= FIT_ROWS
    for k in range(3):
        level = fit.select(F.col("_g").alias(f"_g{k}"), F.struct(*values).alias(f"_f{k}"))
        if k == 0:  # one row at most: a value, not a join
            top = level.where(F.col("_g0") == _groups(0)).first()
            whole = F.struct(*[F.lit(top[1][c]).cast("double").alias(c) for c in values]) if top else F.lit(None).cast(level.schema[1].dataType)
            out = out.withColumn("_f0", whole)
        else:
            out = out.join(F.broadcast(level) if small else level, _groups(k) == F.col(f"_g{k}"), "left")
    out = out.withColumn("_f", F.coalesce("_f2", "_f1", "_f0")).select(*stats.columns, "_f.*")
    out = out.withColumn("distance", F.expr(_distance()))
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF))


def with_stats(docs: DataFrame, keep: list[str]) -> DataFrame:
    return base_stats(docs, [*keep, "lang", "source"]).select("*", base_failed().alias("base_failed"), *transformed())


def quality(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs`` (id, text, lang, source): the id, the base
    counts, base_failed, distance (null where no fit is large enough), kept,
    and _rid (the row's place)."""
    return quality_rows(docs.select(row_id(), id_col, "text", "lang", "source"), id_col)


def quality_rows(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The same for rows (_rid, id, text, lang, source)."""
    # stored first: a filter pushed below the statistics would repeat their expressions
    stats = save(with_stats(rows, ["_rid", id_col]), "quality-stats")
    return scored(stats, fit_mcd(stats.where("not base_failed"))).select(
        id_col,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "distance",
        "kept",
        "_rid",
    )


def query(spark, sf_dir):
    from pitwall.llm.common import table

    return quality(table(spark, sf_dir, "documents")).withColumn("distance", F.round("distance", 3)).drop("_rid")

"""The training-data pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), where docs is a stored table, and works
on all rows that its predecessor kept. All but the last return the columns of
docs; the last returns the packed pieces. Empty tables pass through; extra
columns are carried along whatever their names. Rows with nulls follow the stages'
operators; repeated rows are rows of their own until a dedup stage drops them, and
of rows that tie one stays. A stage stores its rows once for its passes; the next
stage call in the session deletes them, so write a result before calling on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.common import drop, save, stored_rows, table
from pitwall.llm.exact_dedup import exact_rows
from pitwall.llm.jaccard_join import near_rows
from pitwall.llm.packing import pack
from pitwall.llm.quality import quality_rows
from pitwall.llm.secret_scan import secret_spans


#: Rows that a stage stored; its written result no longer needs them.
_held: list[DataFrame] = []


def _free(docs: DataFrame) -> None:
    """Drops what earlier stages stored, unless ``docs`` still reads it (as when it was
    not written and reread)."""
    if _held:
        read = " ".join(docs.inputFiles())
        for rows in [r for r in _held if r._scratch.rsplit("/", 1)[1] not in read]:
            _held.remove(rows)
            if rows.sparkSession.sparkContext is docs.sparkSession.sparkContext:  # else it ended with its session
                drop(rows)


def _kept(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], *columns: str) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps. It gets _rid and ``columns`` of the
    rows that are stored here, and the rows it drops are taken from the same table."""
    _free(docs)
    rows = stored_rows(docs, F.struct("*").alias("_row"))
    _held.append(rows)
    judged = judge(rows.select("_rid", *[F.col("_row").getField(c).alias(c) for c in columns]))
    gone = judged.where("not kept").select(F.col("_rid").alias("_gone"))
    return rows.join(gone, F.col("_rid") == F.col("_gone"), "left_anti").select("_row.*")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust distance reject go."""
    return _kept(docs, quality_rows, "doc_id", "text", "lang", "source")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal documents the one with the largest doc_id stays."""
    return _kept(docs, exact_rows, "doc_id", "text")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the one with the least doc_id stays."""
    return _kept(docs, near_rows, "doc_id", "text")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced by [SECRET]; no document goes."""
    _free(docs)
    rows = docs.select(F.struct("*").alias("_row"), "text")
    found = secret_spans(rows, "_row").select("_row", "redacted")
    changed = F.col("redacted").isNotNull()
    columns = []
    for c in docs.columns:
        old = F.col("_row").getField(c)
        if c == "text":
            old = F.coalesce("redacted", old)
        elif c == "n_chars":
            old = F.when(changed, F.length("redacted")).otherwise(old).cast(docs.schema[c].dataType)
        columns.append(old.alias(c))
    return found.select(*columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("jaccard_join", near_stage),
    ("secret_scans", secret_stage),
    ("packing", packing_stage),
]

#: Robust fits and tokenizers cannot be put in SQL; tests/llm holds the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

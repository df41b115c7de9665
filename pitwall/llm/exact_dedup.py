"""Exact dedup by deterministic block naming.

The normalised text (A-Z lower-cased) is cut into blocks of ``block_bytes``
bytes. All blocks are sorted and each distinct block gets an integer name;
then adjacent names are paired and each distinct pair is named again, until
each document has one name. Two documents that end in the same round with the
same name are equal byte for byte: a name stands for exactly one block or one
pair of names, so no digest can collide. 0 stands for "no right neighbour"
(names start at 1), so lengths cannot be confused.

One shuffle moves the text itself (the sort of the blocks); later rounds move
names, halving each time: log2 of the longest document rounds. The sort is a
range partition on (hash of the block, row), so a block that a third of all rows
share covers many partitions and no block is sampled to the driver; inside a
partition whole blocks are compared. ``_rid`` is the place of a row in its input split,
stored once for all passes. Each round adds the documents that end in it to one stored
table: read together at the end, all rounds' numbers would be made at once, and the
driver's memory would follow the number of rounds.

Defined results: null counts as empty, and empty texts are equal. Of rows that
also share the largest doc_id exactly one stays (the last read). A null doc_id
is smaller than any other. Only doc_id and text are read; other columns do not
matter. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import LOWER, numbered, row_id, rows_of, save

BLOCK_BYTES = 1024

_BLOCKS = "_rid bigint, doc_id bigint, text_sha256 string, _pos int, _left int, _block binary"


def _blocker(block_bytes: int):
    def run(batches):
        import hashlib

        import pyarrow as pa

        types = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary()]
        names = ["_rid", "doc_id", "text_sha256", "_pos", "_left", "_block"]

        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for rids, docs, run in rows_of(batches):
            rows = []
            for rid, doc, text in zip(rids, docs, run):
                b = text.encode().translate(LOWER)
                sha = hashlib.sha256(b).hexdigest()
                n = max(1, -(-len(b) // block_bytes))
                for k in range(n):
                    block = b[k * block_bytes : (k + 1) * block_bytes]
                    rows.append((rid, doc, sha if k == 0 else None, k, n, block))
            yield made(rows)

    return run


def identities(rows: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``rows`` (_rid, doc_id, text), saved: _rid, doc_id, text_sha256 and the
    identity (_round, _name)."""
    blocks = rows.select("_rid", "doc_id", "text").mapInArrow(_blocker(block_bytes), _BLOCKS)
    carry = ["_rid", "doc_id", "text_sha256", "_pos", "_left"]
    names = numbered(blocks, ["_block"], ["_rid", "_pos"], carry, "_name", hashed=True).withColumn("_name", F.col("_name") + 1)
    done, level = None, 0
    most = names.agg(F.max("_left")).first()[0] or 0
    while True:
        ended = names.where("_left = 1")
        done = save(ended.select("_rid", "doc_id", "text_sha256", F.lit(level).alias("_round"), "_name"), "identities", done)
        if most <= 1:
            return done
        # pairs of adjacent names; a document's rows spread over (row, pair)
        pairs = (
            names.where("_left > 1")
            .groupBy("_rid", F.expr("_pos div 2").cast("int").alias("_pos"))
            .agg(
                F.max("doc_id").alias("doc_id"),
                F.max("text_sha256").alias("text_sha256"),
                F.max(F.expr("(_left + 1) div 2").cast("int")).alias("_left"),
                F.max(F.expr("if(_pos % 2 = 0, _name, 0)")).alias("_a"),
                F.max(F.expr("if(_pos % 2 = 1, _name, 0)")).alias("_b"),
            )
        )
        names = numbered(pairs, ["_a", "_b"], ["_rid", "_pos"], carry, "_name")
        names = names.withColumn("_name", F.col("_name") + 1)
        most, level = (most + 1) // 2, level + 1


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256, and _rid (the row's place)."""
    # the blocks are saved by one pass, so the numbers need no table of their own
    return exact_rows(docs.select(row_id(), "doc_id", "text"), block_bytes)


def exact_rows(rows: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The same for rows (_rid, doc_id, text)."""
    ids = identities(rows, block_bytes)
    best = F.max(F.struct("doc_id", "_rid")).alias("_keep")
    groups = ids.groupBy("_round", "_name").agg(best, F.count(F.lit(1)).alias("group_size"))
    return ids.join(groups, ["_round", "_name"]).select(
        "doc_id",
        F.col("_keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("_rid") == F.col("_keep._rid")).alias("kept"),
        "text_sha256",
        "_rid",
    )


def query(spark, sf_dir):
    from pitwall.llm.common import table

    return exact_dedup(table(spark, sf_dir, "documents")).drop("_rid")


ORACLE = """
with t as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body
  from documents),
g as (select body, max(doc_id) as keep_id, count(*) as group_size from t group by body)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(body) as text_sha256
from t join g using (body)
"""

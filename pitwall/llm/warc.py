"""Merkle fixity audit of two replicas of a WARC store.

Records are hashed into leaves; ``fanout`` neighbours at a time (in the order
of segment and offset) are hashed into nodes over ordered offset ranges, up to
one root. Each level is a stored table. The audit compares the two roots and
then reads, level by level, only the children of nodes that differ, down to
the damaged records. Levels shrink by ``fanout``, so both trees together hold
little more than the leaves, and no group holds more than ``fanout`` rows.

Defined results: null url or html is an empty string in the record; a null
page_id sorts first. Repeated rows are records of their own. An empty store
gives no rows. A record missing from one replica (or present in the other
only) is reported as ``missing`` or ``extra``. Two leaves at one position are
folded into one node in digest order. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import numbered, save

FANOUT = 16
SEGMENT_RECORDS = FANOUT**3


def warc_record(url: Column, payload: Column) -> Column:
    """A WARC/1.0 resource record as text (header block, payload, end mark)."""
    url, payload = F.coalesce(url, F.lit("")), F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nContent-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit("\r\n\r\n"),
        payload,
        F.lit("\r\n\r\n"),
    )


def layout(records: DataFrame, order: list[str], length: str, per_segment: int = SEGMENT_RECORDS) -> DataFrame:
    """Add pos (place in ``order``), segment, ordinal and offset (bytes before
    it in its segment). The window holds one segment: ``per_segment`` rows."""
    from pyspark.sql import Window

    rows = records.withColumn("_one", F.lit(1))
    rows = numbered(rows, order, [], records.columns, "pos", weight="_one")
    rows = rows.withColumn("segment", F.floor(F.col("pos") / per_segment).cast("bigint"))
    rows = rows.withColumn("ordinal", F.col("pos") % per_segment)
    before = Window.partitionBy("segment").orderBy("ordinal")
    return rows.withColumn("offset", F.sum(length).over(before) - F.col(length))


def _fold(children: DataFrame, fanout: int) -> DataFrame:
    kids = F.array_sort(F.collect_list(F.struct("idx", "from_segment", "from_offset", "to_segment", "to_offset", "hash")))
    line = F.transform(kids, lambda k: F.concat_ws(":", k["idx"], k["from_segment"], k["from_offset"], k["to_segment"], k["to_offset"], k["hash"]))
    return (
        children.groupBy(F.expr(f"idx div {fanout}").alias("up"))
        .agg(
            F.min(F.struct("from_segment", "from_offset")).alias("lo"),
            F.max(F.struct("to_segment", "to_offset")).alias("hi"),
            F.sha2(F.array_join(line, "\n"), 256).alias("hash"),
        )
        .select(
            F.col("up").alias("idx"),
            F.col("lo.from_segment").alias("from_segment"),
            F.col("lo.from_offset").alias("from_offset"),
            F.col("hi.to_segment").alias("to_segment"),
            F.col("hi.to_offset").alias("to_offset"),
            "hash",
        )
    )


def tree(leaves: DataFrame, levels: int, fanout: int = FANOUT) -> list[DataFrame]:
    """Stored levels from the leaves (level 0) to ``levels``. ``leaves`` has
    pos, segment, offset, length, digest."""
    level = leaves.select(
        F.col("pos").alias("idx"),
        F.col("segment").alias("from_segment"),
        F.col("offset").alias("from_offset"),
        F.col("segment").alias("to_segment"),
        (F.col("offset") + F.col("length")).alias("to_offset"),
        F.col("digest").alias("hash"),
    )
    out = [level]
    for _ in range(levels):
        out.append(save(_fold(out[-1], fanout), "merkle"))
    return out


def audit(a: DataFrame, b: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Positions where replica ``b`` differs from ``a``: pos, expected, found
    (digests, null where a side has no record)."""
    last = a.select("pos").unionAll(b.select("pos")).agg(F.max("pos")).first()[0]
    levels, top = 0, (last or 0) + 1
    while top > 1:
        levels, top = levels + 1, -(-top // fanout)
    trees = [tree(side, levels, fanout) for side in (a, b)]
    differ = None
    for k in range(levels, -1, -1):
        both = trees[0][k].withColumn("_b", F.lit(False)).unionAll(trees[1][k].withColumn("_b", F.lit(True)))
        if differ is not None:  # descend: only the children of nodes that differ
            parents = differ.select(F.col("idx").alias("_up"))
            both = both.join(parents, F.expr(f"idx div {fanout}") == F.col("_up"), "left_semi")

        def side(is_b):
            return F.array_join(F.array_sort(F.collect_list(F.when(F.col("_b") == is_b, F.concat_ws(":", "from_offset", "to_offset", "hash")))), ",")

        def digest(is_b):
            return F.min(F.when(F.col("_b") == is_b, F.col("hash")))

        differ = both.groupBy("idx").agg(
            side(False).alias("_sa"), side(True).alias("_sb"), digest(False).alias("expected"), digest(True).alias("found")
        )
        differ = differ.where("_sa <> _sb").select("idx", "expected", "found")
        if k:
            differ = save(differ, "merkle-differ")
    return differ.withColumnRenamed("idx", "pos")


def replica_payload(page_id: Column, html: Column) -> Column:
    """The second replica of the query: a copy of the store with planted damage
    (by md5 of page_id: 1/128 of the records have their first character
    replaced, 1/256 are cut to half; 1/256 are missing: null)."""
    h = F.substring(F.md5(F.coalesce(page_id.cast("string"), F.lit(""))), 1, 3)
    html = F.coalesce(html, F.lit(""))
    return (
        F.when(h < "020", F.concat(F.lit("#"), F.substring(html, 2, 2147483647)))
        .when(h < "030", F.left(html, F.floor(F.length(html) / 2).cast("int")))
        .when(h < "040", F.lit(None))
        .otherwise(html)
    )


def query(spark, sf_dir):
    from pitwall.llm.common import table

    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    damaged = replica_payload(F.col("page_id"), F.col("html"))
    first, second = warc_record(F.col("url"), F.col("html")), warc_record(F.col("url"), damaged)
    digests = pages.select(
        "page_id",
        F.octet_length(first).cast("bigint").alias("length"),
        F.sha2(first, 256).alias("digest"),
        F.when(damaged.isNotNull(), F.octet_length(second)).cast("bigint").alias("found_length"),
        F.when(damaged.isNotNull(), F.sha2(second, 256)).alias("found_digest"),
    )
    store = save(layout(digests, ["page_id", "digest"], "length"), "warc-store")
    a = store.select("pos", "segment", "offset", "length", "digest")
    b = store.where("found_digest is not null").select(
        "pos", "segment", "offset", F.col("found_length").alias("length"), F.col("found_digest").alias("digest")
    )
    manifest = store.select("pos", "page_id", "segment", "offset", "length", "found_length")
    return (
        audit(a, b)
        .join(manifest, "pos")
        .select(
            "page_id",
            "segment",
            "offset",
            "length",
            "found_length",
            F.col("expected").alias("expected_sha256"),
            F.col("found").alias("found_sha256"),
            F.when(F.col("found").isNull(), "missing").otherwise("changed").alias("kind"),
        )
    )


ORACLE = r"""
with p as (
  select page_id, coalesce(url, '') as url, coalesce(html, '') as html,
         substr(md5(coalesce(cast(page_id as varchar), '')), 1, 3) as h from pages),
d as (
  select *, case when h < '020' then concat('#', substr(html, 2))
                 when h < '030' then left(html, cast(floor(length(html) / 2) as int))
                 when h < '040' then null else html end as html2 from p),
r as (
  select page_id,
    concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10), 'WARC-Target-URI: ', url, chr(13), chr(10),
           'Content-Length: ', cast(strlen(html) as varchar), chr(13), chr(10), chr(13), chr(10), html,
           chr(13), chr(10), chr(13), chr(10)) as rec,
    case when html2 is not null then
    concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10), 'WARC-Target-URI: ', url, chr(13), chr(10),
           'Content-Length: ', cast(strlen(html2) as varchar), chr(13), chr(10), chr(13), chr(10), html2,
           chr(13), chr(10), chr(13), chr(10)) end as rec2 from d),
s as (
  select page_id, cast(strlen(rec) as bigint) as length, sha256(rec) as expected_sha256,
         cast(strlen(rec2) as bigint) as found_length, sha256(rec2) as found_sha256,
         row_number() over (order by page_id nulls first, sha256(rec)) - 1 as pos from r),
o as (
  select *, pos // 4096 as segment,
         cast(sum(length) over (partition by pos // 4096 order by pos) - length as bigint) as "offset" from s)
select page_id, segment, "offset", length, found_length, expected_sha256, found_sha256,
       case when found_sha256 is null then 'missing' else 'changed' end as kind
from o where found_sha256 is null or found_sha256 <> expected_sha256
"""

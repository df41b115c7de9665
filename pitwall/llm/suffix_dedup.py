"""Repeated-passage removal from a sparse enhanced suffix array.

Suffixes are sampled by content: of every ``SPAN`` bytes the suffix whose
first ``SEED`` bytes hash least is an anchor, so two equal strings of SPAN
bytes have the same anchors and every repeat shows in the bucket of an anchor.
Only anchors found more than once go on. Their occurrences with the same bytes
all around (SPAN - SEED before, SPAN after) form a class, of which the earliest
stands for the others. What is left in a bucket is sorted by suffix; a stack
scan of the common-prefix lengths yields the interval tree, and in each
interval the occurrences are split by their left extensions. An interval and a
left extension whose lengths reach SPAN are a repeat group with all its
occurrences: maximal to the right by the interval, to the left because its
members' next bytes to the left differ. Each occurrence but the earliest of its
group is covered, and the union over the groups gives the spans to remove.

Whole copies of an earlier text are removed as they are and take no part. A
bucket with more than ``LARGE`` classes is not scanned in one task: its strings
of SPAN bytes are grouped by content with a partial aggregate instead, which
gives the same spans. Frequent anchors (reported split by split, at most
``FREQUENT`` times the mean number per text) are spread over many tasks.

Defined results: null counts as empty; texts under SPAN bytes lose nothing;
order is by doc_id, repeated doc_ids by ``_rid`` (the row's place in its input
split, stored once for all passes). An empty table gives no rows. Only
doc_id and text are read. Anchors and contexts are compared as 64-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.llm.bpe import Hasher
from pitwall.llm.common import save, shuffle_partitions, stored_rows
from pitwall.llm.jaccard_join import _mix, _rows

SPAN = 100
SEED = 24
LEFT = SPAN - SEED
LARGE = 20_000
FREQUENT = 8000


def _sliding(a: np.ndarray, w: int, least: bool) -> np.ndarray:
    """Minimum (or maximum) of each w neighbours, in two passes over blocks."""
    op = np.minimum if least else np.maximum
    n = len(a)
    fill = np.uint64(2**64 - 1) if least else np.uint64(0)
    blocks = np.append(a, np.full(-n % w, fill, np.uint64)).reshape(-1, w)
    ahead = op.accumulate(blocks, axis=1).ravel()
    back = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[: n - w + 1], ahead[w - 1 : n])


def anchors(data: bytes, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the anchors of a text of at least SPAN bytes."""
    n, w = len(data) - SEED + 1, SPAN - SEED + 1
    if n < w:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.arange(n)
    h = _mix(hasher(np.frombuffer(data, np.uint8), at, at + SEED))
    least = _sliding(h, w, True)
    # the largest of the minima of the windows around a place: the place itself, if it is one
    around = np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)])
    places = np.flatnonzero(_sliding(around, w, False) == h)
    return h[places], places


def _profile(batches: Iterator):
    """mapInArrow body: size and digest of each text; with a null _rid, anchors
    that the split has twice or more."""
    import hashlib

    import pyarrow as pa

    names = ["_rid", "doc_id", "n", "sha", "h", "df"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def often(held):
        v, c = np.unique(np.concatenate(held), return_counts=True)
        v, c = v[c > 1].view(np.int64), c[c > 1].astype(np.int64)
        return pa.RecordBatch.from_arrays([*[pa.nulls(len(v), t) for t in kinds[:4]], pa.array(v), pa.array(c)], names=names)

    hasher, held, size, seen = Hasher(), [], 0, set()
    with np.errstate(over="ignore"):
        for rids, ids, run in _rows(batches):
            raw = [t.encode() for t in run]
            shas = [hashlib.sha256(b).hexdigest() for b in raw]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rids, kinds[0]), pa.array(ids, kinds[1]), pa.array([len(b) for b in raw], kinds[2]),
                 pa.array(shas, kinds[3]), *[pa.nulls(len(raw), t) for t in kinds[4:]]], names=names,
            )
            for b, d in zip(raw, shas):
                if d not in seen:
                    seen.add(d)
                    held.append(anchors(b, hasher)[0])
                    size += len(held[-1])
            if size > 2_000_000:
                yield often(held)
                held, size, seen = [], 0, set()
        if held:
            yield often(held)


def _anchor_rows(hot: np.ndarray):
    def run(batches):
        import hashlib

        import pyarrow as pa

        # the first copy (by doc_id, _rid) need not be the first read: of a text the
        # least one so far goes on, so the first copy always does
        hasher, seen = Hasher(), {}
        with np.errstate(over="ignore"):
            for rids, ids, run in _rows(batches):
                cols = [[np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
                for rid, doc, t in zip(rids, ids, run):
                    b = t.encode()
                    if len(b) < SPAN:
                        continue
                    d = hashlib.blake2b(b, digest_size=16).digest()
                    order = (doc is not None, doc, rid)
                    if d in seen and seen[d] < order:
                        continue
                    seen = {} if len(seen) > 100_000 else seen
                    seen[d] = order
                    h, at = anchors(b, hasher)
                    for c, v in zip(cols, (h, np.full(len(h), rid), at)):
                        c.append(v)
                h, rid, at = map(np.concatenate, cols)
                near = np.minimum(np.searchsorted(hot, h), max(0, len(hot) - 1))
                often = hot[near] == h if len(hot) else np.zeros(len(h), bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(rid), pa.array(at.astype(np.int32)), pa.array(often)],
                    names=["h", "_rid", "pos", "hot"],
                )

    return run


def _contexts(with_bytes: bool):
    """mapInArrow body over (_rid, doc_id, at: list of (h, pos), text): each
    anchor's context digest and how far its text reaches, or its bytes."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        for rb in batches:
            out = [[] for _ in range(7)]
            for rid, doc, at, text in zip(*(rb.column(i).to_pylist() for i in range(4))):
                b = text.encode()
                for a in at:
                    p = a["pos"]
                    left, right = min(LEFT, p), min(SPAN, len(b) - p)
                    context = b[p - left : p + right]
                    last = context if with_bytes else xxhash.xxh3_64_intdigest(context, seed=left) - (1 << 63)
                    for o, v in zip(out, (a["h"], rid, doc, p, left, right, last)):
                        o.append(v)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            types.append(pa.binary() if with_bytes else pa.int64())
            names = ["h", "_rid", "doc_id", "pos", "l", "r", "context"]
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types)], names=names)

    return run


_CONTEXT = "h bigint, _rid bigint, doc_id bigint, pos int, l int, r int, context "


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    if a == b:
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[:mid] == b[:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of the nodes of the common-prefix interval tree of
    sorted strings, by one stack scan; lcp[i] is that of strings i and i + 1."""
    stack: list[tuple[int, int]] = []
    for i, v in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > v:
            length, first = stack.pop()
            yield length, first, i
        if v >= 0 and (not stack or stack[-1][0] < v):
            stack.append((v, first))


def repeat_groups(lefts: list[bytes], rights: list[bytes], span: int = SPAN) -> Iterator[tuple[int, int, list[int], list[int]]]:
    """Repeat groups of the suffixes ``rights`` with the bytes before them
    (``lefts``, reversed): (left length, right length, members, common left
    lengths of neighbours). Members are all occurrences, in the order of their
    left extensions; the left length is the longest that all of them share, so
    it ends where they differ."""
    order = sorted(range(len(rights)), key=rights.__getitem__)
    lcp = [_common(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    for right, first, last in intervals(lcp):
        need = span - right
        members = sorted(order[first : last + 1], key=lefts.__getitem__)
        shared = [_common(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        start = 0
        for i in range(len(members)):
            if i == len(shared) or shared[i] < need:
                if i > start:
                    yield min(shared[start:i]), right, members[start : i + 1], shared[start:i]
                start = i + 1


def covered(lefts: list[bytes], rights: list[bytes], rank: list, span: int = SPAN) -> dict[int, list[int]]:
    """Of each occurrence that repeats an earlier one (by ``rank``): how far to
    the left and right the repeats of at least ``span`` bytes reach."""
    out: dict[int, list[int]] = {}
    for _, right, members, shared in repeat_groups(lefts, rights, span):
        for places, gaps in ((range(len(members)), shared), (range(len(members) - 1, -1, -1), shared[::-1])):
            # nearest earlier occurrence on this side: the most common left extension
            stack: list[tuple[int, int]] = []  # (member, common left with the one pushed next)
            for step, i in enumerate(places):
                m, gap = members[i], gaps[step - 1] if step else 0
                while stack and rank[stack[-1][0]] > rank[m]:
                    gap = min(gap, stack.pop()[1])
                if stack:
                    e = out.setdefault(m, [0, 0])
                    e[0], e[1] = max(e[0], gap), max(e[1], right)
                stack.append((m, gap))
    return out


def _bucket_scan(batches):
    """mapInArrow body over rows sorted by h: the covered reach of each row."""
    import pyarrow as pa

    names = ["_rid", "pos", "l", "r"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]

    def scanned(rows):
        lefts = [c[:k][::-1] for *_, k, _, c in rows]
        rights = [c[k:] for *_, k, _, c in rows]
        rank = [(doc is not None, doc, rid, pos) for _, rid, doc, pos, *_ in rows]
        for m, (left, right) in covered(lefts, rights, rank).items():
            yield rows[m][1], rows[m][3], left, right

    held: list = []
    for rb in batches:
        out = []
        for row in zip(*(c.to_pylist() for c in rb.columns)):
            if held and held[0][0] != row[0]:
                out += scanned(held)
                held = []
            held.append(row)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
    out = list(scanned(held))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def _by_windows(rows: DataFrame) -> DataFrame:
    """The same for buckets of any size: each string of SPAN bytes around the
    anchor is grouped by its content, the earliest of each group is kept."""
    steps = F.filter(F.sequence(F.lit(0), F.lit(LEFT)), lambda j: (j <= F.col("l")) & (SPAN - j <= F.col("r")))
    cut = rows.select("h", "_rid", "pos", F.struct("doc_id", "_rid", "pos").alias("o"), "l", "context", F.explode(steps).alias("j"))
    cut = cut.withColumn("s", F.sha2(F.expr(f"substring(context, l - j + 1, {SPAN})"), 256)).drop("context", "l")
    first = cut.groupBy("h", "j", "s").agg(F.min("o").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    later = cut.join(first, ["h", "j", "s"]).where("o <> first")
    return later.groupBy("_rid", "pos").agg(F.max("j").alias("l"), F.max(SPAN - F.col("j")).alias("r"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _cut(batches):
    import hashlib

    import pyarrow as pa

    for rb in batches:
        out = []
        for doc, spans, text in zip(*(rb.column(i).to_pylist() for i in range(3))):
            b, at, kept = text.encode(), 0, []
            gone = merged([(s["a"], s["b"]) for s in spans])
            for x, y in gone:
                kept.append(b[at:x])
                at = y
            kept = b"".join([*kept, b[at:]])
            out.append((doc, len(b), len(b) - len(kept), len(gone), hashlib.sha256(kept).hexdigest()))
        if out:
            types = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), types)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )


def remove_repeats(docs: DataFrame, large: int = LARGE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256."""
    spark, source = docs.sparkSession, stored_rows(docs, "doc_id", "text")
    seen = save(source.mapInArrow(_profile, "_rid bigint, doc_id bigint, n bigint, sha string, h bigint, df bigint"), "texts")
    profile = seen.where("_rid is not null").drop("h", "df")
    often = seen.where("_rid is null").groupBy("h").agg(F.sum("df").alias("df"))
    often = often.where(F.col("df") >= max(8, profile.count() // FREQUENT)).select("h").toPandas()["h"]
    hot = np.sort(often.to_numpy(np.int64).view(np.uint64))
    firsts = profile.groupBy("sha").agg(F.min(F.struct("doc_id", "_rid")).alias("_first")).select("sha", "_first")
    profile = save(profile.join(firsts, "sha").withColumn("first", F.col("_first._rid") == F.col("_rid")).drop("_first"), "profile")

    rows = source.mapInArrow(_anchor_rows(hot), "h bigint, _rid bigint, pos int, hot boolean")
    rows = rows.withColumn("_salt", F.when(F.col("hot"), F.pmod("_rid", F.lit(1009))).otherwise(-1))
    rows = rows.withColumn("_c", F.count(F.lit(1)).over(Window.partitionBy("h", "_salt"))).where("hot or _c > 1")
    rows = rows.select("h", "_rid", "pos").join(profile.where("first").select("_rid", "doc_id"), "_rid")
    rows = save(rows, "anchors")
    # texts with repeated anchors, stored by row so that they move once
    n, name = shuffle_partitions(spark), f"repeat_texts_{uuid.uuid4().hex}"
    texts_of = source.select("_rid", F.coalesce("text", F.lit("")).alias("text"))
    some = texts_of.join(rows.select("_rid").distinct(), "_rid", "left_semi").repartition(n, "_rid")
    some.write.bucketBy(n, "_rid").option("compression", "zstd").saveAsTable(name)
    stored = spark.table(name)

    def around(found: DataFrame, with_bytes: bool) -> DataFrame:
        at = found.groupBy("_rid", "doc_id").agg(F.collect_list(F.struct("h", "pos")).alias("at"))
        full = at.join(stored, "_rid").select("_rid", "doc_id", "at", "text")
        return full.mapInArrow(_contexts(with_bytes), _CONTEXT + ("binary" if with_bytes else "bigint"))

    members = save(around(rows, False), "contexts")
    order = F.struct("doc_id", "_rid", "pos")
    classes = save(members.groupBy("h", "context").agg(F.min(order).alias("o"), F.count(F.lit(1)).alias("c")), "classes")
    again = members.join(classes.where("c > 1"), ["h", "context"]).where(order != F.col("o")).select("_rid", "pos", "l", "r")
    sizes = save(classes.groupBy("h").count().where("count > 1"), "buckets")
    several = classes.join(sizes, "h").select("h", "o._rid", "o.doc_id", "o.pos")
    mixed = save(around(several, True).join(sizes, "h"), "mixed")
    small = mixed.where(F.col("count") <= large).drop("count").repartition("h").sortWithinPartitions("h")
    reach = small.mapInArrow(_bucket_scan, "_rid bigint, pos int, l int, r int")
    if sizes.where(F.col("count") > large).limit(1).count():
        reach = reach.unionAll(_by_windows(mixed.where(F.col("count") > large)))
    spans = again.unionAll(reach).select("_rid", F.struct((F.col("pos") - F.col("l")).alias("a"), (F.col("pos") + F.col("r")).alias("b")).alias("s"))
    spans = spans.groupBy("_rid").agg(F.collect_list("s").alias("spans"))
    spans = save(spans.join(profile.select("_rid", "doc_id"), "_rid"), "spans")
    cut = spans.join(stored, "_rid").select("doc_id", "spans", "text")
    cut = cut.mapInArrow(_cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    rest = profile.join(spans.select("_rid"), "_rid", "left_anti")
    gone = ~F.col("first") & (F.col("n") >= SPAN)
    rest = rest.select(
        "doc_id",
        F.col("n").alias("n_bytes"),
        F.when(gone, F.col("n")).otherwise(0).cast("bigint").alias("n_removed"),
        F.when(gone, 1).otherwise(0).cast("bigint").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("kept_sha256"),
    )
    return cut.unionAll(rest)


def query(spark, sf_dir):
    from pitwall.llm.common import table

    return remove_repeats(table(spark, sf_dir, "documents"))

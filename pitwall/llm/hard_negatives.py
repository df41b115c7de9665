"""Hard-negative mining with Fagin's threshold algorithm.

Vectors are scaled to integers, so scores are exact. All rows are dealt into
blocks of about ``BLOCK`` by a hash of their place (a hot label spreads evenly)
and anchors into groups of about ``ANCHORS``; each (anchor group, block) is one
unit of work, so all anchors meet all rows without a pair ever becoming a row.

In a unit each dimension has the block's candidates sorted by that component.
For an anchor the lists are read from the top or the bottom, by the sign of the
anchor's component (dimensions where it is zero are not read). Each candidate met
for the first time is scored by random access to its whole vector. The threshold
is the anchor's product with the last components read: no unread candidate scores
more. Reading stops once the threshold falls strictly below the kth score of
every window (below the window's lower end while it has fewer than k), so ties
at the kth score are all seen. Lists are read in steps that double.

First each anchor's positives are found so (one window without ends, over the
lists of its own label), then its negatives (one window per positive, over all
lists; rows of its label are passed over). Each unit returns the k best of each
window; a window over those few rows per block gives the whole result.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component take no part, nor do those with a component of ``LARGEST``
or more, whose scores a long cannot hold. A shorter vector counts as filled up
with zeros. Repeated rows are rows of their own: the copy of an anchor may be its
positive, and a copied anchor is answered twice. Equal scores go by id, then by
place. A negative positive score leaves an empty window. An empty table, or one
without anchors, gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.llm.common import row_id, save

SCALE = 256
LARGEST = 65536
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
BLOCK, ANCHORS = 8192, 1024
FIRST_STEP = 32


def exact_kind(most: int, width: int) -> type:
    """The cheapest number type that holds products of ``width`` components of at most
    ``most``, and all their partial sums, exactly."""
    bound = most * most * max(1, width)
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64


class Lists:
    """Candidates of a block with one sorted list per dimension."""

    def __init__(self, x: np.ndarray, kind: type = np.int64):
        self.x = x.astype(kind)
        self.up = np.argsort(x, axis=0, kind="stable").T.astype(np.int32, order="C")  # a row per dimension
        self.down = np.ascontiguousarray(self.up[:, ::-1])

    def search(self, anchor: np.ndarray, windows: list[tuple], take: int, allowed: np.ndarray, ties: list[np.ndarray]):
        """For each window (least score or None, largest score or None) the places of
        its ``take`` best allowed candidates, best first, and their scores."""
        n, none = len(self.x), np.zeros(0, np.int64)
        anchor = anchor.astype(self.x.dtype)
        rising, falling = np.flatnonzero(anchor < 0), np.flatnonzero(anchor > 0)
        weight = np.append(anchor[rising], anchor[falling])
        dims = np.append(rising, falling)
        best = [(none, none) for _ in windows]
        # what a window still takes: nothing below its floor, where a tie may be of use
        floor = [-np.inf if low is None else low for low, _ in windows]
        closed = [low is not None and high is not None and low > high for low, high in windows]
        seen, depth, step = np.zeros(n, bool), 0, FIRST_STEP
        while depth < n and not all(closed):
            upto = min(n, depth + step)
            part = np.concatenate([self.up[rising, depth:upto], self.down[falling, depth:upto]])
            met = np.full(n, not len(dims))
            met[part.ravel()] = True
            fresh = np.flatnonzero(met > seen)
            seen |= met
            score = self.x[fresh] @ anchor
            useful = allowed[fresh]
            useful &= score >= min(f for f, c in zip(floor, closed) if not c)
            fresh, score = fresh[useful], score[useful].astype(np.int64)
            order = np.argsort(score)
            fresh, score = fresh[order], score[order]
            for w, (_, high) in enumerate(windows):
                end = len(score) if high is None else np.searchsorted(score, high, side="right")
                begin = np.searchsorted(score, floor[w])
                if end - begin > take:  # its best, and all that tie with the last of them
                    begin = max(begin, np.searchsorted(score, score[end - take]))
                if end > begin and not closed[w]:
                    at, s = np.append(best[w][0], fresh[begin:end]), np.append(best[w][1], score[begin:end])
                    first = np.lexsort([*[t[at] for t in ties[::-1]], -s])[:take]
                    best[w] = at[first], s[first]
                    if len(first) == take:
                        floor[w] = int(s[first[-1]])
            if seen.all():
                break
            threshold = int(weight @ self.x[part[:, -1], dims])
            closed = [c or threshold < f for c, f in zip(closed, floor)]
            depth, step = upto, 2 * step
        return best


def _matrix(column, width: int) -> np.ndarray:
    """Vectors of an Arrow list column as rows of longs, filled up with zeros."""
    column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _longest(*columns) -> int:
    return max([int(np.diff(c.combine_chunks().offsets.to_numpy()).max(initial=0)) for c in columns])


def _unit(take: int):
    """Body of one unit. Left: anchors (anchor, own, vector, windows: the lower and upper
    score of each, empty for positives). Right: candidates (_rid, id, label, x)."""

    def run(left, right):
        import pyarrow as pa

        out = [[], [], [], [], []]
        if left.num_rows and right.num_rows:
            width = _longest(left["vector"], right["x"])
            a, x = _matrix(left["vector"], width), _matrix(right["x"], width)
            rid, vec, label = (right[c].to_numpy() for c in ("_rid", "id", "label"))
            windows, own = left["windows"].to_pylist(), left["own"].to_numpy()
            kind = exact_kind(int(max(np.abs(a).max(initial=0), np.abs(x).max(initial=0))), width)
            of_label: dict = {}
            if any(not w for w in windows):
                of_label = {v: np.flatnonzero(label == v) for v in np.unique(own)}
                parts = {v: Lists(x[at], kind) for v, at in of_label.items()}
            whole = Lists(x, kind) if any(windows) else None
            for i, r in enumerate(left["anchor"].to_pylist()):
                if windows[i]:
                    at = np.arange(len(x))
                    spans = [(w["low"], w["high"]) for w in windows[i]]
                    found = whole.search(a[i], spans, take, label != own[i], [vec, rid])
                else:
                    at = of_label[own[i]]
                    found = parts[own[i]].search(a[i], [(None, None)], take, rid[at] != r, [vec[at], rid[at]])
                for w, (places, scores) in enumerate(found):
                    values = (np.full(len(places), r), np.full(len(places), w), rid[at[places]], vec[at[places]], scores)
                    for c, v in zip(out, values):
                        c.append(v)
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        return pa.table({n: pa.array(c.astype(np.int64)) for n, c in zip(_FOUND, columns)})

    return run


_FOUND = ("anchor", "window", "_rid", "id", "score")


def _searched(anchors: DataFrame, rows: DataFrame, groups: int, blocks: int, take: int) -> DataFrame:
    """(anchor, window, _rid, id, score, rank): the ``take`` best of each window."""
    block = F.pmod(F.xxhash64("_rid"), F.lit(blocks)).alias("_block")
    group = F.pmod(F.xxhash64("_rid", F.lit(1)), F.lit(groups)).alias("_group")
    left = anchors.select(
        F.col("_rid").alias("anchor"), F.col("label").alias("own"), F.col("x").alias("vector"), "windows", group,
        F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("_block"),
    )
    right = rows.select("*", block, F.explode(F.expr(f"sequence(0L, {groups - 1}L)")).alias("_group"))
    units = left.groupBy("_group", "_block").cogroup(right.groupBy("_group", "_block"))
    found = units.applyInArrow(_unit(take), ", ".join(f"{c} bigint" for c in _FOUND))
    best = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "_rid")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= take)


def integer_vectors(table: DataFrame, id_col: str, label: Column, vector: str, anchor: Column, scale: int = SCALE) -> DataFrame:
    """Stored rows (_rid, id, label, x, is_anchor) of those that take part."""
    usable = F.forall(vector, lambda v: F.coalesce(F.abs(v.cast("double")) < LARGEST, F.lit(False)))
    x = F.transform(vector, lambda v: F.floor(v.cast("double") * scale).cast("int"))
    kept = table.where(F.col(id_col).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & usable)
    return save(
        kept.select(
            row_id(), F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
            x.alias("x"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
        ),
        "vectors",
    )


def mine(rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of
    ``integer_vectors`` rows; low and high bound a negative's score in percent of the
    positive's."""
    anchors = rows.where("is_anchor").select("_rid", "label", "x")
    plain = rows.select("_rid", "id", "label", "x")
    blocks, groups = -(-max(1, rows.count()) // BLOCK), -(-max(1, anchors.count()) // ANCHORS)
    none = F.expr("cast(array() as array<struct<low: bigint, high: bigint>>)").alias("windows")
    good = save(_searched(anchors.select("*", none), plain, groups, blocks, positives), "positives")
    # at most ``positives`` rows an anchor
    spans = good.select(
        "anchor", "rank",
        F.expr(f"(score * {low} + pmod(-score * {low}, 100)) div 100").alias("low"),
        F.expr(f"(score * {high} - pmod(score * {high}, 100)) div 100").alias("high"),
    )
    listed = spans.groupBy(F.col("anchor").alias("_rid")).agg(F.array_sort(F.collect_list(F.struct("rank", "low", "high"))).alias("w"))
    listed = listed.select("_rid", F.transform("w", lambda w: F.struct(w["low"].alias("low"), w["high"].alias("high"))).alias("windows"))
    bad = _searched(anchors.join(listed, "_rid"), plain, groups, blocks, negatives)
    pairs = good.select("anchor", (F.col("rank") - 1).cast("bigint").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = rows.where("is_anchor").select(F.col("_rid").alias("anchor"), F.col("id").alias("anchor_id"))
    return bad.join(pairs, ["anchor", "window"]).join(named, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def query(spark, sf_dir):
    from pitwall.llm.common import table

    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    source = table(spark, sf_dir, "embeddings")
    return mine(integer_vectors(source, "vec_id", label, "embedding", F.col("vec_id") % 100 == 0))


ORACLE = """
with r as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
a as (select * from r where vec_id % 100 = 0),
pos as (select * from (
  select a.vec_id as anchor_id, a.v, a.label, r.vec_id as positive_id,
         cast(list_inner_product(a.v, r.v) as bigint) as positive_score,
         row_number() over (partition by a.vec_id order by list_inner_product(a.v, r.v) desc, r.vec_id) as n
  from a join r on a.label = r.label and a.vec_id <> r.vec_id) where n <= 5),
neg as (
  select anchor_id, positive_id, r.vec_id as negative_id, positive_score,
         cast(list_inner_product(pos.v, r.v) as bigint) as negative_score
  from pos join r on pos.label <> r.label)
select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from (
  select *, row_number() over (partition by anchor_id, positive_id order by negative_score desc, negative_id) as rank
  from neg where 30 * positive_score <= 100 * negative_score and 100 * negative_score <= 90 * positive_score)
where rank <= 10
"""

"""Jaccard join on word shingles with adaptive multi-match prefixes.

Each document's shingles are put in one global order, rare ones first. If two
sets with similarity t share a overlap of at least ceil(t n) shingles, their
prefixes of n - ceil(t n) + l shingles share at least l. So each document may
choose its own l: the longer the prefix, the more shared shingles a candidate
must have. l is chosen per document from the measured lengths of the posting
lists of its prefix (scan cost, against the bound lists / l on the candidates
to verify). A pair is verified on whole texts when it shares min(l, l')
shingles of the two prefixes.

The order needs no exact frequencies, only the same order everywhere: frequent
shingles (in one document of ``FREQUENT`` or more, counted split by split) go last by
frequency, all others by hash. At most ``FREQUENT`` times the mean set size can
be that frequent, which bounds the list sent to the executors.

Equal sets are one class and are joined once. Large groups of near copies are
not expanded into all pairs: in each posting list documents are first verified
against one pivot (``STARS`` rounds with different pivots, first the document
whose prefix has the longest posting lists, as an original has among its
edited copies), components are formed, and then all candidate pairs whose documents still are in different
components are verified. So every link between different components is tested
and the components are exact.

For that last step l is a twentieth of the set, at least ``MOST``. Of two documents
the one with the lesser l (then ``_rid``) looks for the other: of its l shared
shingles at least one is left when it leaves out its l - 1 longest lists (those of
the most components), so it looks only in the rest. So passages that ever more
documents share make no pairs of their own. A pair is made where its documents first
meet, not once for each shingle they share: in a list it is left out if one of the
last ``BEFORE`` shingles that the one document looked for is among the last ones of the
other, as an earlier list has made it then. The rows follow the pairs, and
the shared shingles of each are counted in the two prefixes themselves. A document
with fewer lists left than the least l of any that its size can link with takes no part.

Before pairs are made, a bitmap filter drops the ones that cannot link: each set has ``64 * WORDS`` parity bits (a
shingle flips one), and two bitmaps never differ in more bits than the sets
differ in shingles.

A verification moves only the texts that stand in its pairs: a bit for each row, in words
of 64 neighbours, goes to the tasks that read the stored texts. At most ``MARKS`` words
are sent; in larger tables several words share one, and a text that no pair needs may be
moved, too, but none that a pair needs is left out.

Defined results: null and empty texts have no shingles and stay alone; texts
of fewer than ``k`` words have one shingle; repeated rows are one class. An
empty table gives no rows. Only doc_id and text are read. Shingles are compared
as 64-bit hashes. ``_rid`` is the place of a row in its input split, stored
once for all passes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.llm.bpe import Hasher
from pitwall.llm.common import LOWER, drop, rows_of, save, stored_rows
from pitwall.llm.components import components

K = 5
PERCENT = 80
FREQUENT = 8000
MOST = 4  # the longest prefix extension considered against pivots
SPARE = 20  # one shingle in so many lengthens the prefix of the last step
BEFORE = 6  # shingles before one in which an earlier meeting of a pair is looked for
STARS = 3
RUN_CHARS = 1_500_000
#: Shingles counted together, and the count from which a split reports one.
COUNTED, REPORTED = 4_000_000, 2
#: Long integers of a set's parity bitmap.
WORDS = 8
PARITY = [f"p{i}" for i in range(WORDS)]
#: Cost of verifying a candidate against that of reading a posting.
VERIFY = 20
#: A frequent shingle is spread over so many salts.
SPREAD = 1009
#: Words of 64 bits, at most, that tell which texts a verification reads.
MARKS = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def needed(n, percent: int = PERCENT):
    """The least overlap of a set of n: ceil(n * percent / 100)."""
    return (n * percent + 99) // 100


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(run: list[str], hasher: Hasher, k: int = K) -> list[np.ndarray]:
    """The set of each text: its distinct shingle hashes, ascending."""
    raw = [t.encode().translate(LOWER) for t in run]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    word = ~_BLANK[data]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if word[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[::2], edge[1::2]
    stops = np.cumsum([len(b) + 1 for b in raw])
    per_doc = np.bincount(np.searchsorted(stops, starts, side="right"), minlength=len(run))
    hashes = _mix(hasher(data, starts, ends) + (ends - starts).astype(np.uint64))
    factors = [np.uint64(pow(0x9E3779B97F4A7C15, i + 1, 1 << 64)) for i in range(k)]
    n = len(hashes)
    rolled = np.zeros(max(0, n - k + 1), np.uint64)
    for i, f in enumerate(factors):
        rolled += hashes[i : n - k + 1 + i] * f if n >= k else np.uint64(0)
    rolled = _mix(rolled)
    out, at = [], 0
    for m in per_doc.tolist():
        if m >= k:
            out.append(np.unique(rolled[at : at + m - k + 1]))
        elif m:
            short = np.uint64(m)
            for h, f in zip(hashes[at : at + m], factors):
                short = short + h * f
            out.append(_mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += m
    return out


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """One row per set: its parity bitmap as ``WORDS`` long integers."""
    bits = 64 * WORDS
    place = np.concatenate([s >> np.uint64(32) for s in sets]) % np.uint64(bits)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    odd = np.bincount(row * bits + place.astype(np.int64), minlength=len(sets) * bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(len(sets), WORDS)


def _rows(batches):
    """(row ids, ids, texts) of runs of Arrow batches of (_rid, id, text)."""
    return rows_of(batches, RUN_CHARS)


def _profile(k: int):
    """mapInArrow body: per document its size, a 128-bit digest of its set and its
    parity bitmap, and (with a null _rid) shingles that the split finds often."""

    def run(batches):
        import hashlib

        import pyarrow as pa

        names = ["_rid", "doc_id", "n", "digest", *PARITY, "shingle", "df"]
        kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * (WORDS + 2)

        def often(held):
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            v, c = values[counts >= REPORTED].view(np.int64), counts[counts >= REPORTED]
            return pa.RecordBatch.from_arrays(
                [*[pa.nulls(len(v), t) for t in kinds[:-2]], pa.array(v), pa.array(c.astype(np.int64))], names=names
            )

        hasher, held, size, seen = Hasher(), [], 0, set()
        with np.errstate(over="ignore"):
            for rids, ids, group in _rows(batches):
                sets = shingle_sets(group, hasher, k)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rids, kinds[0]), pa.array(ids, kinds[1]), pa.array([len(s) for s in sets], kinds[2]),
                     pa.array(digests, kinds[3]), *[pa.array(w) for w in parities(sets).T],
                     *[pa.nulls(len(sets), t) for t in kinds[-2:]]],
                    names=names,
                )
                for s, d in zip(sets, digests):
                    if d not in seen:
                        seen.add(d)
                        held.append(s)
                        size += len(s)
                if size >= COUNTED:
                    yield often(held)
                    held, size, seen = [], 0, set()
            if held:
                yield often(held)

    return run


def _prefixes(k: int, percent: int, shingles: np.ndarray, dfs: np.ndarray):
    """mapInArrow body: the longest prefix of each set (of equal sets, those whose
    _rid is the least read so far), with the place of each shingle in it and, for a
    frequent one, a salt (else -1)."""

    def run(batches):
        import pyarrow as pa

        hasher, seen, held = Hasher(), {}, 0
        with np.errstate(over="ignore"):
            for rids, _, group in _rows(batches):
                cols = [[], [], [], []]
                for rid, s in zip(rids, shingle_sets(group, hasher, k)):
                    n = len(s)
                    key = s.tobytes() if n < 8 else (n, int(s[0]), int(s[-1]), int(s.sum()))
                    if not n or seen.get(key, rid) < rid:
                        continue
                    seen[key] = rid
                    m = min(n, n - needed(n, percent) + max(MOST, n // SPARE))
                    at = np.minimum(np.searchsorted(shingles, s), max(0, len(shingles) - 1))
                    df = np.where(shingles[at] == s, dfs[at], 0) if len(shingles) else np.zeros(n, np.int64)
                    if df.any():
                        s = s[np.argsort(df, kind="stable")]
                        df = np.sort(df)
                    spread = np.where(df[:m] > 0, rid % SPREAD, -1)
                    for c, v in zip(cols, (s[:m], np.full(m, rid), np.arange(m), spread)):
                        c.append(v)
                    held += 1
                if held > 100_000:
                    seen, held = {}, 0
                if cols[0]:
                    token, rid, place, salt = (np.concatenate(c) for c in cols)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(token.view(np.int64)), pa.array(rid.astype(np.int64)), pa.array(place.astype(np.int32)),
                         pa.array(salt.astype(np.int32))],
                        names=["token", "_rid", "place", "salt"],
                    )

    return run


def _verifier(k: int, percent: int):
    """mapInArrow body over (u, v, text_u, text_v): the pairs that link."""

    def run(batches):
        import pyarrow as pa

        hasher, last = Hasher(), [None, None]
        with np.errstate(over="ignore"):
            for rb in batches:
                u, v = rb.column("u").to_pylist(), rb.column("v").to_pylist()
                links = []
                for i in range(len(u)):
                    if last[0] != v[i]:  # rows are sorted by v
                        last = [v[i], shingle_sets([rb.column("text_v")[i].as_py()], hasher, k)[0]]
                    a, b = shingle_sets([rb.column("text_u")[i].as_py()], hasher, k)[0], last[1]
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    links.append(100 * both >= percent * (len(a) + len(b) - both))
                keep = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(u, np.int64)[keep]), pa.array(np.array(v, np.int64)[keep])], names=["u", "v"]
                )

    return run


def _adaptive(tokens: DataFrame, percent: int) -> DataFrame:
    """Chooses l (at most ``MOST``) per document and keeps its prefix, saved: adds l."""
    base = F.col("n") - F.expr(f"(n * {percent} + 99) div 100")  # prefix of l has base + l places
    counted = tokens.where(F.col("place") < base + MOST)
    counted = counted.join(counted.groupBy("token").agg((F.count(F.lit(1)) - 1).alias("others")), "token").where("others > 0")
    counted = save(counted, "postings")
    costs = counted.groupBy("_rid", "n").agg(
        *[F.sum(F.when(F.col("place") < base + i, F.col("others")).otherwise(0)).alias(f"c{i}") for i in range(1, MOST + 1)]
    )
    # l matches bound the candidates by postings / l
    cost = [F.struct((F.col(f"c{i}") * (1 + VERIFY / i)).alias("cost"), F.lit(i).alias("l")) for i in range(1, MOST + 1)]
    most = F.expr(f"(n * {percent} + 99) div 100")
    cost = F.filter(F.array(*cost), lambda c: c["l"] <= most)
    chosen = costs.select("_rid", F.array_min(cost)["l"].alias("l"), (F.col(f"c{MOST}") / F.col("n")).alias("score"))
    kept = counted.join(chosen, "_rid").where(F.col("place") < base + F.col("l"))
    out = save(kept.select("token", "_rid", "n", "l", "score"), "prefixes")
    drop(counted)
    return out


def _apart(tokens: DataFrame, roots: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs u, v of different components."""
    rooted = save(_rooted(tokens, roots), "rooted")
    # components in a list are counted from one row per (list, component)
    lists = rooted.select("token", "root").distinct().groupBy("token").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1")

    def length(n: str) -> str:  # of a set's n - need + l places, at most n
        return f"least(({n} * {percent} + 99) div 100, greatest({MOST}, {n} div {SPARE}))"

    own = Window.partitionBy("_rid")
    longest = F.row_number().over(own.orderBy(F.desc("parts"), "token"))
    left = rooted.join(lists, "token").withColumn("l", F.expr(length("n"))).withColumn("looks", longest >= F.col("l"))
    # a set that links has at least need shingles: one that has not even its l in these lists links with none
    enough = F.count(F.lit(1)).over(own) >= F.expr(length(f"(n * {percent} + 99) div 100"))
    left = left.withColumn("enough", enough).where("enough").select("token", "_rid", "n", "root", "l", "looks")
    left = save(left, "apart")
    before = own.orderBy("token").rowsBetween(-BEFORE, -1)
    a = left.withColumn("sought", F.collect_list(F.when(F.col("looks"), F.col("token"))).over(before)).where("looks")
    a = a.join(classes, "_rid").select("token", F.col("_rid").alias("u"), "n", "l", F.col("root").alias("ru"), "sought", *PARITY)
    other = [F.col(p).alias(f"q{p}") for p in PARITY]
    b = left.withColumn("had", F.collect_list("token").over(before)).join(classes, "_rid")
    b = b.select("token", F.col("_rid").alias("v"), F.col("n").alias("pn"), F.col("l").alias("pl"), F.col("root").alias("rv"), "had", *other)
    near = f"100 * least(n, pn) >= {percent} * greatest(n, pn)"
    differ = " + ".join(f"bit_count({p} ^ q{p})" for p in PARITY)
    alike = f"({differ}) * {100 + percent} <= (n + pn) * {100 - percent}"
    first = "(l < pl or (l = pl and u < v)) and ru <> rv"
    matched = a.join(b, "token").where(f"{first} and {near} and {alike} and not arrays_overlap(sought, had)")
    met = save(matched.select("u", "v", "l").distinct(), "met")
    # the shared shingles of a pair of different components are all in left
    ends = met.select(F.col("u").alias("_rid")).unionAll(met.select(F.col("v").alias("_rid"))).distinct()
    prefixes = left.join(ends, "_rid", "left_semi").groupBy("_rid").agg(F.collect_list("token").alias("prefix"))
    one = prefixes.select(F.col("_rid").alias("u"), F.col("prefix").alias("prefix_u"))
    two = prefixes.select(F.col("_rid").alias("v"), F.col("prefix").alias("prefix_v"))
    pairs = met.join(one, "u").join(two, "v").where("size(array_intersect(prefix_u, prefix_v)) >= l").select("u", "v")
    pairs = save(pairs, "pairs")
    drop(rooted, left, met)
    return pairs


def _needed(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of ``texts`` (_rid, text) that stand in the stored ``pairs`` (u, v), and few others."""
    word = F.pmod(F.xxhash64(F.shiftright("_rid", 6)), F.lit(MARKS)).alias("_word")
    ends = pairs.select(F.col("u").alias("_rid")).unionAll(pairs.select("v"))
    marks = ends.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, cast(_rid % 64 as int))")).alias("_marks"))
    marked = texts.select("*", word).join(F.broadcast(marks), "_word")
    return marked.where("getbit(_marks, cast(_rid % 64 as int)) = 1").select(*texts.columns)


def links(source: DataFrame, k: int = K, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(profile, roots) of stored rows (_rid, doc_id, text). profile: _rid, doc_id, n, digest of each row; roots:
    (u, root) of class representatives that are not the least of their
    component (the representative of a class is its least _rid)."""
    words = "".join(f"{p} bigint, " for p in PARITY)
    schema = f"_rid bigint, doc_id bigint, n bigint, digest binary, {words}shingle bigint, df bigint"
    seen = save(source.mapInArrow(_profile(k), schema), "profile")
    profile = seen.where("_rid is not null").drop("shingle", "df")
    rows = profile.count()
    often = seen.where("_rid is null").groupBy("shingle").agg(F.sum("df").alias("df"))
    often = often.where(F.col("df") >= max(8, rows // FREQUENT)).toPandas()
    shingles = often["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(shingles)
    body = _prefixes(k, percent, shingles[order], often["df"].to_numpy(np.int64)[order])
    parity = [F.first(p).alias(p) for p in PARITY]  # equal sets have equal ones
    size = F.first("n").cast("int").alias("n")
    classes = profile.where("n > 0").groupBy("digest").agg(F.min("_rid").alias("_rid"), size, *parity).drop("digest")
    classes = save(classes, "classes")
    profile = profile.drop(*PARITY)
    # shingles of one document only are dropped before anything else is joined; a
    # frequent one is known to be shared and is spread over many tasks
    tokens = source.mapInArrow(body, "token bigint, _rid bigint, place int, salt int")
    together = Window.partitionBy("token", "salt")
    shared = tokens.withColumn("_c", F.count(F.lit(1)).over(together)).where("salt >= 0 or _c > 1").drop("_c", "salt")
    found = save(shared, "shared")
    tokens = save(found.join(classes.select("_rid", "n"), "_rid"), "tokens")
    drop(found)
    postings = _adaptive(tokens, percent)
    near = f"100 * least(n, pn) >= {percent} * greatest(n, pn)"
    texts = source.select("_rid", F.coalesce("text", F.lit("")).alias("text"))

    def verified(pairs: DataFrame) -> DataFrame:
        read = _needed(texts, pairs)
        one = read.select(F.col("_rid").alias("u"), F.col("text").alias("text_u"))
        two = read.select(F.col("_rid").alias("v"), F.col("text").alias("text_v"))
        full = pairs.select("u", "v").join(one, "u").join(two, "v").sortWithinPartitions("v")
        return full.mapInArrow(_verifier(k, percent), "u bigint, v bigint")

    def joined(pairs: DataFrame, roots: DataFrame | None) -> DataFrame:
        """Components of the links of the stored ``pairs`` and of the stars known so far."""
        found = verified(pairs)
        edges = save(found if roots is None else found.unionAll(roots.select("u", F.col("root").alias("v"))), "links")
        drop(pairs)
        out = components(edges)
        drop(edges)
        return out

    roots = None
    for star in range(STARS):
        here = postings if roots is None else _rooted(postings, roots)
        first, hashed = (F.lit(0.0) if star else -F.col("score")), F.xxhash64("_rid", F.lit(star))
        root = "_rid" if roots is None else "root"
        named = F.struct(first.alias("o"), hashed.alias("h"), F.col("_rid").alias("v"), F.col("n").alias("pn"), F.col(root).alias("pr"))
        pivot = here.groupBy("token").agg(F.min(named).alias("p"), F.min(root).alias("_lo"), F.max(root).alias("_hi"))
        pairs = here.join(pivot.where("_lo <> _hi"), "token").where(f"{root} <> p.pr")
        pairs = pairs.select(F.col("_rid").alias("u"), "n", "p.v", "p.pn", "l").where(near)
        pairs = pairs.groupBy("u", "v", "l").count().where("count >= l").select("u", "v")
        roots = joined(save(pairs, "star"), roots)
    drop(postings)
    # every candidate pair that is still apart
    pairs = _apart(tokens, roots, classes.drop("n"), percent)
    drop(tokens)
    roots = joined(pairs, roots)
    drop(classes)
    return profile, roots


def _rooted(postings: DataFrame, roots: DataFrame) -> DataFrame:
    named = postings.join(roots.withColumnRenamed("u", "_rid"), "_rid", "left")
    return named.withColumn("root", F.coalesce("root", "_rid"))


def near_duplicates(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the least
    doc_id reachable by links), kept (one row of each component) and _rid."""
    rows = stored_rows(docs, "doc_id", "text")
    out = near_rows(rows, k, percent)
    drop(rows)
    return out


def near_rows(rows: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """The same for stored rows (_rid, doc_id, text)."""
    profile, roots = links(rows, k, percent)
    classes = profile.where("n > 0").groupBy("digest").agg(F.min("_rid").alias("u"))
    classes = classes.join(roots, "u", "left").select("digest", F.coalesce("root", "u").alias("root"))
    rows = profile.join(classes, "digest", "left").withColumn("root", F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("_rid")))
    rows = save(rows.drop("digest"), "members")
    least = rows.groupBy("root").agg(F.min(F.struct("doc_id", "_rid")).alias("_least"))
    return rows.join(least, "root").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("_least.doc_id").alias("component_id"),
        (F.col("_rid") == F.col("_least._rid")).alias("kept"),
        "_rid",
    )


def query(spark, sf_dir):
    from pitwall.llm.common import table

    return near_duplicates(table(spark, sf_dir, "documents")).drop("kept", "_rid")

"""SimHash near-dedup by anchor-point covering.

Fingerprints are 64 bits. Anchors are the words of a covering code: the first
46 bits are two blocks of 23, each covered by the perfect Golay code with radius
3 (the other 18 bits are free: any value lies within their radius). So each
fingerprint has one home anchor. If x and y differ in at most t bits, y lies
within radius + t of the home of x, with the excess over the radius summed over
the blocks. Each fingerprint is therefore replicated to every anchor within
covering radius plus threshold (61 on average for t = 2), and per anchor the
fingerprints at home are compared with all that came. The 2^24 anchors spread
the work; tables are built by rule from the code's generator.

Equal fingerprints are one class (partial aggregates), so copies meet nowhere. A
home with more than ``HOT`` fingerprints is crowded; those fingerprints, and the
others that visit a crowded anchor, go to finer hubs instead: all words within
t / 2 bits of them. Two fingerprints share a hub exactly if they differ in at most
t bits, and a hub holds at most 65 of them (t = 2). What lives in calm homes is
replicated and shuffled once, so the visitors of one anchor are bounded by ``HOT``
times the number of homes near it, whatever the corpus. Each comparison keeps a
spanning forest of its links, so no group is expanded into pairs. Components
follow from the forests.

Defined results: null and empty texts have fingerprint zero, linked like any
other; texts of fewer than ``k`` words have one shingle; repeated rows are each
returned; a null doc_id is never the least of a component that has others. Only
doc_id and text are read, whatever other columns are called. An empty table
gives no rows. Memory of a task follows one text, or the visitors of one anchor.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations, product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import LOWER, save, texts
from pitwall.llm.components import components

K = 3
THRESHOLD = 2
SEED = 42
HOT = 1024
#: Shingle hashes unpacked together, and pairs compared together.
UNPACKED, COMPARED = 50_000, 1_000_000
#: Characters of texts, and fingerprints, handled together.
RUN_CHARS, VISITORS = 500_000, 2000

# Length and radius of the perfect Golay code, its generator
# x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, and the blocks of a fingerprint.
LENGTH, RADIUS, GENERATOR, BLOCKS = 23, 3, 0b110001110101, 2
#: Kinds of rows at an anchor, in their order there.
CROWDED, AT_HOME, VISITING = 0, 1, 2


def simhash(text: str, k: int = K) -> int:
    """The fingerprint of one text: bit i is set if it is in over half of the
    XXH64 hashes of its shingles, repeats included."""
    import xxhash

    words = text.encode().translate(LOWER).split()
    if not words:
        return 0
    joined, width = b" ".join(words), min(k, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    begin, end = (ends - size)[: len(words) - width + 1], ends[width - 1 :]
    hashed, of = xxhash.xxh64_intdigest, memoryview(joined)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(begin), UNPACKED):
        part = [hashed(of[a:b], SEED) for a, b in zip(begin[i : i + UNPACKED].tolist(), end[i : i + UNPACKED].tolist())]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(begin), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and its home anchor of each row."""

    def run(batches):
        import pyarrow as pa

        for ids, group in texts(batches, RUN_CHARS):
            fps = np.array([simhash(t, k) for t in group], np.uint64)
            columns = [pa.array(ids, pa.int64()), pa.array(fps.view(np.int64)), pa.array(visits(fps, 0)[1])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", "home"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, fp bigint, home bigint")


@cache
def _code(threshold: int):
    """Of the Golay code: the syndrome of each word of its low 12 and high 11 bits,
    and all error patterns within radius + threshold, grouped by (syndrome, excess):
    patterns, first place and count of each group."""
    column = []
    for i in range(LENGTH):
        word = 1 << i
        for bit in range(LENGTH - 1, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        column.append(word)
    column = np.array(column)

    def syndromes(columns):
        words = np.arange(1 << len(columns))
        return np.bitwise_xor.reduce([np.where(words >> i & 1, c, 0) for i, c in enumerate(columns)])

    patterns, syndrome, excess = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [0]
    for weight in range(1, RADIUS + threshold + 1):
        chosen = np.array(list(combinations(range(LENGTH), weight)))
        patterns.append((1 << chosen).sum(1))
        syndrome.append(np.bitwise_xor.reduce(column[chosen], axis=1))
        excess += [max(0, weight - RADIUS)] * len(chosen)
    patterns, group = np.concatenate(patterns), np.concatenate(syndrome) * (threshold + 1) + np.array(excess)
    order = np.argsort(group, kind="stable")
    count = np.bincount(group, minlength=2048 * (threshold + 1))
    return syndromes(column[:12]), syndromes(column[12:]), patterns[order], np.cumsum(count) - count, count


def visits(fps: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in ``fps``, anchor, whether it is the home) of all visits of ``fps``
    (unsigned) to anchors within covering radius plus ``threshold``."""
    low, high, patterns, first, count = _code(threshold)
    blocks = [(fps >> np.uint64(LENGTH * b) & np.uint64((1 << LENGTH) - 1)).astype(np.int64) for b in range(BLOCKS)]
    groups = [(low[w & 4095] ^ high[w >> 12]) * (threshold + 1) for w in blocks]
    out = []
    for excess in product(range(threshold + 1), repeat=BLOCKS):
        if sum(excess) > threshold:
            continue
        place, anchor = np.arange(len(fps)), np.zeros(len(fps), np.int64)
        for b, e in enumerate(excess):  # every pattern of this block for what is there so far
            n = count[groups[b][place] + e]
            before = np.cumsum(n) - n
            own = np.arange(int(n.sum())) - np.repeat(before, n)
            place, anchor = np.repeat(place, n), np.repeat(anchor, n)
            pattern = patterns[first[groups[b][place] + e] + own]
            anchor |= (blocks[b][place] ^ pattern) << (LENGTH * b)
        out.append((place, anchor, np.full(len(place), not any(excess))))
    return tuple(np.concatenate(c) for c in zip(*out))


def _visitor(threshold: int):
    def run(batches):
        import pyarrow as pa

        for rb in batches:
            every = rb.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(every), VISITORS):
                fps = every[i : i + VISITORS]
                place, anchor, home = visits(fps, threshold)
                kind = np.where(home, AT_HOME, VISITING).astype(np.int8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(fps[place].view(np.int64)), pa.array(kind)], names=["anchor", "fp", "kind"]
                )

    return run


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for the nodes of the links u, v that are
    not the least themselves."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (label[a], label[b], a, b):
            np.minimum.at(new, side, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    hangs = label != np.arange(len(nodes))
    return nodes[hangs], nodes[label[hangs]]


def _compare(threshold: int):
    """mapInArrow body over (anchor, fp, kind) sorted by anchor and kind: per anchor, the
    fingerprints at home against all that came. Gives forests of links u, v, and the
    visitors of crowded anchors as u with a null v."""

    def links(anchor, fp, kind):
        begin = np.append(0, np.flatnonzero(anchor[1:] != anchor[:-1]) + 1)
        size = np.diff(np.append(begin, len(anchor)))
        at = np.flatnonzero(kind == AT_HOME)
        run = np.searchsorted(begin, at, side="right") - 1
        n = size[run]
        made, lo = np.cumsum(n), 0
        while lo < len(at):
            hi = max(lo + 1, int(np.searchsorted(made, made[lo] - n[lo] + COMPARED, side="right")))
            m = n[lo:hi]
            own = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
            x, y = fp[np.repeat(at[lo:hi], m)], fp[np.repeat(begin[run[lo:hi]], m) + own]
            near = np.bitwise_count((x ^ y).view(np.uint64)) <= threshold  # of the bits, not of the signed value
            near &= x != y
            if near.any():
                yield forest(x[near], y[near])
            lo = hi
        crowded = np.repeat(kind[begin] == CROWDED, size) & (kind == VISITING)
        if crowded.any():
            yield fp[crowded], None

    def run(batches):
        import pyarrow as pa

        held = [np.zeros(0, t) for t in (np.int64, np.int64, np.int8)]
        for rb in _with_end(batches):
            if rb is not None:
                now = [rb.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in ("anchor", "fp", "kind")]
                held = [np.concatenate(p) for p in zip(held, now)]
            # the last anchor may go on in the next batch
            cut = len(held[0]) if rb is None or not len(held[0]) else int(np.searchsorted(held[0], held[0][-1]))
            if cut:
                for u, v in links(*[c[:cut] for c in held]):
                    right = pa.nulls(len(u), pa.int64()) if v is None else pa.array(v)
                    yield pa.RecordBatch.from_arrays([pa.array(u), right], names=["u", "v"])
                held = [c[cut:] for c in held]

    return run


def _with_end(batches):
    yield from batches
    yield None


def near_links(classes: DataFrame, threshold: int = THRESHOLD, hot: int = HOT) -> DataFrame:
    """Links u, v (signed fingerprints) whose components are those of all pairs of
    ``classes`` (fp, home; fp distinct) with at most ``threshold`` differing bits."""
    if threshold not in (0, 2):
        raise ValueError("hubs are exact for an even threshold; 0 and 2 are built")
    crowded = classes.groupBy("home").count().where(F.col("count") > hot).select("home")
    crowded = save(crowded, "crowded")
    calm, dense = classes.join(crowded, "home", "left_anti"), classes.join(crowded, "home", "left_semi")
    visited = calm.select("fp").mapInArrow(_visitor(threshold), "anchor bigint, fp bigint, kind tinyint")
    marks = crowded.select(F.col("home").alias("anchor"), F.lit(None).cast("bigint").alias("fp"), F.lit(CROWDED).cast("tinyint").alias("kind"))
    met = visited.unionAll(marks).repartition("anchor").sortWithinPartitions("anchor", "kind")
    found = save(met.mapInArrow(_compare(threshold), "u bigint, v bigint"), "met")
    crowd = dense.select(F.col("fp").alias("u")).unionAll(found.where("v is null").select("u")).distinct()
    words = "transform(sequence(0, 64), i -> if(i = 64, u, u ^ shiftleft(1L, i)))" if threshold else "array(u)"
    hubs = crowd.select("u", F.explode(F.expr(words)).alias("hub"))
    shared = hubs.groupBy("hub").agg(F.collect_set("u").alias("around")).where("size(around) > 1")  # at most 65
    shared = shared.select(F.explode("around").alias("u"), F.array_min("around").alias("v")).where("u <> v")
    return found.where("v is not null").unionAll(shared)


def near_duplicates(docs: DataFrame, k: int = K, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, fp and component_id (the least doc_id reachable) of each row."""
    rows = save(fingerprints(docs, k), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.first("home").alias("home"))
    classes = save(classes, "fp-classes")
    roots = components(save(near_links(classes, threshold), "near-links"))
    named = classes.join(roots.select(F.col("u").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = save(named, "fp-roots")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = named.join(least, "root").select("fp", "component_id")
    return rows.join(of_class, "fp").select("doc_id", "fp", "component_id")


def query(spark, sf_dir):
    from pitwall.llm.common import table

    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

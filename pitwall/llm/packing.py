"""Packing documents into sequences of ``WINDOW`` tokens by non-negative
least squares.

A document of n tokens gives n // WINDOW full sequences; only the rest (1 to
WINDOW - 1 tokens) has to share. The histogram of rests has at most WINDOW - 1
bins whatever the corpus holds, so it is solved on the driver: shallow
combinations (two or three lengths that fill the window exactly) are columns,
and non-negative least squares finds how often to repeat each. The counts are
rounded down and kept within the histogram. Rests are numbered inside their
bin by a distributed sort, and a number picks the copy of a combination. The
residual rests are packed greedily one behind the other and cut at the window,
so only the very last sequence needs padding.

Defined results: null and empty texts are the end mark alone; repeated rows
are documents of their own. An empty table gives no pieces. Texts are encoded
whole. Only doc_id and text are read. ``_rid`` is the place of a row in its
input split, so the input must be a stored table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.bpe import Encoder, encoded_runs, json_ranks, rank_merger
from pitwall.llm.common import numbered, save

WINDOW = 2048
END_ID = 1
#: Full sequences are numbered from here by input split, the others from 0.
FULL_FROM = 1 << 62

_COUNTED = "_rid bigint, doc_id bigint, n bigint, rest int, full_id bigint, full_crc array<bigint>, rest_crc bigint, rest_ids binary"


def _counter(vocabulary: str, window: int):
    """mapInArrow body: tokens of each document, CRCs of its full sequences and
    of its rest, and the rest's ids (16 bits each: the vocabulary has 50,257)."""

    def run(batches):
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext

        encoder = Encoder(rank_merger(json_ranks(vocabulary)))
        split = TaskContext.get().partitionId() << 40
        row, full = 0, 0
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.binary()]
        names = ["_rid", "doc_id", "n", "rest", "full_id", "full_crc", "rest_crc", "rest_ids"]
        for docs, run_ids in encoded_runs(encoder, batches):
            rows = []
            for doc, ids in zip(docs, run_ids):
                ids = np.append(ids, END_ID).astype("<u4")
                n, k = len(ids), len(ids) // window
                crcs = [zlib.crc32(ids[i * window : (i + 1) * window].tobytes()) for i in range(k)]
                rest = ids[k * window :]
                rows.append(
                    (split + row, doc, n, len(rest), FULL_FROM + split + full, crcs, zlib.crc32(rest.tobytes()),
                     rest.astype("<u2").tobytes())
                )
                row, full = row + 1, full + k
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return run


def combinations(lengths: set[int], window: int, depth: int = 3) -> list[tuple[int, ...]]:
    """All ascending pairs (and for depth 3 triples) of ``lengths`` that fill
    ``window`` exactly. Their number depends on the window alone."""
    out = [(a, window - a) for a in sorted(lengths) if a <= window - a and window - a in lengths]
    if depth >= 3:
        order = sorted(lengths)
        for i, a in enumerate(order):
            for b in order[i:]:
                c = window - a - b
                if c < b:
                    break
                if c in lengths:
                    out.append((a, b, c))
    return out


def triples(lengths: set[int], window: int) -> np.ndarray:
    """The triples among ``combinations``, as rows: hundreds of thousands of tuples would
    stay in the driver's memory."""
    order = np.array(sorted(lengths), np.int64)
    there = np.zeros(window + 1, bool)
    there[order] = True
    out = [np.zeros((0, 3), np.int64)]
    for i, a in enumerate(order):
        b = order[i:]
        b = b[window - a - b >= b]
        b = b[there[window - a - b]]
        out.append(np.stack([np.full(len(b), a), b, window - a - b], axis=1))
    return np.concatenate(out)


def nonnegative_least_squares(columns: list[tuple[int, ...]], counts: dict[int, int], x=None, sweeps: int = 30) -> list[float]:
    """x >= 0 that (nearly) minimises |A x - h|^2 by coordinate descent; column
    j of A counts each length of ``columns[j]``, h is ``counts``."""
    left = {k: float(v) for k, v in counts.items()}
    x = x or [0.0] * len(columns)
    weights = []
    for c, v in zip(columns, x):
        w = [(a, c.count(a)) for a in sorted(set(c))]
        weights.append((w, float(sum(m * m for _, m in w))))
        for a, m in w:
            left[a] -= m * v
    for _ in range(sweeps):
        moved = 0.0
        for j, (w, norm) in enumerate(weights):
            step = max(-x[j], sum(m * left[a] for a, m in w) / norm)
            if step:
                x[j] += step
                moved = max(moved, abs(step))
                for a, m in w:
                    left[a] -= m * step
        if moved < 0.25:
            break
    return x


def solve(counts: dict[int, int], window: int = WINDOW, rounds: int = 3, added: int = 1024) -> list[tuple[tuple[int, ...], int]]:
    """(combination, copies) whose lengths lie within ``counts``.

    Pairs are solved first; each round then adds the triples along which the
    squared error falls fastest and solves again from there."""
    active = combinations(set(counts), window, depth=2)
    threes = triples(set(counts), window)
    x = nonnegative_least_squares(active, counts)
    taken = np.zeros(len(threes), bool)
    for _ in range(rounds if len(threes) else 0):
        left = np.zeros(window + 1)
        for a, v in counts.items():
            left[a] = v
        for c, v in zip(active, x):
            for a in c:
                left[a] -= v
        gain = np.where(taken, -1.0, left[threes].sum(axis=1))
        best = np.argsort(-gain, kind="stable")[:added]
        best = best[gain[best] > 1]
        taken[best] = True
        active += [tuple(t) for t in threes[best].tolist()]
        x = nonnegative_least_squares(active, counts, [*x, *[0.0] * len(best)])
    left, out = dict(counts), []
    for c, v in sorted(zip(active, x), key=lambda p: (-p[1], p[0])):
        copies = min([int(v + 1e-6), *(left[a] // c.count(a) for a in c)])
        if copies > 0:
            out.append((c, copies))
            for a in c:
                left[a] -= copies
    return out


def slots(plan: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, int]:
    """Rows (length, first number, end number, first sequence, offset), sorted,
    one for each place of each combination; and the number of sequences."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for c, copies in plan:
        offset = 0
        for a in c:
            at = used.get(a, 0)
            rows.append((a, at, at + copies, sequence, offset))
            used[a] = at + copies
            offset += a
        sequence += copies
    return np.array(sorted(rows), np.int64).reshape(-1, 5), sequence


_PLACED = "_rid bigint, doc_id bigint, n bigint, rest int, rest_crc bigint, sequence_id bigint, offset bigint"


def _placer(table: np.ndarray, first: dict[int, int]):
    """mapInArrow body: a rest's number in its bin picks its slot, if any."""

    def run(batches):
        import pyarrow as pa

        key = (table[:, 0] << 45) + table[:, 1]
        start = np.zeros(max(first, default=0) + 1, np.int64)
        for a, v in first.items():
            start[a] = v
        for rb in batches:
            rest = rb.column("rest").to_numpy().astype(np.int64)
            number = rb.column("_at").to_numpy() - start[rest]
            at = np.searchsorted(key, (rest << 45) + number, side="right") - 1
            slot = table[np.maximum(at, 0)] if len(table) else np.zeros((len(rest), 5), np.int64)
            fits = (at >= 0) & (slot[:, 0] == rest) & (number < slot[:, 2])
            sequence = pa.array(slot[:, 3] + number - slot[:, 1], mask=~fits)
            offset = pa.array(slot[:, 4], mask=~fits)
            names = ["_rid", "doc_id", "n", "rest", "rest_crc"]
            yield pa.RecordBatch.from_arrays(
                [*[rb.column(c) for c in names], sequence, offset], names=[*names, "sequence_id", "offset"]
            )

    return run


def _cutter(window: int):
    """mapInArrow body: CRCs of the two parts of a rest cut after ``head``."""

    def run(batches):
        import zlib

        import pyarrow as pa

        for rb in batches:
            first, second = [], []
            for head, raw in zip(rb.column("head").to_pylist(), rb.column("rest_ids")):
                ids = np.frombuffer(raw.as_py(), "<u2").astype("<u4")
                first.append(zlib.crc32(ids[:head].tobytes()))
                second.append(zlib.crc32(ids[head:].tobytes()))
            keep = ["doc_id", "n", "rest", "head", "_at"]
            yield pa.RecordBatch.from_arrays(
                [*[rb.column(c) for c in keep], pa.array(first, pa.int64()), pa.array(second, pa.int64())],
                names=[*keep, "crc1", "crc2"],
            )

    return run


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    counted = save(docs.select("doc_id", "text").mapInArrow(_counter(vocabulary, window), _COUNTED), "counted")
    rests = counted.where("rest > 0")
    histogram = {r["rest"]: r["count"] for r in rests.groupBy("rest").count().collect()}  # at most window - 1 rows
    table, sequences = slots(solve(histogram, window))
    order, total = sorted(histogram), 0
    first = {}
    for a in order:
        first[a], total = total, total + histogram[a]
    carry = ["_rid", "doc_id", "n", "rest", "rest_crc"]
    ranked = numbered(rests.withColumn("_one", F.lit(1)), ["rest"], ["_rid"], carry, "_at", weight="_one")
    placed = save(ranked.mapInArrow(_placer(table, first), _PLACED), "placed")

    full = counted.where("n >= %d" % window).select("doc_id", "n", "full_id", F.posexplode("full_crc").alias("k", "crc"))
    full = full.select(
        "doc_id",
        (F.col("k") * F.lit(window).cast("bigint")).alias("start"),
        F.lit(window).cast("bigint").alias("length"),
        F.col("crc").alias("ids_crc32"),
        F.col("n").alias("doc_tokens"),
        (F.col("full_id") + F.col("k")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    whole = placed.where("sequence_id is not null")
    # greedy: residual rests, longest first, one behind the other
    residual = placed.where("sequence_id is null").withColumn("_long", -F.col("rest"))
    stream = numbered(residual, ["_long"], ["_rid"], carry, "_at", weight="rest")
    stream = stream.withColumn("head", F.lit(window) - F.col("_at") % window)
    stream = stream.withColumn("sequence_id", F.lit(sequences).cast("bigint") + F.expr(f"_at div {window}"))
    stream = stream.withColumn("offset", F.col("_at") % window)
    uncut = stream.where("rest <= head")

    def rest_piece(df):
        return df.select(
            "doc_id",
            (F.col("n") - F.col("rest")).alias("start"),
            F.col("rest").cast("bigint").alias("length"),
            F.col("rest_crc").alias("ids_crc32"),
            F.col("n").alias("doc_tokens"),
            "sequence_id",
            "offset",
        )

    cut = stream.where("rest > head").select("_rid", "doc_id", "n", "rest", F.col("head").cast("int"), "_at")
    cut = cut.join(counted.where("rest > 0").select("_rid", "rest_ids"), "_rid").drop("_rid")
    cut = cut.mapInArrow(_cutter(window), "doc_id bigint, n bigint, rest int, head int, _at bigint, crc1 bigint, crc2 bigint")
    at, two = F.col("n") - F.col("rest"), F.expr(f"_at div {window}") + F.lit(sequences).cast("bigint")
    head = F.col("head").cast("bigint")
    parts = F.array(
        F.struct(at.alias("start"), head.alias("length"), F.col("crc1").alias("ids_crc32"), two.alias("sequence_id"),
                 (F.col("_at") % window).alias("offset")),
        F.struct((at + head).alias("start"), (F.col("rest") - head).alias("length"), F.col("crc2").alias("ids_crc32"),
                 (two + 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")),
    )
    cut = cut.select("doc_id", F.col("n").alias("doc_tokens"), F.explode(parts).alias("p")).select(
        "doc_id", "p.start", "p.length", "p.ids_crc32", "doc_tokens", "p.sequence_id", "p.offset"
    )
    return full.unionAll(rest_piece(whole)).unionAll(rest_piece(uncut)).unionAll(cut)


def query(spark, sf_dir):
    import public_tokenizers

    from pitwall.llm.common import table

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))

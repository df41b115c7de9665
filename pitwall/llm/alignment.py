"""Cross-tokenizer alignment by pointer jumping.

A text is encoded by a byte-level BPE (A) and a piece model (B); both cover the
same bytes. Every token points to its farthest-right overlapping token of the
other side (to itself, if it is A's and a token of B ends with it). Squaring the
successor function (``succ = succ[succ]``, all tokens of a run of texts at once)
converges to the terminal token of each component of overlapping tokens: the
places where A and B tokens both end. Terminals number the groups.

Within a group every A token is linked with every B token. Links are kept per
document as distinct id pairs with their number of occurrences; a large group
contributes the product of its distinct ids' counts, so it is never expanded.
How many documents hold a pair comes from one aggregate over these lists. The
counts go back to the documents in two ways: pairs that are at least 1 /
``COMMON`` of all (document, pair) rows by themselves are at most ``COMMON`` many
and are broadcast, so the hot pairs of a corpus never shuffle; the rest are
joined on the pair.

A is encoded with the byte-level BPE of ``bpe``; B by the sentencepiece library,
segment by segment behind a cache (no piece of the model spans the start of a run
of spaces, which is checked, so segments merge alone).

Defined results: null and empty texts, and those whose joined A or B bytes differ
from space + text (a literal U+2581), have no tokens: zeros, and '' as digest.
Repeated rows are each returned and each counted as a document. A null doc_id is
returned as it is. Only doc_id and text are read; extra columns do not matter. An
empty table gives no rows. Texts are encoded whole: memory follows ``RUN_CHARS``
or the longest text.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.llm.bpe import Encoder, json_ranks, rank_merger, vocabulary
from pitwall.llm.common import row_id, rows_of, save

RUN_CHARS = 1_000_000
CACHED_SEGMENTS = 400_000
#: A group with more pairs than this is counted by its distinct ids.
EXPANDED = 256
#: The largest number of pairs that are broadcast with their counts.
COMMON = 200_000
PAIR_BITS = 16  # a pair is (A id << 16) + B id

_SEGMENT = re.compile(r" +[^ ]*")


class Pieces:
    """The piece model, one segment (spaces and what follows them) at a time."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if len(names) > 1 << PAIR_BITS:
            raise ValueError(f"piece models have at most {1 << PAIR_BITS} pieces here")
        if any(re.search("[^▁]▁", n) for n in names):
            raise ValueError("the model has pieces that span the start of a run of spaces")
        self.words = [
            bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)
        ]
        self.cache: dict[str, bytes] = {}

    def __call__(self, text: str) -> np.ndarray:
        """Ids of a text that starts with the space the model adds."""
        segments = _SEGMENT.findall(text)
        missing = [s for s in set(segments) if s not in self.cache]
        if missing:
            if len(self.cache) + len(missing) > CACHED_SEGMENTS:
                self.cache, missing = {}, list(set(segments))
            lone = np.array([self.model.piece_to_id("▁")], np.int32).tobytes()
            for s, ids in zip(missing, self.model.encode([s[1:] for s in missing], num_threads=1)):
                self.cache[s] = np.array(ids, np.int32).tobytes() if len(s) > 1 else lone
        return np.frombuffer(b"".join(map(self.cache.__getitem__, segments)), np.int32)


def groups(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group (from 0) of each A and each B token, given where tokens end."""
    n = len(end_a)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start_a, start_b = (np.append(0, e[:-1]) for e in (end_a, end_b))
    over = np.searchsorted(start_b, end_a) - 1  # the last B token that overlaps
    succ = np.append(np.where(end_b[over] > end_a, n + over, np.arange(n)), np.searchsorted(start_a, end_b) - 1)
    while True:
        jumped = succ[succ]
        if np.array_equal(jumped, succ):
            break
        succ = jumped
    number = np.cumsum(succ[:n] == np.arange(n)) - 1
    return number[succ[:n]], number[succ[n:]]


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (count[i] of them) for each i."""
    before = np.cumsum(count) - count
    return np.arange(int(count.sum())) + np.repeat(first - before, count)


def linked(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, n: int):
    """(group, pair, times) of the links of ``n`` groups, by group; a pair may come
    more than once."""
    na, nb = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    at_a, at_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    small = np.flatnonzero(na * nb <= EXPANDED)
    row = _spread(at_a[small], na[small])
    group, width = np.repeat(small, na[small]), np.repeat(nb[small], na[small])
    pair = (np.repeat(a[row].astype(np.int64), width) << PAIR_BITS) + b[_spread(at_b[group], width)]
    out = [(np.repeat(group, width), pair, np.ones(len(pair), np.int64))]
    for g in np.flatnonzero(na * nb > EXPANDED).tolist():
        ids_a, times_a = np.unique(a[at_a[g] : at_a[g] + na[g]], return_counts=True)
        ids_b, times_b = np.unique(b[at_b[g] : at_b[g] + nb[g]], return_counts=True)
        pair = ((ids_a.astype(np.int64) << PAIR_BITS)[:, None] + ids_b).ravel()
        out.append((np.full(len(pair), g), pair, np.outer(times_a, times_b).ravel()))
    group, pair, times = (np.concatenate(c) for c in zip(*out))
    if len(out) > 1:
        order = np.argsort(group, kind="stable")
        group, pair, times = group[order], pair[order], times[order]
    return group, pair, times


class Aligner:
    """Aligns runs of texts."""

    def __init__(self, byte_bpe: str, pieces: str):
        ranks = json_ranks(byte_bpe)
        self.encoder, self.pieces = Encoder(rank_merger(ranks)), Pieces(pieces)
        self.words = vocabulary(ranks)
        self.size_a, self.size_b = (np.array([*map(len, w)], np.int64) for w in (self.words, self.pieces.words))
        # what is written after a token: within a side, or at its end
        self.names_a, self.names_b = len(self.words), len(self.pieces.words)
        self.names = [f"{i}{s}" for n, end in ((self.names_a, "|"), (self.names_b, ";")) for s in (",", end) for i in range(n)]

    def __call__(self, run: list[str]):
        """Per text (A ids, B ids, groups, links, written groups, pairs, times), or None
        for one without tokens."""
        spaced = [" " + t for t in run]
        ids, at = self.encoder(spaced)
        all_a, all_b, whole = [], [], []
        for i, text in enumerate(spaced):
            if len(text) == 1 or "▁" in text:
                continue
            a, b = ids[at[i] : at[i + 1]], self.pieces(text)
            want = text.encode()
            if all(b"".join(map(w.__getitem__, t.tolist())) == want for w, t in ((self.words, a), (self.pieces.words, b))):
                whole.append(i)
                all_a.append(a)
                all_b.append(b)
        out: list = [None] * len(run)
        if not whole:
            return out
        a, b = np.concatenate(all_a), np.concatenate(all_b)
        group_a, group_b = groups(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]))
        n = int(group_a[-1]) + 1
        group, pair, times = linked(a, b, group_a, group_b, n)
        written, place_a, place_b = self._written(a, b, group_a, group_b, n)
        na, nb = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        links = np.append(0, np.cumsum(na * nb))
        end_a, end_b = np.cumsum([*map(len, all_a)]), np.cumsum([*map(len, all_b)])
        last = group_a[end_a - 1] + 1  # groups do not cross texts
        end_pair, done = np.searchsorted(group, last), [0, 0, 0, 0]
        for i, *ends in zip(whole, end_a.tolist(), end_b.tolist(), last.tolist(), end_pair.tolist()):
            (a0, b0, g0, p0), (a1, b1, g1, p1) = done, ends
            distinct, which = np.unique(pair[p0:p1], return_inverse=True)
            held = np.bincount(which, weights=times[p0:p1]).astype(np.int64)
            text = "".join(map(self.names.__getitem__, written[a0 + b0 : a1 + b1].tolist()))[:-1]
            out[i] = (a1 - a0, b1 - b0, g1 - g0, int(links[g1] - links[g0]), text, distinct, held)
            done = ends
        return out

    def _written(self, a, b, group_a, group_b, n):
        """All tokens by group, A's before B's, as places in ``names``."""
        na, nb = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        place_a = np.arange(len(a)) + (np.cumsum(nb) - nb)[group_a]
        place_b = np.arange(len(b)) + np.cumsum(na)[group_b]
        out = np.empty(len(a) + len(b), np.int64)
        out[place_a] = a + self.names_a * np.append(group_a[1:] != group_a[:-1], True)
        out[place_b] = 2 * self.names_a + b + self.names_b * np.append(group_b[1:] != group_b[:-1], True)
        return out, place_a, place_b


_ALIGNED = (
    "_rid bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, groups string, pairs array<bigint>, times array<bigint>"
)


def aligned(docs: DataFrame, byte_bpe: str, pieces: str, keep_groups: bool = True) -> DataFrame:
    """One row per row of ``docs``: _rid (its place), doc_id, counts of tokens, groups
    and links, the groups as 'a1,a2|b1;a3|b2' (null unless ``keep_groups``) and their
    SHA-256, and the distinct id pairs linked with their numbers of links."""

    def run(batches):
        import pyarrow as pa

        aligner = Aligner(byte_bpe, pieces)
        for rids, ids, group in rows_of(batches, RUN_CHARS):
            rows = [r or (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)) for r in aligner(group)]
            na, nb, ng, nl, text, pair, times = zip(*rows)
            at = pa.array(np.cumsum([0, *map(len, pair)]).astype(np.int32))
            sha = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in text]
            numbers = [pa.array(c, pa.int64()) for c in (rids, ids, na, nb, ng, nl)]
            lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(c))) for c in (pair, times)]
            shown = pa.array(text if keep_groups else [None] * len(text), pa.string())
            yield pa.RecordBatch.from_arrays([*numbers, pa.array(sha), shown, *lists], names=_names)

    _names = [f.split()[0] for f in _ALIGNED.split(", ")]
    return docs.select(row_id(), "doc_id", "text").mapInArrow(run, _ALIGNED)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, held, best): how many of the ``aligned`` rows hold each pair, and
    whether that is the highest of the pair's A id."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("held"))
    of_a = Window.partitionBy(F.shiftright("pair", PAIR_BITS))  # at most one row per B id
    return counts.withColumn("best", F.col("held") == F.max("held").over(of_a))


def agreement(docs: DataFrame, byte_bpe: str, pieces: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256."""
    rows = save(aligned(docs, byte_bpe, pieces, keep_groups=False).drop("groups"), "aligned")
    counts = save(pair_counts(rows), "pair-counts")
    total = counts.agg(F.coalesce(F.sum("held"), F.lit(0))).first()[0]
    often = F.col("held") * COMMON >= total  # at most COMMON pairs, whatever the corpus
    common = F.broadcast(counts.where(often))
    links = rows.select("_rid", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("held")).alias("count_sum")]
    near = links.join(common, "pair").groupBy("_rid").agg(*sums)
    far = links.join(common.select("pair"), "pair", "left_anti").join(counts.where(~often), "pair").groupBy("_rid").agg(*sums)
    both = near.unionAll(far).groupBy("_rid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    whole = rows.drop("pairs", "times").join(both, "_rid", "left")
    return whole.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256",
    )


def query(spark, sf_dir):
    import public_tokenizers

    from pitwall.llm.common import table

    path = public_tokenizers.path
    return agreement(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))

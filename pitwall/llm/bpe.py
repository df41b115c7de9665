"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

The splitting pattern of the vocabulary is a small automaton. Each code point
becomes a symbol (its class, with what the next code points say about spaces
and contractions); each symbol is a function from automaton state to state.
Functions compose associatively and only a few dozen different ones can arise,
so they are numbered and composed by one table lookup. The scan cuts the text
into rows, composes each row's function (all rows at once, column by column),
carries the state over the rows, and then reads off where pieces start.

Equal pieces are merged once: pieces of a run of texts are grouped by a
64-bit hash that is then checked byte for byte, and each distinct piece goes
through the vocabulary's pair merging behind a cache. Offsets of pieces and
documents are kept, so ids can be decoded per document.

Defined results: null and empty texts have no ids; repeated rows are each
returned. Texts are encoded whole; memory follows ``RUN_CHARS`` or the longest
text. Only the id and text columns are read.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
from pyspark.sql import DataFrame

from pitwall.llm.common import texts

RUN_CHARS = 1_500_000
CACHED_PIECES = 400_000

# Symbols. SPACE_END is a U+0020 before a non-space, WHITE_END any other white
# space before a non-space, WHITE one before more white space or the end. MARK1
# and MARK2 are apostrophes before a contraction of one or two letters. STOP
# lies between texts.
LETTER, NUMBER, OTHER, WHITE, SPACE_END, WHITE_END, MARK1, MARK2, STOP = range(9)
# States: what the last code point belongs to. ONE and TWO: in a contraction
# with so many letters to come.
NONE, IN_LETTER, IN_NUMBER, IN_OTHER, IN_WHITE, AFTER_SPACE, ONE, TWO = range(8)

#: Code points with the White_Space property.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a piece starts at this code point."""
    if symbol == STOP:
        return NONE, True
    if symbol == SPACE_END:
        return AFTER_SPACE, True
    if symbol == WHITE_END:
        return NONE, True
    if symbol == WHITE:
        return IN_WHITE, state != IN_WHITE
    if state in (ONE, TWO):  # the symbol is a letter here
        return (ONE if state == TWO else NONE), False
    inside = {LETTER: IN_LETTER, NUMBER: IN_NUMBER}.get(symbol, IN_OTHER)
    if state in (inside, AFTER_SPACE):
        return inside, False
    if symbol in (MARK1, MARK2):
        return (ONE if symbol == MARK1 else TWO), True
    return inside, True


@cache
def automaton():
    """(next state by symbol and state, starts by symbol and state, function
    number by symbol, composition table, functions)."""
    step = np.array([[_step(s, c)[0] for s in range(8)] for c in range(9)], np.uint8)
    starts = np.array([[_step(s, c)[1] for s in range(8)] for c in range(9)], bool)
    functions: list[tuple] = [tuple(range(8))]
    for f in map(tuple, step.tolist()):
        if f not in functions:
            functions.append(f)
    at = 0
    while at < len(functions):  # all compositions that can arise
        for g in map(tuple, step.tolist()):
            h = tuple(g[functions[at][s]] for s in range(8))
            if h not in functions:
                functions.append(h)
        at += 1
    number = {f: i for i, f in enumerate(functions)}
    then = np.array([[number[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint8)
    of_symbol = np.array([number[tuple(f)] for f in step.tolist()], np.uint8)
    return step, starts, of_symbol, then, np.array(functions, np.uint8)


@cache
def classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or WHITE by code point."""
    import regex

    table = np.full(0x110000, OTHER, np.uint8)
    alphabet = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, alphabet):
            shift = [0 if i < 0xD800 else 0x800 for i in (m.start(), m.end() - 1)]
            table[m.start() + shift[0] : m.end() + shift[1]] = kind
    table[WHITE_SPACE] = WHITE
    return table


def symbols(points: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Symbol of each code point; ``stops`` are the places between texts."""
    sym = classes()[points]
    sym[stops] = STOP
    white = sym == WHITE
    ends = white.copy()
    ends[:-1] &= sym[1:] <= OTHER
    ends[-1:] = False
    sym[ends] = WHITE_END
    sym[ends & (points == 32)] = SPACE_END
    marks = np.flatnonzero(points == 39)
    if marks.size:
        marks = marks[sym[marks] == OTHER]
        far = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = far[marks + 1], far[marks + 2]
        pair = one.astype(np.int64) << 32 | two
        pairs = [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")]
        # the next code point may be a STOP, whose text is not a letter
        sym[marks[np.isin(one, [ord(c) for c in "stmd"])]] = MARK1
        sym[marks[np.isin(pair, pairs)]] = MARK2
    return sym


def piece_starts(sym: np.ndarray) -> np.ndarray:
    """Places where pieces start (each STOP is one of them)."""
    step, starts, of_symbol, then, functions = automaton()
    n = len(sym)
    rows = max(1, min(4096, n // 64))
    width = -(-n // rows)
    # columns[j] holds place j of every row; the padding changes nothing that is read
    columns = np.full((rows * width), STOP, np.uint8)
    columns[:n] = sym
    columns = np.ascontiguousarray(columns.reshape(rows, width).T)
    count, made = len(functions), of_symbol[columns]
    flat = then.ravel()
    f = made[0].copy()
    for j in range(1, width):
        f = flat[f.astype(np.int64) * count + made[j]]
    states = np.zeros(rows, np.int64)
    for r in range(1, rows):
        states[r] = functions[f[r - 1], states[r - 1]]
    out = np.empty((width, rows), bool)
    step, starts = step.ravel(), starts.ravel()
    for j in range(width):
        place = columns[j].astype(np.int64) * 8 + states
        out[j] = starts[place]
        states = step[place].astype(np.int64)
    return np.flatnonzero(out.T.ravel()[:n])


_ODD = np.uint64(0x9E3779B97F4A7C15)


class Hasher:
    """64-bit polynomial hashes of byte slices, all at once."""

    def __init__(self):
        self.powers = self.inverse = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.powers) < n:
            with np.errstate(over="ignore"):
                base = np.full(n, _ODD, np.uint64)
                base[0] = 1
                self.powers = np.cumprod(base, dtype=np.uint64)
                base[1:] = np.uint64(pow(int(_ODD), -1, 1 << 64))
                self.inverse = np.cumprod(base, dtype=np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(data)
        self.grow(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=sums[1:])
        h = (sums[ends] - sums[starts]) * self.inverse[starts]
        return h ^ (h >> np.uint64(29))


class Encoder:
    """Encodes runs of texts. ``merge`` gives the ids of one piece's bytes."""

    def __init__(self, merge: Callable[[list[bytes]], list[list[int]]]):
        self.merge, self.cache, self.hash = merge, {}, Hasher()

    def ids_of(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each distinct piece, as the bytes of 32-bit numbers."""
        if len(self.cache) > CACHED_PIECES:
            self.cache.clear()
        new = [p for p in pieces if p not in self.cache]
        if new:
            merged = self.merge(new)
            sizes = np.cumsum([0, *map(len, merged)]).tolist()
            raw = np.array([i for ids in merged for i in ids], np.int32).tobytes()
            for p, a, b in zip(new, sizes, sizes[1:]):
                self.cache[p] = raw[4 * a : 4 * b]
        return [self.cache[p] for p in pieces]

    def __call__(self, run: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of ``run``, one after the other, and the offsets of
        the texts in them (one more than texts)."""
        joined = "\0".join(run) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        stops = np.cumsum([len(t) + 1 for t in run]) - 1
        starts = piece_starts(symbols(points, stops))
        del points
        data, at = self._bytes(joined)
        # pieces between starts; the STOPs themselves are dropped
        begin, end = at[starts], at[np.append(starts[1:], len(at) - 1)]
        doc = np.searchsorted(stops, starts)
        real = starts != stops[np.minimum(doc, len(stops) - 1)]
        begin, end, doc = begin[real], end[real], doc[real]
        if not len(begin):
            return np.zeros(0, np.int32), np.zeros(len(run) + 1, np.int64)
        _, first, which = np.unique(self.hash(data, begin, end), return_index=True, return_inverse=True)
        raw = data.tobytes()
        if not self._same(data, begin, end, first, which):  # two pieces share a hash
            slices = [raw[b:e] for b, e in zip(begin.tolist(), end.tolist())]
            place = {p: i for i, p in enumerate(dict.fromkeys(slices))}
            which, distinct = np.array([place[p] for p in slices]), list(place)
        else:
            distinct = [raw[b:e] for b, e in zip(begin[first].tolist(), end[first].tolist())]
        ids = self.ids_of(distinct)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        flat, where = np.frombuffer(b"".join(ids), np.int32), np.cumsum(sizes) - sizes
        count = sizes[which]
        before = np.cumsum(count) - count
        out = flat[np.repeat(where[which] - before, count) + np.arange(int(count.sum()))]
        per_doc = np.bincount(doc, weights=count, minlength=len(run)).astype(np.int64)
        return out, np.concatenate([[0], np.cumsum(per_doc)])

    @staticmethod
    def _bytes(joined: str) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes, and the byte offset of each code point and of the end."""
        data = np.frombuffer(joined.encode(), np.uint8)
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        return data, np.append(heads, len(data))

    @staticmethod
    def _same(data, begin, end, first, which) -> bool:
        """Whether each piece equals the first piece with its hash."""
        size = end - begin
        if not np.array_equal(size, size[first][which]):
            return False
        ends = np.cumsum(size)
        own = np.arange(ends[-1]) - np.repeat(ends - size, size)
        return np.array_equal(
            data[own + np.repeat(begin, size)], data[own + np.repeat(begin[first][which], size)]
        )


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def rank_merger(ranks: dict[bytes, int]) -> Callable[[list[bytes]], list[list[int]]]:
    """Pair merging of single pieces by the tiktoken library."""
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    return lambda pieces: [own._core_bpe.encode_single_piece(p) for p in pieces]


def json_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a byte-level BPE file of the tokenizers library, whose ids are
    in merge order. Its tokens write each byte as a printable character: the
    byte's own where that is printable, else 256 and up in byte order."""
    import json

    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["model"]["vocab"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in byte_of.values())}
    return {bytes(byte_of[c] for c in t): i for t, i in tokens.items() if all(c in byte_of for c in t)}


def vocabulary(ranks: dict[bytes, int]) -> list[bytes]:
    out = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        out[i] = token
    return out


def decode(ids: np.ndarray | list[int], words: list[bytes]) -> bytes:
    return b"".join(map(words.__getitem__, ids if isinstance(ids, list) else ids.tolist()))


def encoded_runs(encoder: Encoder, batches: Iterator) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(row ids, ids of each text) for each run of texts of Arrow batches."""
    for rows, run in texts(batches, RUN_CHARS):
        ids, at = encoder(run)
        yield rows, [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def encode(docs: DataFrame, rank_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id and ``ids`` (array of int)."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind, id_type = docs.schema[id_col].dataType.simpleString(), to_arrow_type(docs.schema[id_col].dataType)

    def run(batches):
        import pyarrow as pa

        encoder = Encoder(rank_merger(read_ranks(rank_path)))
        for rows, run_ids in encoded_runs(encoder, batches):
            at = np.cumsum([0, *map(len, run_ids)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(run_ids)))
            yield pa.RecordBatch.from_arrays([pa.array(rows, id_type), ids], names=[id_col, "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def round_trip(docs: DataFrame, rank_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode, then decode the ids."""

    def run(batches):
        import hashlib

        import pyarrow as pa

        ranks = read_ranks(rank_path)
        encoder, words = Encoder(rank_merger(ranks)), vocabulary(ranks)
        decimal = [str(i) for i in range(len(words))]
        for rows, run_ids in encoded_runs(encoder, batches):
            counts, of_ids, of_text = [], [], []
            for ids in run_ids:
                ids = ids.tolist()
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                of_text.append(hashlib.sha256(decode(ids, words)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def query(spark, sf_dir):
    import public_tokenizers

    from pitwall.llm.common import table

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))

"""Secret scan: fixed key patterns plus sliding-window entropy.

Candidate strings are the maximal runs of key characters. Inside a candidate a
window of ``Alphabet.window`` characters slides over each stretch of one
character class; its Shannon entropy is kept by incremental counts (one
character in, one out), and windows above the class's threshold are merged
into spans. An allow-list suppresses strings that are long but not secret.

The fixed kinds are found in the same candidates (``access`` and ``hex`` can
only lie in a candidate of 20 characters) or, for ``assign``, in texts that
have a ``:`` or ``=``, which the pattern needs.

Defined results: null and empty texts have no spans; repeated rows are each
returned; positions are code points, end exclusive. Texts are scanned whole;
memory follows the longest text. Only the id and text columns are read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.llm.common import texts

# The base patterns and their order.
KINDS = ["assign", "access", "hex", "entropy"]
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{20,}")


@dataclass(frozen=True)
class Alphabet:
    """A character class, its window and the bits per character from which a
    window counts as random (a window of 20 has at most 4.32)."""

    pattern: str
    window: int
    bits: float


#: All are tried on every stretch; spans that overlap are merged.
ALPHABETS = (
    Alphabet(r"[0-9a-fA-F]+", 24, 3.0),
    Alphabet(r"[A-Za-z0-9]+", 20, 3.7),
    Alphabet(r"[A-Za-z0-9+/=]+", 24, 4.0),
    Alphabet(r"[A-Za-z0-9_-]+", 24, 4.0),
)

#: Longer spans are reported whatever words they happen to contain.
PLACEHOLDER = 128

#: A span that one of these matches is not reported; an anchored one (from ``^``)
#: speaks for whole candidates too, the others for spans of a key's length only.
ALLOWED = (
    r"^[a-z]+$|^[A-Z]?[a-z]+$|^[A-Z]+$",  # one word
    r"^[0-9.,+/=_-]+$",  # numbers, phone numbers, dates, rulers
    r"^(.)\1+$",
    r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",  # UUIDs
    r"^[A-Za-z]+([-_./][A-Za-z]+)*$",  # words joined into paths, hosts, names
    r"(?i)example|placeholder|xxxx|your[-_]?(key|token|secret)",
)


def window_spans(s: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Merged spans of ``s`` whose windows have at least ``bits`` of entropy.

    With counts c of the window's characters, H = log2(w) - sum(c log2 c) / w;
    a step changes two counts, so the sum is kept incrementally."""
    n = len(s)
    if n < window:
        return []
    clog = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    top = math.log2(window)
    counts, total = {}, 0.0
    spans: list[tuple[int, int]] = []
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        total += clog[c + 1] - clog[c]
        counts[ch] = c + 1
        if i >= window:
            out = s[i - window]
            c = counts[out]
            total += clog[c - 1] - clog[c]
            counts[out] = c - 1
        if i >= window - 1 and top - total / window >= bits - 1e-9:
            start = i - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def entropy_spans(s: str, alphabets=ALPHABETS, allowed=ALLOWED) -> list[tuple[int, int]]:
    """Spans of a candidate string that look random in some character class;
    those that overlap are one."""
    allow = [re.compile(p) for p in allowed]
    whole = [p for p in allow if p.pattern.startswith("^")]
    if any(p.search(s) for p in whole):
        return []
    found: list[tuple[int, int]] = []
    for a in alphabets:
        for m in re.finditer(a.pattern, s):
            part = m.group()
            if len(part) < a.window:
                continue
            for b, e in window_spans(part, a.window, a.bits):
                if not any(p.search(part[b:e]) for p in (allow if e - b <= PLACEHOLDER else whole)):
                    found.append((m.start() + b, m.start() + e))
    out: list[tuple[int, int]] = []
    for b, e in sorted(found):
        if out and b < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


def scan_text(text: str, alphabets=ALPHABETS, allowed=ALLOWED) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every span, sorted. One pass: a candidate meets
    only the base spans that reach into it."""
    assigned = []
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= MIN_ASSIGN:
                assigned.append((m.start(), 0, m.end()))
    out, near = list(assigned), 0
    for c in CANDIDATE.finditer(text):
        run, at = c.group(), c.start()
        here = []
        if "AKIA" in run:
            here += [(at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(run) if m.end() - m.start() >= MIN_ACCESS]
        if len(run) >= MIN_HEX:
            here += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(run) if m.end() - m.start() >= MIN_HEX]
        out += here
        while near < len(assigned) and assigned[near][2] <= at:
            near += 1
        k = near
        while k < len(assigned) and assigned[k][0] < c.end():
            here.append(assigned[k])
            k += 1
        found = entropy_spans(run, alphabets, allowed)
        base = merged([(s, e) for s, _, e in here]) if found else []
        starts = [s for s, _ in base]
        for b, e in found:  # dropped only if base spans hold all of it
            k = bisect_right(starts, at + b) - 1
            if k < 0 or base[k][1] < at + e:
                out.append((at + b, 3, at + e))
    return sorted(out)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, those that touch joined."""
    out: list[tuple[int, int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


SPANS = "array<struct<start:int,kind:int,end:int,found:string>>"


def secret_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alphabets=ALPHABETS, allowed=ALLOWED
) -> DataFrame:
    """One row per row of ``docs``: the id, ``spans`` (start, kind number, end,
    found text) and ``redacted`` (the text with every span replaced by
    [SECRET]; null if there is none)."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(docs.schema[id_col].dataType)
    schema = T.StructType(
        [docs.schema[id_col], *T._parse_datatype_string(f"spans {SPANS}, redacted string").fields]
    )

    def run(batches):
        import pyarrow as pa

        types = [pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("found", pa.string())])]
        for ids, group in texts(batches):
            spans, clean = [], []
            for t in group:
                hits = scan_text(t, alphabets, allowed)
                spans.append([{"start": s, "kind": k, "end": e, "found": t[s:e]} for s, k, e in hits])
                clean.append(redact(t, hits) if hits else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(spans, pa.list_(types[0])), pa.array(clean, pa.string())],
                names=[id_col, "spans", "redacted"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def redact(text: str, hits: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with the union of the spans replaced by ``mark``."""
    parts, at, end = [], 0, -1
    for s, _, e in hits:
        if s > end:
            if end >= 0:
                parts.append(mark)
                at = end
            parts.append(text[at:s])
            end = e
        else:
            end = max(end, e)
    parts += [mark, text[end:]]
    return "".join(parts)


def query(spark, sf_dir):
    from pitwall.llm.common import table

    found = secret_spans(table(spark, sf_dir, "documents")).select("doc_id", "spans")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    def line(spans):
        names = F.array(*[F.lit(k) for k in KINDS])
        one = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
        return F.array_join(one, ",")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(line(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        line(F.col("spans")).alias("spans"),
    )

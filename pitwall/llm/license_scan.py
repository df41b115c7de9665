"""License scan: fuzzy search for short notices.

A notice that may have k edits is split into k + 1 pieces; any occurrence with
at most k edits has one of the pieces unchanged (pigeonhole). One
multi-pattern pass finds all pieces, each hit gives a candidate window, and
the regex library's bounded-error matching verifies the edits in the window
and reports the span. Texts are normalised first: A-Z lower-cased, words
joined by one space; a match must begin and end at word ends.

Defined results: null and empty texts have no words and no spans, score 0.
Overlapping spans of different notices are all kept; of one notice, spans with
the same extent count once. Repeated rows are each returned. Texts are read
whole; memory follows the longest text. Only the id and text columns are read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import texts

#: bytes.translate table: A-Z lower-cased, ASCII other than letters and digits
#: to space, bytes of non-ASCII characters unchanged.
NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


@dataclass(frozen=True)
class Notice:
    """A normalised notice, its label and the edits it may have."""

    text: str
    label: str
    edits: int
    base: bool = False


# The base phrases, and public notices of common licenses.
NOTICES = (
    Notice("mit license", "mit", 1, True),
    Notice("apache license", "apache", 1, True),
    Notice("general public license", "gpl", 2, True),
    Notice("permission is hereby granted free of charge to any person obtaining a copy", "mit", 5),
    Notice("licensed under the apache license version 2 0", "apache", 3),
    Notice("gnu lesser general public license", "lgpl", 2),
    Notice("gnu affero general public license", "agpl", 2),
    Notice("mozilla public license", "mpl", 2),
    Notice("redistribution and use in source and binary forms with or without modification are permitted", "bsd", 6),
    Notice("creative commons attribution", "cc by", 2),
    Notice("boost software license", "bsl", 2),
    Notice("eclipse public license", "epl", 2),
    Notice("this is free and unencumbered software released into the public domain", "unlicense", 5),
)


def pieces(text: str, edits: int) -> list[tuple[int, str]]:
    """``edits`` + 1 pieces of near equal length, with their places."""
    n, k = len(text), edits + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """Finds all notices in a normalised text."""

    def __init__(self, notices=NOTICES):
        import ahocorasick
        import regex

        self.notices = notices
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, n in enumerate(notices):
            for at, piece in pieces(n.text, n.edits):
                seeds.setdefault(piece, []).append((i, at))
        self.machine = ahocorasick.Automaton()
        for piece, where in seeds.items():
            self.machine.add_word(piece, (len(piece), where))
        self.machine.make_automaton()
        self.verify = [
            regex.compile(rf"(?b)(?<!\S)(?:{regex.escape(n.text, literal_spaces=True)}){{e<={n.edits}}}(?!\S)")
            for n in notices
        ]

    def spans(self, text: str) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, errors), each exact place and each fuzzy one."""
        found, windows = set(), {}
        for end, (size, where) in self.machine.iter(text):
            for i, at in where:
                n = self.notices[i]
                start = end - size + 1 - at
                if start >= 0 and text.startswith(n.text, start) and self.at_word_ends(text, start, start + len(n.text)):
                    found.add((start, start + len(n.text), i, 0))
                else:
                    windows.setdefault(i, set()).add(start)
        for i, starts in windows.items():
            n = self.notices[i]
            for start in sorted(starts):
                # the edits may shift the start, and the match may be longer by as many
                lo, hi = max(0, start - n.edits), start + len(n.text) + 2 * n.edits + 1
                hit = self.verify[i].search(text, lo, min(len(text), hi), concurrent=False)
                if hit and self.at_word_ends(text, *hit.span()):
                    found.add((*hit.span(), i, sum(hit.fuzzy_counts)))
        return self.best(found)

    @staticmethod
    def at_word_ends(text: str, start: int, end: int) -> bool:
        return (start == 0 or text[start - 1] == " ") and (end >= len(text) or text[end] == " ")

    def best(self, found: set) -> list:
        """Drops fuzzy spans that overlap a better span of the same notice. Spans are
        no longer than their notice with its edits, so each looks at its neighbours."""
        out, kept = [], {}
        for s in sorted(found, key=lambda s: (s[3], s[0], s[1])):
            starts, ends = kept.setdefault(s[2], ([], {}))
            n = self.notices[s[2]]
            k, free = bisect_left(starts, s[1]), True
            while s[3] and free and k and starts[k - 1] > s[0] - len(n.text) - n.edits:
                k -= 1
                free = ends[starts[k]] <= s[0]
            if free:
                if s[0] not in ends:
                    insort(starts, s[0])
                ends[s[0]] = max(s[1], ends.get(s[0], 0))
                out.append(s)
        return sorted(out)


def normalised_words(text: str) -> list[bytes]:
    return text.encode().translate(NORMAL).split()


SPANS = (
    "array<struct<label:string,base:boolean,errors:int,size:int,first_word:bigint,last_word:bigint,found:string>>"
)


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices=NOTICES) -> DataFrame:
    """One row per row of ``docs``: the id, n_words and spans (label, whether
    of a base phrase, edits, notice length, first and last word, text found)."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(docs.schema[id_col].dataType)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        scanner = Scanner(notices)
        span = pa.struct(
            [("label", pa.string()), ("base", pa.bool_()), ("errors", pa.int32()), ("size", pa.int32()),
             ("first_word", pa.int64()), ("last_word", pa.int64()), ("found", pa.string())]
        )
        for ids, group in texts(batches):
            counts, spans = [], []
            for t in group:
                words = normalised_words(t)
                text = b" ".join(words).decode()
                counts.append(len(words))
                spans.append(described(text, scanner.spans(text), notices))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(span))],
                names=[id_col, "n_words", "spans"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_words bigint, spans {SPANS}")


def described(text: str, found: list, notices) -> list[dict]:
    if not found:
        return []
    spaces = [i for i, c in enumerate(text) if c == " "]
    out = []
    for start, end, i, errors in found:
        n = notices[i]
        out.append(
            {"label": n.label, "base": n.base, "errors": errors, "size": len(n.text), "first_word": bisect_left(spaces, start),
             "last_word": bisect_left(spaces, end - 1), "found": text[start:end]}
        )
    return out


def query(spark, sf_dir):
    """``score`` is the best similarity of a span (1 - edits / notice length),
    0 without spans."""
    from pitwall.llm.common import table

    found = license_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"] & (s["errors"] == 0))

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    starts = F.transform(base, lambda s: s["first_word"])
    similar = F.transform("spans", lambda s: 1 - s["errors"] / s["size"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(similar), F.lit(0.0)).alias("score"),
        F.size("spans").cast("bigint").alias("n_spans"),
    )

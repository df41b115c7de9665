"""The pipeline's stages against brute force on the test corpus."""

import math
import re

import corpus_pipeline
from pitwall.llm import secret_scan
from pitwall.llm.common import save
from test_operators import LOWER, SCHEMA, corpus

BLANK = r"[^\x20\x09-\x0D]+"


def words(text):
    return re.findall(BLANK, text or "")


def rules_keep(text):
    """The base rules; the corpus is too small for a fit, which rejects nothing."""
    w = words(text)
    at = {}
    for k in range(len(w) - 7):
        at.setdefault(tuple(w[k : k + 8]), []).append(k)
    repeated = {k + j for places in at.values() if len(places) > 1 for k in places for j in range(8)}
    return len(w) >= 20 and 100 * len(repeated) <= 30 * len(w)


def last_of_equal(rows):
    last = {(t or "").translate(LOWER): i for i, t in sorted(rows.items())}
    return {i: rows[i] for i in last.values()}


def first_of_near(rows):
    sets = {}
    for i, t in rows.items():
        w = words((t or "").translate(LOWER))
        sets[i] = set(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else {tuple(w)} if w else set()
    least = {i: i for i in rows}
    for a in sorted(rows):
        for b in sorted(rows):
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((least[a], least[b]))
                least = {i: x if r == y else r for i, r in least.items()}
    return {i: t for i, t in rows.items() if least[i] == i}


def random_places(run):
    """Places of a candidate in windows that look random, each window counted anew."""
    whole = [p for p in secret_scan.ALLOWED if p.startswith("^")]
    out = set()
    if any(re.search(p, run) for p in whole):
        return out
    for a in secret_scan.ALPHABETS:
        for m in re.finditer(a.pattern, run):
            hit = set()
            for i in range(m.start(), m.end() - a.window + 1):
                w = run[i : i + a.window]
                if -sum(w.count(c) / len(w) * math.log2(w.count(c) / len(w)) for c in set(w)) >= a.bits - 1e-9:
                    hit |= set(range(i, i + a.window))
            for b in sorted(p for p in hit if p - 1 not in hit):
                e = next(p for p in range(b, len(run) + 1) if p not in hit)
                allowed = secret_scan.ALLOWED if e - b <= secret_scan.PLACEHOLDER else whole
                if not any(re.search(p, run[b:e]) for p in allowed):
                    out |= set(range(b, e))
    return out


def redacted(text):
    gone = set()
    for m in re.finditer(r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        gone |= set(range(*m.span())) if len(m[2]) >= 6 else set()
    for pattern in (r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"):
        for m in re.finditer(pattern, text):
            gone |= set(range(*m.span()))
    for m in re.finditer(r"[A-Za-z0-9+/_.=-]{20,}", text):
        gone |= {m.start() + p for p in random_places(m.group())}
    return "".join("" if p in gone and p - 1 in gone else "[SECRET]" if p in gone else c for p, c in enumerate(text))


def test_stages_against_brute_force(spark):
    rows = corpus()
    tail = " Zk3vQ9xT1mLr8YpW2nBs5HdK/7uE+cRf4Gj0oXaVi password = hunter22x end"
    for place in (8, 20):  # long enough to pass the rules and to be kept
        rows.append((len(rows), rows[place + 10][1] + tail + f" {place}", *rows[place][2:]))
    docs = save(spark.createDataFrame(rows, SCHEMA), "test-brute-force")
    texts = {r[0]: r[1] for r in rows}
    wanted = {
        "quality_rules": {i: t for i, t in texts.items() if rules_keep(t)},
        "exact_dedup": last_of_equal(texts),
        "jaccard_join": first_of_near(texts),
        "secret_scans": {i: t and redacted(t) for i, t in texts.items()},
    }
    assert any(t and "[SECRET]" in t for t in wanted["secret_scans"].values())
    for name, stage in corpus_pipeline.STAGES[:-1]:  # each on the whole corpus
        assert {r.doc_id: r.text for r in stage(spark, docs, "").select("doc_id", "text").collect()} == wanted[name], name

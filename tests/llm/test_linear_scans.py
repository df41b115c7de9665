"""Texts with very many secrets or near notices take time in proportion, and the merged
bookkeeping equals the plain rules."""

import random
import time

from pitwall.llm import license_scan, secret_scan


def secrets(n, seed=1):
    rnd = random.Random(seed)
    made = ["password = hunter22x%d", "AKIAABCDEFGHIJKL%06d", "deadbeefdeadbeefdeadbeef%d", "k9Xq2vLr8TzW4bNm7YpC1sHd%d", "token: \"zQ7%d\""]
    return "".join(rnd.choice(made) % rnd.randrange(10**6) + rnd.choice([" some words between them and more ", "\n"]) * 3 for _ in range(n))


def plain_rules(text):
    """Every span against all base spans found so far, as a loop."""
    out = []
    for m in secret_scan.ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= secret_scan.MIN_ASSIGN:
            out.append((m.start(), 0, m.end()))
    for c in secret_scan.CANDIDATE.finditer(text):
        run, at = c.group(), c.start()
        for kind, pattern, least in ((1, secret_scan.ACCESS, secret_scan.MIN_ACCESS), (2, secret_scan.HEX, secret_scan.MIN_HEX)):
            out += [(at + m.start(), kind, at + m.end()) for m in pattern.finditer(run) if m.end() - m.start() >= least]
        base = sorted(s for s in out if s[1] < 3)
        for b, e in secret_scan.entropy_spans(run):
            covered = at + b
            for s, _, t in base:
                covered = t if s <= covered < t else covered
            if covered < at + e:
                out.append((at + b, 3, at + e))
    return sorted(out)


def test_spans_equal_the_plain_rules():
    for seed in range(5):
        text = secrets(60, seed) + "secret=" + "Zk3vQ9xT1mLr8YpW2nBs5HdK/7uE+cRf4Gj0oXaVi" * 3
        assert secret_scan.scan_text(text) == plain_rules(text)


def test_many_secrets_in_one_text():
    text = secrets(65_000)
    assert len(text) > 4_000_000
    begin = time.process_time()
    spans = secret_scan.scan_text(text)
    assert len(spans) >= 50_000 and time.process_time() - begin < 60


def test_one_unbroken_run():
    rnd = random.Random(2)
    made = {n: "".join(rnd.choice("ABCDEFGHabcdefgh0123456789+/") for _ in range(n)) for n in (150_000, 600_000)}
    took = {}
    for n, text in made.items():
        begin = time.process_time()
        assert secret_scan.scan_text(text)
        took[n] = time.process_time() - begin
    assert took[600_000] < 10 * took[150_000]


def test_many_near_notices():
    scanner = license_scan.Scanner()
    n = next(x for x in license_scan.NOTICES if x.edits)
    broken = n.text[:3] + "q" + n.text[4:]

    def spans(k):
        begin = time.process_time()
        found = scanner.best({(i * (len(n.text) + 1), i * (len(n.text) + 1) + len(n.text), scanner.notices.index(n), 1 + i % 2) for i in range(k)})
        return len(found), time.process_time() - begin

    few, many = spans(10_000), spans(80_000)
    assert few[0] == 10_000 and many[0] == 80_000 and many[1] < 30 * few[1]
    text = " ".join([broken] * 2000)
    assert len([s for s in scanner.spans(text) if scanner.notices[s[2]] is n]) == 2000


def test_overlapping_near_notices_keep_the_best():
    scanner = license_scan.Scanner()
    i = next(k for k, x in enumerate(scanner.notices) if x.edits)
    size = len(scanner.notices[i].text)
    found = {(10, 10 + size, i, 1), (12, 12 + size, i, 2), (10 + size, 10 + 2 * size, i, 2), (11, 11 + size, i, 0), (9, 9 + size, i, 0)}
    assert scanner.best(found) == [(9, 9 + size, i, 0), (11, 11 + size, i, 0)]

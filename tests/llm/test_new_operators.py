"""SimHash components, hard negatives and tokenizer alignment against brute force."""

import hashlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pandas as pd
import pytest
from oracle import compare, duckdb_connection
from test_operators import LOWER, SCHEMA, corpus

from pitwall.llm import alignment, hard_negatives, simhash
from pitwall.llm.common import save, scratch

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTE_BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    path = scratch(spark, "test-docs")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return save(spark.createDataFrame([], SCHEMA), "test-none")


# --- simhash ---------------------------------------------------------------
def fingerprint(text):
    import xxhash

    words = [w for w in (text or "").translate(LOWER).encode().split()]
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def linked_to(fps, threshold=2):
    """The least index reachable from each of ``fps``."""
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= threshold:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_simhash_components(spark, docs, rows, none):
    fps = {r[0]: fingerprint(r[1]) for r in rows}
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert {i: r.fp % (1 << 64) for i, r in got.items()} == fps
    ids = sorted(fps)
    want = dict(zip(ids, (ids[k] for k in linked_to([fps[i] for i in ids]))))
    assert {i: r.component_id for i, r in got.items()} == want
    assert len(set(want.values())) < len(set(fps.values())) <= len(ids)  # links and copies are there
    assert simhash.near_duplicates(none).collect() == []


def test_simhash_query_columns(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    out = simhash.query(spark, str(tmp_path))
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    assert {r.doc_id: r.fingerprint for r in out.collect()} == {r[0]: f"{fingerprint(r[1]):016x}" for r in rows}


def clustered(seed, centres, near, far):
    """Fingerprints around centres, with up to 3 flipped bits, and others at random."""
    rng = np.random.default_rng(seed)
    out = [int(x) for x in rng.integers(0, 1 << 63, far, dtype=np.int64)]
    for c in rng.integers(0, 1 << 63, centres, dtype=np.int64).tolist():
        out += [c ^ sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, 4)))) for _ in range(near)]
    return sorted(set(out))


@pytest.mark.parametrize("hot", [1024, 3, 0])
def test_links_of_dense_clusters(spark, hot):
    """Also with the homes of the clusters, or all, crowded, where hubs take the place of anchors."""
    fps = clustered(1, 4, 60, 150)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    homes = simhash.visits(np.array(fps, np.uint64), 0)[1].tolist()
    classes = spark.createDataFrame(list(zip(signed, homes)), "fp bigint, home bigint")
    links = simhash.near_links(classes, hot=hot).collect()
    assert all(bin((r.u ^ r.v) % (1 << 64)).count("1") <= 2 for r in links) or hot
    root = {s: s for s in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in links:
        root[find(r.u)] = find(r.v)
    groups = defaultdict(set)
    for i, s in enumerate(signed):
        groups[find(s)].add(i)
    want = defaultdict(set)
    for i, r in enumerate(linked_to(fps)):
        want[r].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_every_fingerprint_has_one_home_within_the_radius():
    fps = np.random.default_rng(3).integers(0, 1 << 63, 500, dtype=np.int64).view(np.uint64)
    place, anchor, home = simhash.visits(fps)
    assert (np.bincount(place[home], minlength=500) == 1).all()
    apart = [[int((int(fps[p]) >> s ^ a >> s) & (1 << 23) - 1).bit_count() for s in (0, 23)] for p, a in zip(place.tolist(), anchor.tolist())]
    assert all(sum(max(0, d - 3) for d in ds) <= 2 for ds in apart)
    assert all(max(ds) <= 3 for ds, h in zip(apart, home) if h)
    # who differs in up to two bits visits that home
    homes = {p: a for p, a, h in zip(place.tolist(), anchor.tolist(), home) if h}
    rng = np.random.default_rng(4)
    moved = fps ^ np.array([sum(1 << int(b) for b in set(rng.integers(0, 46, 2))) for _ in fps], np.uint64)
    place, anchor, _ = simhash.visits(moved)
    assert {(i, homes[i]) for i in range(500)} <= set(zip(place.tolist(), anchor.tolist()))


# --- hard negatives --------------------------------------------------------
VECTORS = "vec_id bigint, embedding array<float>, label int, x int, windows string, _rid int"


def brute_negatives(rows):
    use = []
    for place, (i, v, label) in enumerate(rows):
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        use.append((i, place, label, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    out = []
    for i, place, label, v in use:
        if i % 100:
            continue
        score = [(-sum(a * b for a, b in zip(v, w)), j, q, lab) for j, q, lab, w in use if q != place]
        for s, j, _, lab in [x for x in sorted(score) if x[3] == label][:5]:
            fit = [x for x in sorted(score) if x[3] != label and 30 * -s <= 100 * -x[0] <= 90 * -s]
            out += [(i, j, n + 1, x[1], -s, -x[0]) for n, x in enumerate(fit[:10])]
    return sorted(out)


def vector_rows():
    rng = np.random.default_rng(5)
    rows = [(i, (np.round(rng.normal(0, 1, 8) * 4) / 64).tolist(), int(rng.integers(0, 4))) for i in range(900)]
    rows[100] = (100, [0.0] * 8, 1)  # all scores are ties
    rows += [(i, v, lab) for i, v, lab in rows[200:203]]  # repeated rows, an anchor among them
    rows += [(901, None, 1), (902, [1.0, None], 2), (903, [float("nan")] * 8, 2), (904, [float("inf")] * 8, 2),
             (905, [0.5] * 8, None), (None, [0.5] * 8, 1), (906, [], 3), (907, [0.25, 0.5], 3), (1000, [0.5, -0.5], 3)]
    return rows


@pytest.mark.parametrize("block", [64, 8192])
def test_hard_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 4 if block == 64 else 1024)
    monkeypatch.setattr(hard_negatives, "FIRST_STEP", 2)
    rows = vector_rows()
    path = scratch(spark, "vectors")
    spark.createDataFrame([(*r, 1, "w", 2) for r in rows], VECTORS).coalesce(1).write.parquet(f"{path}/embeddings.parquet")
    got = hard_negatives.query(spark, path)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows)


def test_hard_negatives_of_nothing(spark):
    for rows in ([], [(1, [0.5], 1, 1, "w", 2)]):
        path = scratch(spark, "vectors")
        spark.createDataFrame(rows, VECTORS).write.parquet(f"{path}/embeddings.parquet")
        assert hard_negatives.query(spark, path).collect() == []


def test_lists_stop_early():
    """With one strong dimension the threshold ends the reading long before all is read."""
    rng = np.random.default_rng(6)
    x = np.column_stack([np.arange(5000), *rng.integers(-3, 4, (3, 5000))]).astype(np.int64)

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, at):
            Counted.read += len(at) if isinstance(at, np.ndarray) and at.ndim == 1 else 0
            return np.asarray(self)[at]

    lists = hard_negatives.Lists(x)
    lists.x = x.view(Counted)
    ids = np.arange(5000)
    ((at, score),) = lists.search(np.array([9, 1, 0, -1]), [(None, None)], 10, np.ones(5000, bool), [ids, ids])
    want = np.lexsort([ids, -(x @ np.array([9, 1, 0, -1]))])[:10]
    assert [hard_negatives.exact_kind(m, 64) for m in (256, 1 << 20, 1 << 24)] == [np.float32, np.float64, np.int64]
    assert at.tolist() == want.tolist() and Counted.read < 2500


# --- alignment -------------------------------------------------------------
def tokens(text):
    import sentencepiece
    from tokenizers import Tokenizer

    a_model, b_model = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_model.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    a = a_model.encode(" " + text, add_special_tokens=False).ids
    b = b_model.encode(text)
    of_a = [bytes(byte_of[c] for c in a_model.id_to_token(i)) for i in a]
    of_b = [bytes([i - b_model.piece_to_id("<0x00>")]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not text or b"".join(of_a) != (" " + text).encode() or b"".join(of_b) != (" " + text).encode():
        return [], [], [], []
    return a, b, np.cumsum([len(x) for x in of_a]).tolist(), np.cumsum([len(x) for x in of_b]).tolist()


def brute_alignment(rows):
    groups, held = {}, Counter()
    for place, (i, text) in enumerate(rows):
        a, b, ends_a, ends_b = tokens(text or "")
        cuts, of = sorted(set(ends_a) & set(ends_b)), []
        for lo, hi in zip([0, *cuts], cuts):
            of.append(([t for t, e in zip(a, ends_a) if lo < e <= hi], [t for t, e in zip(b, ends_b) if lo < e <= hi]))
        groups[place] = (i, len(a), len(b), of)
        held.update({p for x, y in of for p in product(x, y)})
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for i, na, nb, of in groups.values():
        links = [p for x, y in of for p in product(x, y)]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in of)
        sha = hashlib.sha256(text.encode()).hexdigest() if of else ""
        out.append((i, na, nb, len(of), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), sha))
    return sorted(out, key=lambda r: (r[0] is None, *r))


ODD = [
    "▁ literal", "</s><s> <|endoftext|> <unk> <0x41>", " lead", "trail ", "  two  spaces  ", "\t\n\r\x0b", "a" * 700, "😀👩‍👩‍👧 ﬁ ½ é",
    "ÿ\x00\x01", "日本語のテキスト 中文", "x=1;y=2;" * 40, "https://example.org/a?b=c&d=%20e", "don't we'll I'M", " nbsp　wide", "=" * 300,
]


@pytest.mark.parametrize("common", [200_000, 20])
def test_alignment(spark, rows, monkeypatch, common):
    """Also with few pairs broadcast, and large groups counted by distinct ids."""
    monkeypatch.setattr(alignment, "COMMON", common)
    monkeypatch.setattr(alignment, "EXPANDED", 256 if common > 20 else 2)
    pairs = [(r[0], r[1]) for r in rows if len(r[1] or "") < 5000] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(3, "one"), (None, "two words")]
    path = scratch(spark, "aligned-docs")
    spark.createDataFrame([(*p, "c", "p") for p in pairs], "doc_id bigint, text string, pairs string, _rid string").repartition(3).write.parquet(
        f"{path}/documents.parquet"
    )
    got = alignment.query(spark, path)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0] is None, *r)) == brute_alignment(pairs)


def test_alignment_of_nothing_and_groups(spark, none):
    assert alignment.agreement(none, BYTE_BPE, PIECES).collect() == []
    docs = spark.createDataFrame([(1, "one two")], "doc_id bigint, text string")
    row = alignment.aligned(docs, BYTE_BPE, PIECES).first()
    a, b, _, _ = tokens("one two")
    assert row.groups == ";".join(f"{x}|{y}" for x, y in zip(a, b)) and row.times == [1] * row.n_links


def test_long_text_is_aligned_in_one_piece():
    aligner = alignment.Aligner(BYTE_BPE, PIECES)
    text = "steady river stone " * 40_000 + "z" * 20_000
    ((na, nb, _, links, _, pairs, times),) = aligner([text])
    assert na > 100_000 and nb > 100_000 and times.sum() == links and len(pairs) < 2000


def test_oracle_of_hard_negatives(spark, sf_small):
    assert compare(hard_negatives.query(spark, sf_small), duckdb_connection(sf_small), hard_negatives.ORACLE) == []

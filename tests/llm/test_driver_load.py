"""Plans stay small where their stages would all be held by the driver at once."""

import random

from pitwall.llm import components, exact_dedup, packing
from pitwall.llm.common import row_id, save


def leaves(df):
    return df._jdf.queryExecution().optimizedPlan().collectLeaves().size()


def test_identities_are_one_stored_table_whatever_the_rounds(spark):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("ab") for _ in range(n)) for n in (0, 1, 3, 4, 5, 9, 17, 33, 70)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id bigint, text string")
    ids = exact_dedup.identities(rows.select(row_id(), "doc_id", "text"), block_bytes=4)
    plan = ids._jdf.queryExecution().optimizedPlan().toString()
    assert leaves(ids) == 1 and "Window" not in plan and "Join" not in plan
    found = {}
    for r in ids.collect():
        found.setdefault((r["_round"], r["_name"]), set()).add(r["doc_id"])
    n = len(texts)
    assert sorted(map(sorted, found.values())) == [[i, i + n, i + 2 * n] for i in range(n)]
    assert len({r for r, _ in found}) > 4


def test_a_component_step_reads_its_edges_a_few_times(spark):
    rnd = random.Random(5)
    pairs = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(330)] + [(i, i + 1) for i in range(1000, 1040)]
    edges = save(spark.createDataFrame(pairs, "u bigint, v bigint"), "test-edges")
    assert leaves(components._star(components._star(edges, True), False)) <= 4
    root = {x: x for p in pairs for x in p}
    for _ in root:
        for u, v in pairs:
            root[u] = root[v] = min(root[u], root[v])
    found = {r["u"]: r["root"] for r in components.components(edges).collect()}
    assert found == {x: r for x, r in root.items() if x != r}


def test_triples_are_the_combinations_of_three():
    rnd = random.Random(6)
    for window in (7, 60, 128):
        lengths = set(rnd.sample(range(1, window), window // 2))
        expected = [c for c in packing.combinations(lengths, window) if len(c) == 3]
        assert [tuple(t) for t in packing.triples(lengths, window).tolist()] == expected

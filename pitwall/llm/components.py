"""Connected components of a stored edge list, without driver-side state.

Alternating large-star and small-star steps (minimum aggregates joined back to
the edges, so a hub's edges never meet in one task) until the edges are stars:
every node but the centres hangs on one node, and that is a centre. As edges
point to the lesser node, the centre is the least node of its component. Both ways of
an edge are made from one reading of it, so a step has few stages for the driver to keep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import drop, save


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select("u", "v").where("u <> v")
    low, high = F.least("u", "v"), F.greatest("u", "v")
    if large:
        around, near = _each(both, ["u", "v"], ["v", "u"]), both.select(low.alias("u"), high.alias("v"))
    else:
        around = near = both.select(high.alias("u"), low.alias("v"))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = near.join(least, "u")
    out = _each(out, ["v", "m"]) if large else _each(out, ["v", "m"], ["u", "m"])
    return out.where("u <> v").distinct()


def _each(rows: DataFrame, *pairs: list[str]) -> DataFrame:
    """u, v: each of ``pairs`` of columns, for each row."""
    made = [F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs]
    return rows.select(F.explode(F.array(*made)).alias("e")).select("e.u", "e.v")


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every node of ``edges`` (u, v: long) that is not itself the
    smallest of its component. Self edges and repeated edges do not matter."""
    now = save(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    while not _stars(now):
        last, now = now, save(_star(_star(now, True), False), "edges")
        drop(last)
    return now.select("u", F.col("v").alias("root"))


def _stars(edges: DataFrame) -> bool:
    """Whether no node hangs on two nodes, or hangs on one and carries another."""
    ends = [F.struct(F.col(c).alias("u"), F.lit(up).alias("up"), F.lit(1 - up).alias("down")) for c, up in (("u", 1), ("v", 0))]
    ends = edges.select(F.explode(F.array(*ends)).alias("e")).select("e.*")
    node = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return node.where("up > 1 or (up = 1 and down = 1)").isEmpty()

"""Connected components by distributed union-find with large and small stars.

Every round hangs the larger neighbours of each node, and then the smaller ones, on
the smallest node around it, until nothing changes; each component is then a star around
its smallest node. Minima are aggregated before they are shuffled and joined back. Each round ends in a table in the shared folder. The minima of a round are
broadcast where the round has at most BROADCAST_EDGES edges, counted before. Otherwise they are joined by a shuffle, but for those of
nodes with HUB_EDGES neighbours or more, of which there are at most two for HUB_EDGES edges: they are broadcast, so a node with very many
neighbours is not gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

MAX_ROUNDS = 100
#: Edges (16 bytes each, and no more minima than twice as many) up to which a round's minima are broadcast.
BROADCAST_EDGES = 200_000
#: Neighbours from which on a node's minimum is broadcast in larger rounds, too.
HUB_EDGES = 1_000_000
#: Edges in one file of a round's table.
FILE_EDGES = 100_000
#: Edges (16 bytes each) up to which a round is one task without a shuffle; dealing so few out costs more than the round.
TASK_EDGES = 50_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _with_least(edges: DataFrame, least: DataFrame, small: bool) -> DataFrame:
    """``edges`` with the least neighbour m of their node u; least: (u, m, n), n being the node's neighbours."""
    if small:
        return edges.join(F.broadcast(least.drop("n")), "u")
    hubs = F.broadcast(least.filter(F.col("n") >= HUB_EDGES).drop("n"))
    return edges.join(hubs, "u").unionByName(edges.join(hubs, "u", "left_anti").join(least.drop("n"), "u"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges`` but the roots themselves: root is the smallest node that can be
    reached. Edges may repeat, go either way or lead from a node to itself; those with a null end are ignored."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
    e = cut(e.distinct(), "edges")
    state = _state(e)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        small = state[0] <= BROADCAST_EDGES
        near = (lambda df: df.coalesce(1)) if state[0] <= TASK_EDGES else (lambda df: df)
        both = near(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = _with_least(both.filter("v > u"), least, small).select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        hung = _with_least(large, least, small).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        hung = near(hung).distinct()
        e = cut(hung.coalesce(1 + state[0] // FILE_EDGES), "edges")  # a round never has more edges than the one before
        state, before = _state(e), state
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))

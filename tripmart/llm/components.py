"""Connected components of an edge table.

Every edge points from its larger to its smaller end.  In each round a node's smaller
neighbours are tied to the smallest of them, and every edge then jumps on to what its
end points to, so paths halve while stars stay; rounds grow with the logarithm of the
longest path.  A node that very many edges point to is no hot spot: its edges are keyed
by their other ends, and the jump is a plain join that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tripmart.llm.common import held

#: Edges of one partition of what is kept between rounds.
PART_EDGES = 250_000


def _kept(edges: DataFrame, n: int | None = None) -> tuple[DataFrame, tuple]:
    """The edges in the shared folder, with their number and an order-free digest."""
    if n is not None:
        edges = edges.coalesce(max(8, -(-n // PART_EDGES)))
    edges = held(edges)
    return edges, tuple(edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) with the smallest node of its component, for every node of ``edges(a, b)``.

    ``a`` and ``b`` may be of any orderable type; edges may repeat and have either
    direction; loops and edges with a null end are ignored.
    """
    edges, state = _kept(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    own = Window.partitionBy("a")
    while state[0]:
        least = edges.withColumn("m", F.min("b").over(own))
        tied = least.select("a", F.col("m").alias("b")).unionByName(
            least.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).repartition("a").distinct()  # one shuffle for this and the parents below
        parents = tied.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("parent"))
        jumped = tied.join(parents, "b", "left").select("a", F.coalesce("parent", "b").alias("b"))
        before = state
        edges, state = _kept(jumped, before[0])
        if state == before:
            break
    # now every node points to its root alone, and no root points anywhere
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).distinct().unionByName(roots)

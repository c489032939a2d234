"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); component is the least node.

    Each round moves every node's larger neighbours to its least neighbour, then links its
    smaller ones to the least of them; the rounds needed grow with the logarithm of the
    number of nodes. Only minima are gathered per node, so a node of very many edges is
    aggregated before it is shuffled, and the joins back are with written tables, so that
    both sides are shuffled and a hot node's rows can be split."""
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges")
    # Edges that a round doesn't move keep their number and their sum of hashes.
    state = [F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))]
    before = edges.agg(*state).first()
    while before[0]:
        # Large star: u's neighbours above u go to the least of all neighbours and u.
        both = edges.select(F.col("v").alias("n"), F.col("u").alias("o")).unionAll(edges.select(F.col("u").alias("n"), F.col("v").alias("o")))
        least = written(both.groupBy("n").agg(F.least(F.min("o"), F.col("n")).alias("m")), "least")
        large = written(both.where("o > n").join(least, "n").select(F.col("o").alias("v"), F.col("m").alias("u")).distinct(), "large-star")
        # Small star: the neighbours below v, and v, go to the least of them.
        least = written(large.groupBy("v").agg(F.min("u").alias("m")), "least")
        edges = written(large.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v <> u")
                        .unionAll(least.select("v", F.col("m").alias("u"))).distinct(), "small-star")
        after = edges.agg(*state).first()
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return nodes.unionAll(edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())

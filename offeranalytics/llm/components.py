"""Connected components of an edge table by alternating large and small stars."""

from pyspark.sql import DataFrame, functions as F

from .common import cut


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (a, b), root being the smallest node it is linked with.

    Each round points every neighbour of a node that is larger than the node to the smallest neighbour (large
    star), then the smaller ones too (small star). Edges never outnumber the input's. Joins meet rows of one node
    with one row, so the run-time skew split can cut a node with very many edges. Self loops are ignored.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    for _ in range(max_rounds):
        around = _both_ways(edges)
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        large = cut(around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = cut(small.where("a <> b").distinct())
        before, state = state, _state(edges)
        if before == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

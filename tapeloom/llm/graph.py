"""Connected components of an edge table, by alternating stars, with a written table a round."""

from pyspark.sql import functions as F

from tapeloom.settings import scratch_dir

ROUNDS = 100  # the logarithm of the longest chain, with room to spare


def _large_star(edges):
    """Every neighbour larger than a node is tied to the smallest node the node can see."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges):
    """Every node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a")
    return (
        tied.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        .unionByName(least.select("a", F.col("m").alias("b")))
    )


def components(spark, edges):
    """(node, root) of every node of ``edges`` (a, b); root is the smallest node it can reach.

    Raises if ``ROUNDS`` do not settle it. Rounds grow with the logarithm of the longest chain. Each is written to the shared folder, so
    lineage stays short and a lost executor costs one round. Nothing of the graph is collected but
    three sums a round. Loops and repeated edges do no harm; edges with a null end are left out.
    """
    folder = scratch_dir(spark, "components")
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    now = edges.where("a <> b").select(larger.alias("a"), smaller.alias("b")).distinct()
    before = None
    for turn in range(ROUNDS):
        now = _small_star(now if turn == 0 else _large_star(now).where("a <> b").distinct()).distinct()
        now.write.parquet(f"{folder}/{turn}")
        now = spark.read.schema("a long, b long").parquet(f"{folder}/{turn}")
        sums = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))
        ).first()
        if sums == before:
            break
        before = sums
    else:
        raise ArithmeticError(f"components have not settled after {ROUNDS} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)

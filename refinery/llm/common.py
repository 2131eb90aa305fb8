"""Shared helpers: written intermediate tables and connected components over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from refinery.session import scratch_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back.

    This cuts the lineage: an executor that is lost later costs no more than
    the stages that read the table.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Smallest node id reachable from every node that has an edge.

    ``edges`` has the long columns ``src`` and ``dst`` (any direction, repeats
    and self-loops allowed, nulls ignored).  Returns ``node``, ``root``.

    Each round hooks every node to its smallest neighbour, follows the hooks
    twice, and contracts the edges to the nodes they lead to; the edge table
    shrinks until it is empty.  Every table of a round is written, so each join
    is between two tables of known size: small ones are broadcast by Spark under
    its own threshold, and in large ones a hot node is split by the skew join.
    Only the number of edges left reaches the driver.
    """
    e = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull()).select("src", "dst")
    both = e.union(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    labels = written(both.groupBy(F.col("src").alias("node")).agg(F.min("src").alias("root")), f"{name}-labels")
    live = written(both.where("src <> dst").distinct(), f"{name}-edges")
    while not live.isEmpty():
        hook = written(live.groupBy(F.col("src").alias("node"))
                       .agg(F.least(F.min("dst"), F.min("src")).alias("up")), f"{name}-hook")
        for _ in range(2):
            top = hook.select(F.col("node").alias("_n"), F.col("up").alias("_u"))
            hook = written(hook.join(top, hook["up"] == top["_n"]).select("node", F.col("_u").alias("up")),
                           f"{name}-jump")
        labels = written(labels.join(hook, labels["root"] == hook["node"], "left")
                         .select(labels["node"], F.coalesce(hook["up"], labels["root"]).alias("root")),
                         f"{name}-labels")
        a = hook.select(F.col("node").alias("src"), F.col("up").alias("a"))
        b = hook.select(F.col("node").alias("dst"), F.col("up").alias("b"))
        live = written(live.join(a, "src").join(b, "dst").where("a <> b")
                       .select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct(), f"{name}-edges")
    return labels

"""Connected components of links, as Spark jobs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.plans.workspace import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of `links` (a, b); the component is its smallest node.

    Alternates the two star operations: every node hands its larger neighbours to its smallest
    one, then its smaller ones, until every node hangs on a root. Each step is one aggregation and one join, is
    written to the shared folder, and never gathers the neighbours of a node. Null ends are left out.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .distinct(),
        "components",
    )
    while True:
        edges = stored(_star(_star(edges, both=True), both=False), "components")
        ends = edges.selectExpr("a AS node", "1 AS up", "0 AS down").union(edges.selectExpr("b", "0", "1"))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.where("up > 1 OR up = 1 AND down = 1").isEmpty():
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct()
    )


def joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """`found` (node, component), as `components` returns it, after more links (a, b).

    Only components that the new links tie together are worked on, each as one node.
    """
    named = found.toDF("node", "own")
    for end in ("a", "b"):
        own = F.coalesce("own", end).alias(end)
        links = links.join(named.hint("merge"), F.col(end) == F.col("node"), "left").select(own, "b" if end == "a" else "a")
    names = stored(components(links), "components")
    moved = found.join(names.toDF("component", "now").hint("merge"), "component", "left")
    moved = moved.select("node", F.coalesce("now", "component").alias("component"))
    return moved.union(names.join(found.hint("merge"), "node", "left_anti"))


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Edges (a > b) after one star step; `both`: over all neighbours, else over the smaller ones."""
    ways = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both:
        ways = ways.union(edges.select(F.col("b"), F.col("a")))
    least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = ways.join(least.hint("merge"), "u")  # broadcast, the tables of all steps would pile up in the driver
    if both:
        moved = moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return moved.where("a <> b").distinct()

"""Connected components of a table of links, by joins that a hub does not skew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import save


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and is no edge's smaller end."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    per = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per.where("up > 1 or up = 1 and down = 1").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60, alone: bool = True) -> DataFrame:
    """(id, component) for every id in links (a, b); component is the smallest id reachable.

    alone: ids that are only linked to themselves are wanted too; false spares a join. Links with a null tie nothing. Until the links are stars around the smallest ids, every node
    links its larger neighbours to its smallest one, then its smaller ones likewise (large star, small star). In the first
    step a node may have very many links: its minimum is pre-aggregated and its join can be split. In the second
    a node has as many links as it had minima, and both uses share one exchange.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    edges = save(links.where(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct(), "edges")
    for _ in range(most_rounds):
        if _stars(edges):
            found = edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
            if not alone:
                return found
            lone = links.where(F.col(a) == F.col(b)).select(F.col(a).alias("id")).distinct().join(found, "id", "left_anti")
            return found.union(lone.select("id", "id"))
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        star = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).repartition("u")
        least = star.groupBy("u").agg(F.min("v").alias("m"))
        joined = star.join(least, "u")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        edges = save(small.distinct(), "edges")
    raise RuntimeError(f"components have not settled after {most_rounds} rounds")

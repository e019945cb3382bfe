"""Connected components of links between long ids, by alternating large and small stars.

Each round is two joins whose sides have one row for each link; what is known of a node's smallest neighbour comes
from partial aggregation, so a node with very many links is no hot task. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from inplay.llm.common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step on links (a, b) with a > b, which are distinct; so are the links it returns."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    met = both.join(least, "a")
    moved = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), "m") if large else met.select(F.col("b").alias("a"), "m")
    own = least.where("a > m").select("a", "m")
    return moved.where("a > m").unionByName(own).distinct().select("a", F.col("m").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least id of the component for every node that ``links`` (a, b) name; null ends are no links."""
    rows = (links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    rows, last = stored(rows, "links"), None
    while True:
        state = rows.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == last or not state[0]:
            break
        last = state
        rows = stored(_star(stored(_star(rows, True), "star"), False), "star")
    return rows.select(F.col("a").alias("node"), F.col("b").alias("component")).union(rows.select("b", "b").distinct())

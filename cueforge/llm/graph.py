"""Connected components of a link table, without collecting links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueforge.llm.store import Store


def components(edges: DataFrame, store: Store, name: str) -> DataFrame:
    """(node, label): label is the smallest node that links reach.

    edges has columns a and b. Alternates two contractions: each node's larger neighbours, then its smaller ones,
    are linked to the smallest node around it. The rounds grow with the logarithm of a component's size; every
    step is a grouped minimum and a join on it, so a node with very many links isn't gathered in one place.
    Each round is a written table. Null nodes and links from a node to itself are ignored; an empty table gives none.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    links, seen, turn = store.save(links, f"{name}0"), None, 0
    while True:
        both = links.union(links.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(low, "a")
        small = tied.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).where("a > b")
        small = small.union(low.select("a", F.col("m").alias("b"))).distinct()
        turn += 1
        links = store.save(small, f"{name}{turn}")
        now = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == seen:
            break
        seen = now
        store.drop(f"{name}{turn - 1}")
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).union(links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())

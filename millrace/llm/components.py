"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import kept_in_files


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``links(a, b)`` of longs to ``(node, root)``, the root being the smallest node.

    Alternates two steps until nothing changes: every node hands its larger
    neighbours its smallest one, then every node hands its smaller neighbours
    their smallest one. Links never grow in number, each round roughly halves
    the depth, and every round is written to files. Minima are pre-aggregated and
    written, so that both sides of their joins are shuffled for these, and a node
    with very many neighbours can be split. Roots have no row of their own; an
    empty table gives none.
    """
    now = kept_in_files(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        name,
    )
    state = None
    while True:
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state or not new[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = new
        both = now.union(now.select("b", "a"))
        least = kept_in_files(both.groupBy("a").agg(F.min("b").alias("m")), name)
        large = (
            both.where("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        # Nodes without a larger neighbour only occur on the left; all links stay.
        large = kept_in_files(large, name)
        least = kept_in_files(large.groupBy("a").agg(F.min("b").alias("m")), name)
        small = large.join(least, "a").select("a", "b", "m")
        now = kept_in_files(
            small.select("b", "m").where("b <> m").union(least.select("a", "m")).toDF("a", "b").distinct(),
            name,
        )

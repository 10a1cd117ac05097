"""Connected components of a table of links, by alternating stars.

Both steps are joins with a grouped minimum, so no vertex's neighbours are
ever gathered in one place; a vertex with very many links is a skewed join
key, which Spark splits.  Each round is written to the shared folder, which
cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mound.session import write_through


def _large_star(edges: DataFrame) -> DataFrame:
    """Each vertex hands its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
    least = least.groupBy(F.col("x").alias("u")).agg(F.least(F.min("y"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each vertex hands its smaller neighbours, and itself, to the smallest of them.  Edges point from larger to smaller."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    kept = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(vertex, root) for every vertex of ``links`` (two columns u, v of one orderable type).

    ``root`` is the smallest vertex of the component.  Links may repeat, in
    either direction; links of a vertex with itself and with null are ignored.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    mark = None
    while True:
        edges = write_through(edges, name)
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
        if tuple(found) == mark:
            break
        mark = tuple(found)
        large = _large_star(edges).distinct()
        edges = _small_star(large).distinct()
    roots = edges.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct())

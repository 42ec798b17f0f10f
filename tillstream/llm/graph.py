"""Connected components of links between integer ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.llm.tables import stored


def _hang_on_minimum(edges: DataFrame, keep_root: bool) -> DataFrame:
    """Join each vertex's neighbours to their minimum, `edges` having every link under its vertex `a`.

    The minimum combines map-side and goes back by a join, so the neighbours of a vertex never meet in one task.
    """
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    joined = edges.join(least, "a")
    out = joined.select(F.col("b").alias("a"), F.col("root").alias("b"))
    return out.union(least.select("a", F.col("root").alias("b"))) if keep_root else out


def components(links: DataFrame) -> DataFrame:
    """`id, component` for every id in `links` (two bigint columns): the smallest id reachable.

    Each round hangs larger neighbours on the least neighbour (large star), then does so among the smaller ones (small
    star), until every vertex hangs on its root (Kiveris et al., 2014: few rounds). A round's links are written to the
    shared folder. No links: no rows.
    """
    a, b = links.columns
    flat = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    edges = stored(flat, "links")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _hang_on_minimum(both, keep_root=True).filter("a > b").distinct()
        small = _hang_on_minimum(large, keep_root=True).filter("a > b").distinct()
        after = stored(small, "links")
        # Stars only: no vertex has two parents, and no parent has a parent.
        several = after.groupBy("a").count().filter("count > 1").select("a").limit(1)
        nested = after.join(after.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a").limit(1)
        edges = after
        if several.union(nested).isEmpty():
            break
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )

"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.frames import stored

ROWS_PER_TASK = 200_000  # rows of links or vertices a task writes; a few megabytes


def components(links: DataFrame) -> DataFrame:
    """``v, root`` for every vertex of ``links(a, b)``: the smallest vertex that links lead to.

    Every vertex points at a smaller or equal one. A round lets each vertex take the smallest pointer among its neighbours and then
    follow pointers twice; rounds end when no pointer changed. Only aggregates and joins, written out after each round, in
    as many parts as the counted links need.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct(), "links")
    parts = both.count() // ROWS_PER_TASK + 1

    def written(df: DataFrame) -> DataFrame:
        # Fewer writers, no shuffle: small tables are not spread over as many files as large ones.
        return stored(df.coalesce(parts), "roots")

    both = written(both)
    roots = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "v"))
    while True:
        near = both.join(roots.withColumnRenamed("v", "b"), "b").groupBy("a").agg(F.min("root").alias("near"))
        hooked = roots.join(near.withColumnRenamed("a", "v"), "v").select("v", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        # The vertex pointed at so far learns of the smaller one too.
        pushed = hooked.groupBy(F.col("was").alias("v")).agg(F.min("root").alias("push"))
        merged = written(hooked.join(pushed, "v", "left").select("v", "was", F.least("root", F.coalesce("push", "root")).alias("root")))
        above = merged.select(F.col("v").alias("root"), F.col("root").alias("up"))
        jumped = written(merged.join(above, "root", "left").select("v", "was", F.least("root", F.coalesce("up", "root")).alias("root")))
        changed = jumped.where("was != root").limit(1).count()
        roots = jumped.select("v", "root")
        if not changed:
            return roots

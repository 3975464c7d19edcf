"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.staging import drop_path, hand_over, new_path


def connected_components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) of every node that has a link; ``links`` has long columns ``a`` and ``b``.

    Alternates two steps until nothing changes: each node links its larger neighbours to
    the smallest node it knows, then its smaller ones. The smallest known node is a partial
    aggregate and goes back by a join, so no task holds the neighbours of one node. Each
    round is written to the shared folder; the driver only sees a count and a sum.
    """
    spark = links.sparkSession

    def written(frame: DataFrame) -> tuple[DataFrame, str]:
        path = new_path(spark, "links")
        frame.write.parquet(path)
        return spark.read.schema("a long, b long").parquet(path), path

    edges, path = written(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = None
    for _ in range(rounds):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.filter("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        end = F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
        small = large.join(low, "a").select(end.alias("a"), F.col("m").alias("b")).distinct()
        edges, new = written(small)
        drop_path(spark, path)
        path = new
        place = F.xxhash64("a", "b").cast("decimal(38,0)")
        state = edges.agg(F.count(F.lit(1)), F.sum(place)).first()
        if state == before:
            hand_over(path)
            root = F.col("b")
            return edges.select(F.col("a").alias("node"), root.alias("root")).unionAll(
                edges.select(root.alias("node"), root.alias("root")).distinct()
            )
        before = state
    raise RuntimeError(f"no fixed point after {rounds} rounds")

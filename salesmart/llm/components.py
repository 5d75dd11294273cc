"""Connected components of a link table by alternating large and small stars.

Each step maps every node to the least node it knows, so a star-shaped graph
settles in two or three rounds and any graph in about the logarithm of its
size. A step is one aggregate and one equi-join; every round is written to the
shared folder, which cuts the lineage. Links and labels never reach the driver;
a round's row count and checksum do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.session import scratch_uri

SCHEMA = "a long, b long"


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return linked.unionByName(own).where("a != b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a long, b long)``; root is the least node reachable.

    Self links and repeated links change nothing; rows with a null end are
    ignored; an empty table gives an empty result.
    """
    spark = links.sparkSession
    current = links.where("a is not null and b is not null and a != b").select("a", "b")
    before = None
    while True:
        path = scratch_uri(spark, "components")
        step = current if before is None else _small_star(_large_star(current))
        step.write.parquet(path)
        current = spark.read.schema(SCHEMA).parquet(path)
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if before is not None and tuple(state) == before:
            break
        before = tuple(state)
    children = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return children.unionByName(roots)

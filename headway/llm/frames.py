"""Small helpers around DataFrames: written intermediates and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.session import configure, work_dir


#: Bytes of one Arrow batch between Spark and Python: bounds memory for any length of text.
BATCH_BYTES = 8 << 20


def text_session(spark: SparkSession) -> SparkSession:
    """The session's settings for long texts, besides the library's."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return configure(spark)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and survives lost executors."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """The least node that each node of ``edges`` (u, v: long) can reach: (node, root).

    Every round hangs each node's neighbours, and the node itself, below the least
    of them, first all larger neighbours and then all smaller ones; the number of
    edges never grows and stars remain after a number of rounds that is logarithmic
    in the longest path.  The least neighbour is an aggregate with partial sums, so
    that a node with very many links is no task's group; rounds are written tables.
    """
    ends = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    links = written(ends, "links")
    for _ in range(most_rounds):
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small, "u")
        nexts = (hung.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(small.select("u", F.col("m").alias("v"))).distinct())
        nexts = written(nexts, "links")
        # Stars: no node is both a root and a member.
        if nexts.join(nexts.select(F.col("v").alias("u")), "u", "left_semi").isEmpty() and \
                nexts.groupBy("u").count().filter("count > 1").isEmpty():
            links = nexts
            break
        links = nexts
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)

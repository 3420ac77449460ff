"""What several operators share: tables in the scratch folder, components, sizes."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.sources.scratch import remember, scratch_folder

# Rows of two integers that may be broadcast (about 50 MB once hashed).
BROADCAST_ROWS = 400_000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SPACES = "[\\x20\\x09-\\x0D]+"


def by_value(module_name: str) -> None:
    """Ship a module's task-side functions with the job: executors need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


class Scratch:
    """Tables of one run in the folder all executors share.

    A table is read by later passes instead of being computed again, so a lost
    executor costs a retry of tasks only. ``drop`` removes what is no longer read,
    ``scratch.release`` all that the session has written.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{scratch_folder(spark)}/rollcall/{name}-{uuid.uuid4().hex}"
        remember(spark, self.root)
        self.count = 0
        # Texts can be long: unless the session says otherwise, fewer rows go to Python at once.
        if spark.conf.get(ARROW_ROWS) == "10000":
            spark.conf.set(ARROW_ROWS, "2000")

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete the tables with these names."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        root = hadoop.Path(self.root)
        system = root.getFileSystem(conf)
        if system.exists(root):
            for entry in system.listStatus(root):
                path = entry.getPath()
                if path.getName()[4:] in names:
                    system.delete(path, True)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a written table has at most ``limit`` rows (read from its file footers)."""
    return df.count() <= limit


def joined_small(left: DataFrame, right: DataFrame, on: str | list[str], how: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join a written table, broadcast when its counted size is within the limit."""
    return left.join(F.broadcast(right) if small(right, limit) else right, on, how)


def crc_part(key: str, parts: int) -> Column:
    """crc32 of the key's text, modulo ``parts``; NULL keys count as ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % parts


def components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over ``edges``.

    Alternates large-star and small-star steps; each is an aggregate and a join
    on node keys, so hub nodes are pre-aggregated before the shuffle and may be
    split by the skew-join rule. Nodes without edges are not returned.
    """
    pair = lambda x, y: (F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
    now = edges.where(F.col(a) != F.col(b)).select(*pair(F.col(a), F.col(b))).distinct()
    now = scratch.save(now, "edges")
    # A round leaves the stars alone when nothing is left to do, so equal tables end it.
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        step = joined.select(*pair(F.col("v"), F.col("m"))).union(least.select("u", F.col("m").alias("v")))
        new = scratch.save(step.where(F.col("u") != F.col("v")).distinct(), "edges")
        # Done when every node has one edge and no smaller end has an edge of its own.
        heads = new.select(F.col("u").alias("h")).distinct()
        open_chains = new.join(heads, F.col("v") == F.col("h"), "left_semi").limit(1).count()
        many = new.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
        now = new
        if not open_chains and not many:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )

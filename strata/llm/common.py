"""Helpers shared by the corpus operators: shared-folder cuts, text columns, components."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.workspace import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the session's shared checkpoint folder and read it back.

    Every later read, also one after the loss of an executor, starts from the files.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def use_package(spark: SparkSession) -> None:
    """Let Python workers look for this package also where the driver found it.

    Their functions are imported, not copied. On a cluster the package is installed on all
    machines or sent along with the job; this helps where only the driver's search path was set.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also change other letters)."""
    return F.translate(text, UPPER, UPPER.lower())


def text_id(text: Column) -> Column:
    """Hash that tells apart texts of rows with the same (or no) document id."""
    return F.xxhash64(text)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of undirected links ``(a, b)`` between longs: ``(node, label)``.

    The label is the smallest node of the component; nodes without a link are not listed.
    Each round hooks every node to its smallest neighbour, follows the hooks to their ends
    by doubling, and contracts the links to those ends. At least half of the linked nodes
    vanish per round, so the number of rounds is logarithmic. Only counts reach the driver;
    every round is cut in the shared folder.
    """
    links = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), name)
    labels = None
    while not links.isEmpty():
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("p")), name)
        while True:
            ends = hooks.select(F.col("a").alias("q"), F.col("p").alias("r"))
            jumped = cut(hooks.join(ends, hooks.p == ends.q).select("a", F.col("r").alias("p"), (F.col("p") != F.col("r")).alias("moved")), name)
            hooks = jumped.select("a", "p")
            if jumped.filter("moved").isEmpty():
                break
        step = hooks.withColumnsRenamed({"a": "s", "p": "t"})
        if labels is None:
            labels = hooks.select(F.col("a").alias("node"), F.col("p").alias("label"))
        else:
            labels = cut(labels.join(step, labels.label == step.s, "left").select("node", F.coalesce("t", "label").alias("label")), name)
        one = links.join(step, links.a == step.s).select(F.col("t").alias("a"), "b")
        two = one.join(step, one.b == step.s).select("a", F.col("t").alias("b"))
        links = cut(two.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), name)
    if labels is None:
        labels = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels

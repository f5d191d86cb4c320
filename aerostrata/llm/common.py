"""Helpers that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.session import run_path

# White space of the word rules: space and the five ASCII controls from tab to carriage return.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
NON_WORD_ONLY = r"^[\x20\x09-\x0D]*$"
A_Z, LOWER_A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: lineage ends here, and a lost
    executor costs only the tasks that were running on it."""
    path = run_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name: str, columns: list[str]) -> str:
    """The name, with underscores before it until no given column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ascii_lower(text: Column) -> Column:
    return F.translate(text, A_Z, LOWER_A_Z)


def _star(edges: DataFrame, name: str) -> DataFrame:
    """One round: every node's larger neighbours, and the node itself, point to its smallest one."""
    both = stored(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), f"{name}-both")
    low = stored(both.groupBy("u").agg(F.min("v").alias("m"))
                 .select("u", F.least("u", "m").alias("m")), f"{name}-low")
    joined = both.join(low, "u")
    return (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .distinct())


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of the undirected edges (u, v): rows (node, root) for each node that
    has an edge, root being the smallest node reachable.

    Rounds of star contraction: each node's neighbours are hung onto the smallest of them, which
    shortens every chain by a constant factor, until the edges form stars. Nothing but one count
    and one checksum per round reaches the driver; a node with very many edges is joined by a
    plain shuffled join of two stored tables, which adaptive execution can split.
    """
    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = stored(edges, f"{name}-edges")
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
        edges = stored(_star(edges, name), f"{name}-edges")

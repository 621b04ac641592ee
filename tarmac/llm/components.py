"""Connected components of an edge table, by alternating star contraction (Kiveris et al., "Connected Components in
MapReduce and Beyond").

Every round is two joins and two pre-aggregated minima over all tasks; a node
with very many neighbours is combined before the shuffle, and its rows in the
join may be split.  Partitions that hold few edges share a task, about
``TASK_EDGES`` in each, so small graphs take few tasks a round.  Rounds grow
with the logarithm of the graph's size.  Each round is a table on the shared
folder, and nothing but two counts and one edge per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import dealt_anew, remove, run_folder, write_table

TASK_EDGES, LEAST_TASKS = 1 << 14, 12  # edges of a task; tasks of any round, as far as there are partitions


def connected_components(edges: DataFrame, folder: str | None = None) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: bigint): the smallest node reachable.  The result reads a
    table in ``folder``, a new one if none is given.

    Loops, repeated edges and edges with a null end are ignored; a node without
    a proper edge has no row.
    """
    spark = edges.sparkSession
    larger, smaller = F.greatest("u", "v"), F.least("u", "v")
    proper = edges.filter((F.col("u") != F.col("v")) & F.col("u").isNotNull() & F.col("v").isNotNull())
    folder = folder or run_folder(spark, "components")
    stars = write_table(proper.select(larger.alias("u"), smaller.alias("v")).distinct(), f"{folder}/0")
    rounds = 0
    while True:
        done, n = _are_stars(stars)
        if done:
            break
        rounds += 1
        tasks = max(LEAST_TASKS, -(-n // TASK_EDGES))
        nxt = write_table(_small_star(_large_star(stars, tasks), tasks), f"{folder}/{rounds}")
        remove(spark, f"{folder}/{rounds - 1}")
        stars = nxt
    roots = stars.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _are_stars(edges: DataFrame) -> tuple[bool, int]:
    """Whether every node has one smaller neighbour at most, and none that has one itself; and the number of edges."""
    n, nodes = edges.agg(F.count(F.lit(1)), F.countDistinct("u")).first()
    if n != nodes:
        return False, n
    chained = edges.select("v").join(edges.select(F.col("u").alias("v")), "v", "left_semi")
    return not chained.take(1), n


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Tie every node's larger neighbours to the smallest node it sees, itself included (edges run from the larger to
    the smaller node)."""
    both = edges.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(
        edges.select(F.col("v").alias("a"), F.col("u").alias("b"))
    )
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = dealt_anew(least.coalesce(tasks), "a")
    return edges.join(least, edges["v"] == least["a"]).select("u", F.col("m").alias("v")).coalesce(tasks)


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Tie every node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
    others = edges.join(dealt_anew(least, "u"), "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.coalesce(tasks).unionByName(least.select("u", F.col("m").alias("v"))).distinct().coalesce(tasks)

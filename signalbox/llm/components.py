"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbox.llm.common import landed


def _ordered(edges: DataFrame, u: str, v: str) -> DataFrame:
    """Distinct (u, v) with u >= v."""
    return edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()


def _nearest(edges: DataFrame, salt: int) -> DataFrame:
    """node, rep: of every node and its neighbours, the first in the order that ``salt`` gives."""
    place = F.col("v").bitwiseXOR(F.lit(salt))
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min(place).alias("low"))
    first = F.least("low", F.col("u").bitwiseXOR(F.lit(salt))).bitwiseXOR(F.lit(salt))
    return low.select(F.col("u").alias("node"), first.alias("rep"))


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node it is connected to) for every node of edges (u, v).

    Each round replaces every node by the first of itself and its neighbours,
    in an order that a salt changes from round to round, and drops the edges
    that become loops, so the table shrinks quickly; the rounds end when no
    edge is left. The minima are combined before the shuffle, adaptive
    execution splits skewed keys of the joins, and the results of each round
    are written to the shared folder. Loops (u = u) give a node of its own;
    an empty table gives no rows.
    """
    edges = landed(_ordered(edges, "u", "v"), "edges")
    labels, level = None, 0
    while labels is None or not edges.isEmpty():
        salt = xxhash.xxh3_64_intdigest(b"components", seed=level) >> 1
        reps = landed(_nearest(edges, salt), "representatives")
        of_u = reps.select(F.col("node").alias("nu"), F.col("rep").alias("ru"))
        of_v = reps.select(F.col("node").alias("nv"), F.col("rep").alias("rv"))
        moved = edges.filter("u <> v").join(of_u, F.col("u") == F.col("nu")).join(of_v, F.col("v") == F.col("nv"))
        edges = landed(_ordered(moved.filter("ru <> rv"), "ru", "rv"), "edges")
        if labels is None:
            labels = reps.withColumnRenamed("rep", "label")
        else:
            # Written in each round, so that no plan grows with the number of rounds.
            labels = landed(labels.join(of_u, F.col("label") == F.col("nu"), "left").select(
                "node", F.coalesce("ru", "label").alias("label")), "labels")
        level += 1
    least = labels.groupBy(F.col("label").alias("rep")).agg(F.min("node").alias("least"))
    return labels.join(least, F.col("label") == F.col("rep")).select("node", F.col("least").alias("label"))

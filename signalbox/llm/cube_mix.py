"""Mixing sources to target weights by the cube method.

Every document of a source is taken ``target / source size`` times on average:
the whole part of that ratio always, the fraction as an inclusion probability.
The cube method turns the probabilities into zeros and ones while the token
total and the document total of the source stay balanced. The flight phase
moves the probabilities of three documents at a time along the null-space of
the two constraints, u = (s2 - s3, s3 - s1, s1 - s2), until one of them is 0
or 1; a fixed hash decides the direction, so reruns agree. It runs in bounded
blocks of a source; the at most two fractions that a block leaves go to the
next level, until one block per source remains, whose last fractions are
landed on the combination closest to the token total.

A document far larger than its source's others would stay a fraction to the
end and be rounded there, too late for the others to make up for it. Such
dominating documents are decided first, each with its probability by a fixed
hash unless only the other choice can still be made up for; their rounding is
then shifted onto the probabilities of the source's other documents, which
restores its token total before the flight (its document total follows).
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalbox.llm.common import col, landed, map_batches, sized_broadcast, unused_name, utf8

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
BLOCK_ROWS = 4096
EPS = 1e-9
# A document dominates its source above this share of its size and this many times the mean size
# of its documents, so a source has at most 1 / DOMINANT_SHARE of them.
DOMINANT_SHARE = 0.005
DOMINANT_TIMES = 10


def sizes(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, source and size: words of the whole text (null: 0)."""
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(
        *[col(c).alias(n) for c, n in zip(keep, names, strict=True)],
        col("source").cast("string").alias("source"), utf8("text").alias("text"),
    )
    schema = rows.drop("text").schema.add("size", "long")

    def run(batch: pa.RecordBatch) -> dict:
        out = {n: batch.column(n) for n in (*names, "source")}
        return out | {"size": [len(t.as_py().split()) for t in batch.column("text")]}

    return map_batches(rows, run, schema.simpleString()[7:-1]).toDF(*keep, "source", "size")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """source, source_size, target, ratio (target / source size; 0 for an empty source).

    Sources in order of code points (null last) weigh ``weights`` in turn and
    share ``share`` times all sizes; a target stops at ``MOST_COPIES`` times
    its source's size and the excess is shared anew by weight. That is one
    level L with target = min(cap, L * weight): sources ordered by cap /
    weight are capped from the front, and L follows from what is left. One
    row per source passes here, so the number of sources bounds it.
    """
    total = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = total.withColumn("place", F.row_number().over(by_name) - 1).withColumn("weight", weight).withColumn(
        "cap", F.col("source_size") * MOST_COPIES
    )
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    # If the first uncapped source is this one, the level is what the caps before it leave.
    level = (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum(
        "weight"
    ).over(onward)
    filled = ranked.withColumn("level", level)
    # The first source (in that order) whose cap is not below its level sets the level of all;
    # the levels of those after it are no higher.
    filled = filled.withColumn(
        "found", F.max(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level"))).over(everything)
    )
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("found") * F.col("weight"), F.col("cap").cast("double")))
    return filled.withColumn("target", target).select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("ratio"),
    )


def _unit(*key) -> float:
    return xxhash.xxh3_64_intdigest(repr(key).encode()) / 2.0**64


def flight(size: np.ndarray, prob: np.ndarray, key: tuple, seed: int) -> np.ndarray:
    """Move probabilities along the null-space until at most two are fractions.

    The sums of ``prob`` and of ``size * prob`` stay as they are.
    """
    prob = prob.astype(float).copy()
    free: list[int] = []
    for i in range(len(prob)):
        if not EPS < prob[i] < 1 - EPS:
            prob[i] = round(prob[i])
            continue
        free.append(i)
        if len(free) < 3:
            continue
        a, b, c = free
        u = (float(size[b] - size[c]), float(size[c] - size[a]), float(size[a] - size[b]))
        if not any(u):  # equal sizes: only the number is a constraint
            u = (1.0, -1.0, 0.0)
        up = min((1 - prob[j]) / v if v > 0 else prob[j] / -v for j, v in zip(free, u, strict=True) if v)
        down = min(prob[j] / v if v > 0 else (1 - prob[j]) / -v for j, v in zip(free, u, strict=True) if v)
        step = up if _unit(seed, key, i) < down / (up + down) else -down
        for j, v in zip(free, u, strict=True):
            prob[j] = min(1.0, max(0.0, prob[j] + step * v))
            if not EPS < prob[j] < 1 - EPS:
                prob[j] = round(prob[j])
        free = [j for j in free if EPS < prob[j] < 1 - EPS]
    return prob


def land(size: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """Zeros and ones for the few fractions left: the choice closest to their token total."""
    free = np.flatnonzero((prob > EPS) & (prob < 1 - EPS))
    due = float((size[free] * prob[free]).sum())
    best = min(
        itertools.product((0, 1), repeat=len(free)),
        key=lambda x: (abs(float(np.dot(size[free], x)) - due), abs(sum(x) - prob[free].sum()), x),
    )
    out = np.round(prob)
    out[free] = best
    return out


def decide(size: np.ndarray, prob: float, total: int, key: tuple, seed: int) -> np.ndarray:
    """Zeros and ones for dominating documents, largest first.

    ``total`` is the size of the whole source, of which ``prob`` is due. A
    choice after which the remaining documents cannot meet what is due is left
    for the other one where that comes closer.
    """
    due, left = prob * total, float(total)
    out = np.zeros(len(size))
    for i, s in enumerate(size):
        left -= s
        missed = [max(0.0, (due - s * x) - left, s * x - due) for x in (0, 1)]
        x = int(_unit(seed, key, "dominating", i) < prob)
        if missed[1 - x] < missed[x]:
            x = 1 - x
        out[i] = x
        due -= s * x
    return out


def _dominating_first(open_rows: DataFrame, keys: tuple[str, ...], seed: int) -> tuple[DataFrame, DataFrame]:
    """(dominating documents, decided; the others with their shifted probabilities), columns as given."""
    names = open_rows.columns
    mean = open_rows.groupBy(F.col("source").alias("m_source")).agg((F.sum("size") / F.count("*")).alias("mean_size"))
    rows = open_rows.join(sized_broadcast(landed(mean, "mean-sizes")), F.col("source").eqNullSafe(F.col("m_source")))
    heavy = (F.col("size") > F.col("source_size") * DOMINANT_SHARE) & (F.col("size") > F.col("mean_size") * DOMINANT_TIMES)

    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by([("size", "descending"), *[(k, "ascending") for k in keys]])
        key = (block["source"][0].as_py(),)
        prob = decide(block["size"].to_numpy(), block["prob"][0].as_py(), block["source_size"][0].as_py(), key, seed)
        return block.set_column(block.schema.get_field_index("prob"), "prob", pa.array(prob))

    few = rows.filter(heavy).select(*names)
    decided = landed(few.groupBy("source").applyInArrow(run, few.schema), "dominating")
    held = landed(
        decided.groupBy(F.col("source").alias("h_source")).agg(
            F.sum("size").alias("held_size"), F.sum(F.col("size") * F.col("prob")).alias("held_taken")
        ), "dominating-sizes",
    )
    due = F.col("prob") * F.col("source_size") - F.col("held_taken")
    others = F.col("source_size") - F.col("held_size")
    shifted = F.when(F.col("h_source_found").isNull() | (others <= 0), F.col("prob")).otherwise(
        F.least(F.greatest(due / others, F.lit(0.0)), F.lit(1.0))
    )
    rest = rows.filter(~heavy).join(
        sized_broadcast(held.withColumn("h_source_found", F.lit(True))), F.col("source").eqNullSafe(F.col("h_source")), "left"
    )
    return decided, rest.withColumn("prob", shifted).select(*names)


def take(sized: DataFrame, wanted: DataFrame, keys: tuple[str, ...] = ("doc_id",), block_rows: int = BLOCK_ROWS,
         seed: int = 1) -> DataFrame:
    """``sized`` with source_size, target and copies (how often the mix takes the document).

    ``copies`` is floor(ratio) or floor(ratio) + 1, so no document is taken
    more than ``MOST_COPIES`` times. Documents are dealt to blocks by a hash
    of their keys and size and ordered by them there, so the result depends
    on the rows alone, not on their partitions; rows that agree in all of
    these are interchangeable. A hot source has many blocks.
    """
    wanted = landed(wanted, "targets")
    names = wanted.select(F.col("source").alias("w_source"), "source_size", "target", "ratio")
    rows = sized.join(sized_broadcast(names), F.col("source").eqNullSafe(F.col("w_source"))).drop("w_source")
    whole = F.floor("ratio").cast("long")
    rows = rows.withColumn("whole", whole).withColumn("prob", F.col("ratio") - whole)
    rows = rows.drop("ratio")
    settled = (F.col("prob") <= EPS) | (F.col("prob") >= 1 - EPS)
    decided, others = _dominating_first(rows.filter(~settled), keys, seed)
    others = landed(others, "shifted")
    parts = [
        r.withColumn("copies", F.col("whole") + F.round("prob").cast("long")).drop("prob", "whole")
        for r in (rows.filter(settled), decided, others.filter(settled))
    ]
    left = others.filter(~settled)
    level = 0
    while True:
        left = landed(left, f"cube-{level}")
        count = left.groupBy("source").agg(F.count("*").alias("n"))
        most = count.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
        blocks = F.ceil(F.col("n") / block_rows)
        dealt = left.join(
            sized_broadcast(count.select(F.col("source").alias("n_source"), "n")),
            F.col("source").eqNullSafe(F.col("n_source")),
        )
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64(*[col(k) for k in keys], "size", F.lit(level)), blocks))
        dealt = dealt.drop("n", "n_source")
        last = most <= block_rows
        settle = _settle(left.columns, [*keys, "size", "prob"], last, level, seed)
        done = landed(dealt.groupBy("source", "block").applyInArrow(settle, left.schema), f"flown-{level}")
        parts.append(
            done.filter(settled).withColumn("copies", F.col("whole") + F.round("prob").cast("long")).drop("prob", "whole")
        )
        if last:
            break
        left = done.filter(~settled)
        level += 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _settle(names: list[str], order: list[str], final: bool, level: int, seed: int):
    """Flight (and, at the last level, landing) of one block."""

    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by([(k, "ascending") for k in order])
        size = block["size"].to_numpy()
        key = (block["source"][0].as_py(), block["block"][0].as_py(), level)
        prob = flight(size, block["prob"].to_numpy(), key, seed)
        if final:
            prob = land(size, prob)
        return block.set_column(block.schema.get_field_index("prob"), "prob", pa.array(prob)).select(names)

    return run


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """doc_id, size, source_size, target (of its source) and taken (words the mix takes).

    Null text has size 0; an empty table gives no rows; if all texts are
    empty every target is 0. Rows with equal ids are documents of their own.
    """
    sized = landed(sizes(docs), "sizes")
    mixed = take(sized, targets(sized, weights, share))
    return mixed.select(
        F.col("doc_id").cast("long").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (not taken: no row).

    Rows are told apart by a number that Spark gives them. It follows the
    splits of the scan, which change with the executors, so the numbered rows
    are written once and both the sizes and the result are read from there.
    """
    row, copies, again = (unused_name(docs, x) for x in ("row_", "copies_", "again_"))
    numbered = landed(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    sized = landed(sizes(numbered.select(col(row).alias("row"), col("source"), col("text")), ("row",)), "sizes")
    mixed = take(sized, targets(sized, weights, share), keys=("row",))
    chosen = landed(mixed.filter("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(copies)), "chosen")
    return (
        numbered.join(sized_broadcast(chosen), row)
        .withColumn(again, F.explode(F.sequence(F.lit(1), col(copies).cast("int"))))
        .select(*[col(c) for c in docs.columns])
    )

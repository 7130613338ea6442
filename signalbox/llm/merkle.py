"""Merkle manifest of a dataset, with proofs by pointer jumping.

Every row is a leaf. The leaves of a source, in order of their ids, form a
tree in which ``FAN`` consecutive nodes have a parent; the roots of the
sources, in order of the sources, form one more. A digest is the SHA-256 of
the digests below it, as hex text; a leaf's is that of its fields.

Trees: rows are range-partitioned and sorted by (source, id), so a source may
hold any share of all rows; their places follow from one count per partition
and source. Six levels of a tree come from one shuffle: the 729 leaves below
a node of level six meet in one row, whose arrays are folded by built-in
functions. Every node keeps its siblings, left and right, as the segment of
its proof up to its parent.

Proofs: each round joins the table of nodes with itself. A node whose segment
reaches the ancestor ``d`` levels up takes over that ancestor's segment, and
reaches ``2 d`` levels. Leaves stand on level 0, so after a round only the
levels divisible by ``2 d`` are pointed at, and only they are kept: the upper
side shrinks from a third of the nodes to a ninth, an 81st and so on. Join
keys are (tree, level, place); none repeats more often than ``3 ** d`` times.
Every round is written to the shared folder. All steps are DataFrame
expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalbox.llm.common import col, landed, sized_broadcast

FAN = 3
STEP = 6  # levels that one shuffle builds
LEVELS = 39  # FAN ** LEVELS is below 2 ** 63
CHUNK = 1 << 16  # leaves of a source that share one copy of its upper segment
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SEGMENT = "array<struct<left:binary,right:binary>>"


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 (hex) of the fields: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(f) for f in fields]), 256)


def _height(leaves: Column) -> Column:
    """Levels above the leaves of a tree."""
    return sum(((leaves > FAN**k).cast("int") for k in range(LEVELS)), F.lit(0))


def numbered(rows: DataFrame, tree: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``place`` (from 0 within ``tree``, in order), and the written frame's spans of each tree.

    No task sees more than its range partition; only counts per partition and
    tree are added up.
    """
    placed = landed(
        rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
        .withColumn("row", F.monotonically_increasing_id()),
        "manifest-rows",
    )
    part = F.shiftright("row", 33)
    spans = placed.groupBy(F.col(tree).alias("s_tree"), part.alias("s_part")).agg(
        F.min("row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("s_tree").orderBy("s_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = landed(
        spans.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("leaves", F.sum("n").over(Window.partitionBy("s_tree"))),
        "manifest-spans",
    )
    return placed, spans


def _placed(placed: DataFrame, spans: DataFrame, tree: str) -> DataFrame:
    """The rows with the columns of their span and their ``place``."""
    joined = placed.join(
        sized_broadcast(spans),
        F.col(tree).eqNullSafe(F.col("s_tree")) & (F.shiftright("row", 33) == F.col("s_part")),
    )
    return joined.withColumn("place", F.col("row") - F.col("first") + F.col("before"))


def _levels(nodes: DataFrame, base: int) -> DataFrame:
    """One shuffle: levels ``base`` to ``base + STEP`` below each node of the upper one.

    ``nodes``: tree, height, place, digest and carried columns of level
    ``base``. Rows: tree, height, level, place, digest, segment (null for the
    topmost level built), carry.
    """
    block = nodes.groupBy("tree", "height", F.expr(f"place div {FAN**STEP}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", "carry"))).alias("given"))
    block = block.withColumn("l0", F.transform("given", lambda x: _hex(x["digest"])))

    def above(below: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(below) - 1) / FAN).cast("int"))
        return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(below, FAN * i + 1, FAN), ""), 256))

    for j in range(STEP):
        block = block.withColumn(f"l{j + 1}", F.when(F.col("height") > base + j, above(F.col(f"l{j}"))))

    def level(j: int) -> Column:
        here = F.col(f"l{j}")
        topmost = (F.col("height") == base + j) if j < STEP else F.lit(True)

        def node(digest: Column, i: Column) -> Column:
            run = i - i % FAN
            sides = F.struct(
                F.unhex(F.array_join(F.slice(here, run + 1, i - run), "")).alias("left"),
                F.unhex(F.array_join(F.slice(here, i + 2, run + FAN - 1 - i), "")).alias("right"),
            )
            carry = F.col("given")[i]["carry"] if j == 0 else F.lit(None)
            return F.struct(
                F.lit(base + j).alias("level"), (F.col("block") * FAN ** (STEP - j) + i).alias("place"),
                F.unhex(digest).alias("digest"), F.when(~topmost, F.array(sides)).cast(SEGMENT).alias("segment"),
                carry.cast(nodes.schema["carry"].dataType).alias("carry"),
            )

        return F.coalesce(F.transform(here, node), F.transform(F.slice("l0", 1, 0), node))

    return block.select("tree", "height", F.explode(F.flatten(F.array(*[level(j) for j in range(STEP + 1)]))).alias("n")).select(
        "tree", "height", "n.*")


def forest(leaves: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """All nodes of trees with their segments to the parent, the trees' roots, and the greatest height.

    ``leaves``: tree, height, place, digest (binary), carry (anything that
    the leaf keeps).
    """
    tallest = leaves.agg(F.max("height")).first()[0] or 0
    lone = leaves.filter("height = 0").withColumn("level", F.lit(0)).withColumn("segment", F.array().cast(SEGMENT))
    columns = ["tree", "height", "level", "place", "digest", "segment", "carry"]
    nodes, roots = lone.select(*columns), lone.select("tree", "digest")
    current, base = leaves.filter("height > 0"), 0
    while base < tallest:
        built = landed(_levels(current, base), "manifest-levels")
        nodes = nodes.unionByName(built.filter("segment IS NOT NULL").select(*columns))
        top = built.filter("segment IS NULL")
        roots = roots.unionByName(top.filter("level = height").select("tree", "digest"))
        current, base = top.filter("level < height"), base + STEP
    return nodes, roots, tallest


def proofs(nodes: DataFrame, tallest: int) -> DataFrame:
    """Leaves (level 0) with the segments up to their root, by repeated self-joins."""
    reach = 1
    while reach < tallest:
        upper = nodes.filter(F.col("level") % (2 * reach) == reach).select(
            F.col("tree").alias("u_tree"), F.col("level").alias("u_level"), F.col("place").alias("u_place"),
            F.col("segment").alias("u_segment"))
        lower = nodes.filter(F.col("level") % (2 * reach) == 0)
        above = F.expr(f"place div {FAN ** min(reach, LEVELS)}")
        nodes = landed(
            lower.join(
                sized_broadcast(upper),
                (F.col("tree") == F.col("u_tree")) & (F.col("level") + reach == F.col("u_level"))
                & (above == F.col("u_place")),
                "left",
            ).select(
                "tree", "height", "level", "place", "digest",
                F.concat("segment", F.coalesce("u_segment", F.array().cast(SEGMENT))).alias("segment"), "carry"),
            "manifest-proofs",
        )
        reach *= 2
    return nodes.filter("level = 0")


def folded(digest: Column, segment: Column) -> Column:
    """The root (hex) that a leaf's digest (hex) and its segment lead to."""
    return F.aggregate(
        segment, digest, lambda below, s: F.sha2(F.concat(_hex(s["left"]), below, _hex(s["right"])), 256))


def manifest(documents: DataFrame, fields: tuple[str, ...] = FIELDS, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: its digest, the roots, and its whole proof.

    Columns: doc_id, leaf, subroot, root (hex), proof (an array of siblings
    left and right of the path, from the leaf's level to the root), and
    ``carry``: expressions over the documents, evaluated in the first scan.
    The key of a tree is ``source``; a null source is one of its own and comes
    first, likewise a null doc_id. Equal ids are ordered by their digests;
    equal rows are leaves of their own. An empty table gives no rows.
    """
    carried = F.struct(col("doc_id").cast("long").alias("doc_id"), *[c.alias(k) for k, c in (carry or {}).items()])
    rows = documents.select(
        col("source").cast("string").alias("source"), F.unhex(leaf_digest([col(f) for f in fields])).alias("digest"),
        carried.alias("carry"), col("doc_id").cast("long").alias("key"))
    placed, spans = numbered(rows, "source", ["key", "digest"])
    # Sources take their places in the upper tree; from here on they are numbers.
    sources = spans.groupBy(F.col("s_tree").alias("name")).agg(F.max("leaves").alias("held")).withColumn("all", F.lit(0))
    ranked, ranks = numbered(sources, "all", ["name"])
    ranked = landed(_placed(ranked, ranks, "all").select(
        "name", F.col("place").alias("rank"), F.col("leaves").alias("sources")), "manifest-sources")
    spans = spans.join(sized_broadcast(ranked), F.col("s_tree").eqNullSafe(F.col("name")))
    leaves = landed(
        _placed(placed, spans, "source").select(
            F.col("rank").alias("tree"), _height(F.col("leaves")).alias("height"), "place", "digest", "carry", "leaves"),
        "manifest-leaves",
    )
    nodes, roots, tallest = forest(leaves.drop("leaves"))
    roots = landed(roots, "manifest-roots")
    held = leaves.groupBy("tree").agg(F.max("leaves").alias("held"))
    tops = roots.join(held, "tree").join(
        sized_broadcast(ranked.select("rank", "sources")), F.col("tree") == F.col("rank")).select(
        F.lit(0).cast("long").alias("tree"), _height(F.col("sources")).alias("height"), F.col("rank").alias("place"),
        "digest", F.struct("held", "rank", F.col("digest").alias("subroot")).alias("carry"))
    upper_nodes, upper_roots, highest = forest(landed(tops, "manifest-tops"))
    whole = upper_roots.first()
    upper = proofs(upper_nodes, highest).select("carry.*", F.col("segment").alias("upper"))
    # One copy of a source's upper segment for every CHUNK leaves, so a large source is no hot key.
    upper = upper.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"held div {CHUNK}"))))
    done = proofs(nodes, tallest).withColumn("part", F.expr(f"place div {CHUNK}"))
    return done.join(
        sized_broadcast(landed(upper.select("rank", "chunk", "subroot", "upper"), "manifest-upper")),
        (F.col("tree") == F.col("rank")) & (F.col("part") == F.col("chunk")),
    ).select(
        "carry.*", _hex(F.col("digest")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
        F.lit(whole["digest"].hex() if whole else None).alias("root"), F.concat("segment", "upper").alias("proof"),
    )


def proof_digest(proof: Column) -> Column:
    """SHA-256 (hex) of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: _hex(F.concat(s["left"], s["right"]))), ""), 256)

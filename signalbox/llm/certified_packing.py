"""Best-fit packing with certified repacking.

Documents are encoded once; ids beyond a window are cut off in whole windows,
which are sequences of their own, and what is left of each document is an
item that must not be cut. Items are dealt to partitions of bounded size.
Each partition packs by best-fit decreasing: items in falling size, each into
the fullest sequence that has room. It then computes lower bounds of the
number of sequences by dual-feasible functions (functions f with
``sum f(x) <= 1`` whenever ``sum x`` fits a window, so that the sum of ``f``
over all items needs as many windows): a partition whose count equals the
bound is certified and done. From a partition with a gap, every sequence that
is not full gives its documents back; a certified partition gives back its
emptiest sequence alone, as its last one is rounded up. What came back is
dealt anew to fewer partitions, packed best-fit decreasing and certified
again. A round counts only if it needs fewer sequences for the same items;
the first that does not ends the work.

The rows that move are (document, piece, size, checksum), never texts or ids.
Rounds are written to the shared folder; an item's partition follows from its
number and the round, so lost tasks repeat alike.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbox.llm.common import landed, utf8
from signalbox.llm.token_ids import encoder

WINDOW = 2048
END = 0
PART_ITEMS = 50_000  # items that one task packs
ROUNDS = 8
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = "item long, size int, part long, bin long, offset long, fill int, bound long, bins long"


def best_fit_decreasing(sizes: np.ndarray, window: int) -> np.ndarray:
    """The sequence number of each item; ``sizes`` must fall and lie within 1 .. ``window``."""
    where = np.zeros(len(sizes), np.int64)
    rooms: list[int] = []  # room left in open sequences, rising, without repeats
    held: dict[int, list[int]] = {}  # room -> its sequences
    used = 0
    for i, size in enumerate(sizes.tolist()):
        k = bisect_left(rooms, size)
        if k == len(rooms):
            number, room = used, window
            used += 1
        else:
            room = rooms[k]
            number = held[room].pop()
            if not held[room]:
                del held[room]
                rooms.pop(k)
        where[i], left = number, room - size
        if left:
            if left not in held:
                held[left] = []
                insort(rooms, left)
            held[left].append(number)
    return where


def lower_bound(counts: np.ndarray, window: int) -> int:
    """A certified least number of sequences for ``counts[s]`` items of each size ``s``.

    The greatest of the bounds by the identity, by ``u_k`` (k + 1 times the
    size rounded down to whole windows, divided by k; exact multiples stay as
    they are) and by the threshold functions: items above ``window - t``
    count as a whole window, items below ``t`` as nothing, also combined with
    ``u_k`` in between.
    """
    sizes = np.arange(window + 1, dtype=np.int64)
    present = np.flatnonzero(counts)
    if not len(present):
        return 0
    x, n = sizes[present], counts[present].astype(object)
    best = -(-int((x.astype(object) * n).sum()) // window)
    thresholds = [0, *[int(t) for t in present if 2 * t <= window]]
    for k in (None, 1, 2, 3, 4, 5, 7, 9, 12, 20):
        if k is None:  # the identity, in units of 1 / window
            value, unit = x, window
        else:  # in units of 1 / (k * window)
            grown = (k + 1) * x
            value, unit = np.where(grown % window == 0, x * k, grown // window * window), k * window
        weight = value.astype(object) * n
        # Thresholds t: sums of weights of sizes from t to window - t, and counts above.
        sums = np.concatenate([[0], np.cumsum(weight)])
        above = np.concatenate([[0], np.cumsum(n)])
        for t in thresholds:
            low, high = int(np.searchsorted(x, t)), int(np.searchsorted(x, window - t, "right"))
            total = (above[-1] - above[high]) * unit + (sums[high] - sums[low] if high > low else 0)
            best = max(best, -(-int(total) // unit))
    return best


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def pieces(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END) -> DataFrame:
    """Every document's ids and ``end_id``, cut into windows; the last piece may be shorter."""
    schema = _arrow(PIECES)
    tail = np.array([end_id], "<u4").tobytes()
    step = 4 * window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = tokens.encode(text.as_py().decode("utf-8", "replace")) + tail
                for number, at in enumerate(range(0, len(own), step)):
                    ids = own[at : at + step]
                    rows.append((doc_id, number, at // 4, len(ids) // 4, zlib.crc32(ids)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text")).mapInArrow(run, PIECES)


def _packed(items: DataFrame, parts: int, salt: int, window: int) -> DataFrame:
    """Items (item, size) dealt to ``parts`` partitions, packed and certified one by one."""
    schema = _arrow(PACKED)

    def run(table: pa.Table) -> pa.Table:
        item, size, part = (table.column(c).to_numpy() for c in ("item", "size", "part"))
        order = np.lexsort((item, -size))
        item, size = item[order], size[order].astype(np.int64)
        where = best_fit_decreasing(size, window)
        bins = int(where.max()) + 1
        fill = np.bincount(where, weights=size, minlength=bins).astype(np.int64)
        # Offsets: the running size within each sequence.
        by_bin = np.argsort(where, kind="stable")
        before = np.cumsum(size[by_bin]) - size[by_bin]
        starts = np.concatenate([[0], np.cumsum(fill)[:-1]])
        offset = np.empty(len(size), np.int64)
        offset[by_bin] = before - starts[where[by_bin]]
        bound = lower_bound(np.bincount(size, minlength=window + 1), window)
        n = len(item)
        return pa.table([
            pa.array(item), pa.array(size, pa.int32()), pa.array(part[:n], pa.int64()), pa.array(where),
            pa.array(offset), pa.array(fill[where], pa.int32()), pa.array(np.full(n, bound), pa.int64()),
            pa.array(np.full(n, bins), pa.int64()),
        ], schema=schema)

    dealt = items.select("item", "size", F.pmod(F.xxhash64("item", F.lit(salt)), F.lit(parts)).alias("part"))
    return dealt.groupBy("part").applyInArrow(run, PACKED)


def _totals(packed: DataFrame) -> tuple[int, int, int]:
    """Items, sequences and the sum of the bounds of all partitions."""
    parts = packed.groupBy("part").agg(F.count("*").alias("n"), F.max("bins").alias("b"), F.max("bound").alias("l"))
    return tuple(x or 0 for x in parts.agg(F.sum("n"), F.sum("b"), F.sum("l")).first())


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END, part_items: int = PART_ITEMS,
         rounds: int = ROUNDS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, round.

    A null text is empty (its end id alone). Rows with equal ids are documents
    of their own. ``round`` tells when the piece found its place (null: a
    whole window). Sequence numbers are unique, with gaps. An empty table
    gives no rows. A task holds at most about ``part_items`` items.
    """
    cut = landed(
        pieces(docs, vocabulary, window, end_id).withColumn("item", F.monotonically_increasing_id()), "packing-pieces")
    small = cut.filter(F.col("length") < window).select("item", F.col("length").cast("int").alias("size"))
    pool, placed, number = small, None, 0
    n = pool.count()
    held = None  # sequences that the pool's items take at present
    current = None  # their present places
    while n and number < rounds:
        parts = -(-n // part_items)
        packed = landed(_packed(pool, parts, number, window), "packing-round").withColumn("round", F.lit(number))
        _, bins, _ = _totals(packed)
        if held is not None and bins >= held:
            break  # no gain: the pool's items stay where they are
        # Emptiest sequence of each partition: one row per partition.
        worst = packed.groupBy(F.col("part").alias("w_part")).agg(F.min(F.struct("fill", "bin")).alias("w"))
        marked = packed.join(worst, F.col("part") == F.col("w_part")).withColumn(
            "back",
            (F.col("fill") < window) & ((F.col("bins") > F.col("bound")) | (F.col("bin") == F.col("w.bin"))),
        ).drop("w", "w_part")
        stay = marked.filter(~F.col("back"))
        placed = stay if placed is None else placed.unionByName(stay)
        current = landed(marked.filter("back").drop("back"), "packing-pool")
        pool = current.select("item", "size")
        n, held = current.count(), current.select("part", "bin").distinct().count()
        number += 1
        if parts == 1:
            break  # nothing to exchange with
    where = "item", "part", "bin", "offset", "round"
    if placed is None:
        placed = cut.limit(0).select("item", *[F.lit(0).cast("long").alias(c) for c in where[1:4]], F.lit(0).alias("round"))
    else:
        placed = placed.select(*where).unionByName(current.select(*where))
    # Round, partition and sequence in one number; whole windows count down from -1.
    sequence = F.shiftleft(F.col("round").cast("long"), 58) + F.shiftleft(F.col("part"), 20) + F.col("bin")
    rest = cut.filter(F.col("length") < window).join(placed, "item").select(
        "doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset", "round")
    whole = cut.filter(F.col("length") == window).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("item")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), F.lit(None).cast("int").alias("round"))
    return rest.unionByName(whole)

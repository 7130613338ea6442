"""Exact top-k inner products on a bit-sliced index.

Every vector component is quantised to floor(scale * x). The index holds, per
block of rows and attribute, one bitmap over the rows for each bit (slice) of
the value above the attribute's minimum in the block. A query's scores for a
whole block are the weighted sum of the attributes: each weight's set bits put
the attribute's slices (complemented for a negative weight) at the weighted
places, and full adders (three bitmaps in, a sum and a carry out) reduce every
place to one slice of the score. The best k rows are then selected from the
most significant slice downward; rows that tie at the boundary are resolved
exactly by their id. Numbers are integers throughout, so nothing is
approximate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalbox.llm.common import landed

SCALE = 64
BLOCK_ROWS = 1 << 16
QUERY_ROWS = 128
INDEX_SCHEMA = "block long, n int, ids binary, lows binary, widths binary, slices binary"
RESULT = "query_id long, vec_id long, score long"


class SliceBlock:
    """Bit slices of a block of quantised rows, ascending by id."""

    def __init__(self, ids: np.ndarray, lows: np.ndarray, widths: np.ndarray, slices: np.ndarray):
        self.ids, self.lows, self.widths, self.slices = ids, lows, widths, slices
        self.first = np.concatenate([[0], np.cumsum(widths)]).astype(int)
        self.words = slices.shape[1] if len(slices) else (len(ids) + 63) // 64
        self.flipped = ~slices
        self.all = np.zeros(self.words * 64, np.uint8)
        self.all[: len(ids)] = 1
        self.all = np.packbits(self.all, bitorder="little").view(np.uint64)

    @classmethod
    def build(cls, ids: np.ndarray, values: np.ndarray) -> SliceBlock:
        order = np.argsort(ids, kind="stable")
        ids, values = ids[order], values[order]
        lows = values.min(axis=0)
        above = (values - lows).astype(np.uint64)
        widths = np.array([int(m).bit_length() for m in above.max(axis=0)], np.int64)
        words = (len(ids) + 63) // 64
        slices = np.zeros((int(widths.sum()), words * 64), np.uint8)
        at = 0
        for d, width in enumerate(widths):
            for bit in range(int(width)):
                slices[at, : len(ids)] = (above[:, d] >> np.uint64(bit)) & np.uint64(1)
                at += 1
        packed = np.packbits(slices, axis=1, bitorder="little").view(np.uint64).reshape(len(slices), words)
        return cls(ids, lows, widths, packed)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the block's scores, least significant first, and the number to add to them."""
        places: list[list[np.ndarray]] = []
        constant = int(np.dot(query, self.lows))
        for d in np.flatnonzero(query):
            weight, width, first = int(query[d]), int(self.widths[d]), self.first[d]
            source = self.slices
            if weight < 0:
                # -w * u = w * (2^width - 1 - u) - w * (2^width - 1)
                constant += weight * ((1 << width) - 1)
                source, weight = self.flipped, -weight
            for shift in range(weight.bit_length()):
                if weight >> shift & 1:
                    while len(places) < shift + width:
                        places.append([])
                    for bit in range(width):
                        places[shift + bit].append(source[first + bit])
        out, at = [], 0
        while at < len(places):
            bitmaps = places[at]
            while len(bitmaps) >= 3:  # full adder
                a, b, c = bitmaps.pop(), bitmaps.pop(), bitmaps.pop()
                half = a ^ b
                carry = a & b
                carry |= half & c
                half ^= c
                bitmaps.insert(0, half)
                self._carry(places, at + 1, carry)
            if len(bitmaps) == 2:  # half adder
                a, b = bitmaps
                bitmaps[:] = [a ^ b]
                self._carry(places, at + 1, a & b)
            out.append(bitmaps[0] if bitmaps else np.zeros(self.words, np.uint64))
            at += 1
        return out, constant

    @staticmethod
    def _carry(places: list[list[np.ndarray]], at: int, bitmap: np.ndarray) -> None:
        while len(places) <= at:
            places.append([])
        places[at].append(bitmap)

    def top(self, query: np.ndarray, query_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows whose id is not the query's; ties to smaller ids."""
        slices, constant = self.scores(query)
        open_ = self.all.copy()
        lo, hi = np.searchsorted(self.ids, [query_id, query_id + 1])
        for row in range(lo, hi):
            open_[row >> 6] &= ~np.uint64(1 << (row & 63))
        sure = np.zeros(self.words, np.uint64)
        n_sure = 0
        for bitmap in reversed(slices):
            ones = open_ & bitmap
            n = int(np.bitwise_count(ones).sum())
            if n_sure + n > k:
                open_ = ones
            else:
                sure |= ones
                n_sure += n
                open_ &= ~bitmap
                if n_sure == k:
                    break
        rows = self._rows(sure)
        if n_sure < k:  # rows tied at the boundary: the smallest ids
            rows = np.concatenate([rows, self._rows(open_)[: k - n_sure]])
        score = np.full(len(rows), constant, np.int64)
        at, bit = rows >> 6, (rows & 63).astype(np.uint64)
        for place, bitmap in enumerate(slices):
            score += ((bitmap[at] >> bit) & np.uint64(1)).astype(np.int64) << place
        return self.ids[rows], score

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        words = np.flatnonzero(bitmap)
        bits = np.unpackbits(bitmap[words].view(np.uint8), bitorder="little").reshape(len(words), 64)
        word, bit = np.nonzero(bits)
        return words[word] * 64 + bit


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and values (array<long>): floor(scale * x) of rows that take part.

    Rows with a null id, a null vector, or a null or non-finite component take no part.
    """
    values = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), values.alias("values")
    )


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to ``dims`` columns."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def build_index(values: DataFrame, n_blocks: int, dims: int) -> DataFrame:
    """The index: one row per block, numbered below ``n_blocks``.

    Rows are dealt out evenly (round robin), so a block holds its share of
    the rows and the number of a block is that of its partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = [], []
        for batch in batches:
            ids.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            rows.append(_matrix(batch.column(1), dims))
        if sum(map(len, ids)):
            b = SliceBlock.build(np.concatenate(ids), np.concatenate(rows))
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([TaskContext.get().partitionId()], pa.int64()),
                "n": pa.array([len(b.ids)], pa.int32()),
                **{k: pa.array([v.tobytes()], pa.binary()) for k, v in
                   (("ids", b.ids), ("lows", b.lows), ("widths", b.widths), ("slices", b.slices))},
            })

    return values.repartition(n_blocks).mapInArrow(run, INDEX_SCHEMA)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = SCALE,
          block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: every query's k best rows of ``vectors``.

    ``vectors`` and ``queries`` have vec_id and embedding. Candidates of a
    query are all rows whose vec_id differs from its own; if query rows share
    an id, one of them (the smallest vector) asks. Vectors of
    unequal length are compared as if padded with zeros. No query or no
    candidate gives no rows.

    Row blocks meet query blocks by (block, salt): a row block is copied to
    as many salts as keep the cores busy, a query block to every row block, so
    a task holds one row block and one query block at a time. Each meeting
    returns at most k rows per query; the final ranking keeps k per query in
    every task before it shuffles.
    """
    spark = vectors.sparkSession
    values = quantised(vectors, scale)
    asked = quantised(queries, scale).groupBy("vec_id").agg(F.min("values").alias("values"))
    n_rows, dims = values.agg(F.count("*"), F.coalesce(F.max(F.size("values")), F.lit(0))).first()
    dims = max(dims, asked.agg(F.coalesce(F.max(F.size("values")), F.lit(0))).first()[0], 1)
    n_blocks = max(1, math.ceil(n_rows / block_rows))
    index = landed(build_index(values, n_blocks, dims), "bitslices")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 24
        for batch in batches:
            for at in range(0, batch.num_rows, query_rows):
                part = batch.slice(at, query_rows)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([serial], pa.int64()),
                    "query_ids": pa.array([part.column(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes()], pa.binary()),
                    "weights": pa.array([_matrix(part.column(1), dims).tobytes()], pa.binary()),
                })
                serial += 1

    cores = spark.sparkContext.defaultParallelism
    salts = max(1, math.ceil(2 * cores / n_blocks))
    asked_blocks = asked.mapInArrow(gather, "part long, query_ids binary, weights binary")
    left = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    right = asked_blocks.withColumn("salt", F.pmod(F.xxhash64("part"), F.lit(salts)).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    )
    met = left.join(right, (left["block"] == right["other"]) & (left["salt"] == right["salt"])).select(
        "block", "ids", "lows", "widths", "slices", "query_ids", "weights"
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda i, kind: np.frombuffer(batch.column(i)[row].as_py(), kind)  # noqa: B023, E731
                if held != batch.column(0)[row].as_py():
                    held = batch.column(0)[row].as_py()
                    ids, widths = get(1, np.int64), get(3, np.int64)
                    slices = get(4, np.uint64).reshape(int(widths.sum()), -1) if widths.sum() else np.zeros(
                        (0, (len(ids) + 63) // 64), np.uint64)
                    block = SliceBlock(ids, get(2, np.int64), widths, slices)
                asking, weights = get(5, np.int64), get(6, np.int64).reshape(-1, dims)
                found = [(q, *block.top(w, int(q), k)) for q, w in zip(asking, weights, strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "query_id": pa.array(np.concatenate([np.full(len(i), q) for q, i, _ in found]), pa.int64()),
                    "vec_id": pa.array(np.concatenate([i for _, i, _ in found]), pa.int64()),
                    "score": pa.array(np.concatenate([s for _, _, s in found]), pa.int64()),
                })

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        met.mapInArrow(search, RESULT)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

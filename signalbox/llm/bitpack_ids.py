"""Token ids in files of fixed-width bit packing.

A segment file is: magic, a header of unsigned 64-bit numbers, an index of the
documents in it, the byte offsets of its blocks, and the blocks. Every id of a
block takes the same number of bits, the fewest that hold the vocabulary, so
the bit place of any id follows from its number: blocks are unpacked by
vectorised numpy operations, and a document is read by unpacking only the
blocks that hold it.

Documents are range-partitioned and sorted by id; each task encodes and packs
its texts as a stream of segments of at most ``segment_ids`` ids (a longer
document has a segment of its own). Spark's text sink writes one segment a
file (the byte after the image is its line end, which readers ignore), and its
binary source reads the files back, so they may lie in any store that Spark
reaches.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalbox.llm.common import fresh_path, utf8
from signalbox.llm.token_ids import END_ID, encoder

MAGIC = b"SBTOKEN1"
BLOCK_IDS = 1 << 14
SEGMENT_IDS = 1 << 21
TASK_CHARS = 16 << 20  # text of about this size goes to one task
HEADER = ("bits", "block_ids", "n_ids", "n_docs", "part", "segment", "nulls")


def id_bits(vocab_size: int) -> int:
    """The fewest bits that hold ids below ``vocab_size``."""
    return max(1, (vocab_size - 1).bit_length())


def pack_block(ids: np.ndarray, bits: int) -> bytes:
    """Ids at ``bits`` bits each, least significant bit first."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    places = np.arange(bits, dtype=np.uint32)
    return np.packbits((ids.astype(np.uint32)[:, None] >> places & 1).astype(np.uint8), bitorder="little").tobytes()


def unpack_block(data: bytes, n: int, bits: int) -> np.ndarray:
    """The ``n`` ids of a block."""
    if bits == 16:
        return np.frombuffer(data, "<u2", n).astype("<u4")
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (flat.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32).astype("<u4")


def build_segment(doc_ids: list, ids: list[bytes], bits: int, part: int, segment: int,
                  block_ids: int = BLOCK_IDS) -> bytes:
    """The file image of a segment. ``ids``: per document, as little-endian unsigned 32-bit numbers."""
    every = np.frombuffer(b"".join(ids), "<u4")
    ends = np.cumsum([len(x) // 4 for x in ids]).astype("<u8")
    blocks = [pack_block(every[at : at + block_ids], bits) for at in range(0, len(every), block_ids)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    numbers = np.array([0 if d is None else d for d in doc_ids], "<i8")
    nulls = sum(d is None for d in doc_ids)  # null ids come first
    header = np.array([bits, block_ids, len(every), len(ids), part, segment, nulls], "<u8")
    return b"".join([MAGIC, header.tobytes(), numbers.tobytes(), ends.tobytes(), offsets.tobytes(), *blocks])


class Segment:
    """Random access to a segment's image."""

    def __init__(self, image: bytes):
        if image[:8] != MAGIC:
            raise ValueError("not a token segment")
        header = dict(zip(HEADER, np.frombuffer(image, "<u8", len(HEADER), 8).tolist(), strict=True))
        self.__dict__ |= header
        at = 8 + 8 * len(HEADER)
        self.doc_ids = np.frombuffer(image, "<i8", self.n_docs, at)
        self.ends = np.frombuffer(image, "<u8", self.n_docs, at + 8 * self.n_docs).astype(np.int64)
        at += 16 * self.n_docs
        n_blocks = -(-self.n_ids // self.block_ids)
        self.offsets = np.frombuffer(image, "<u8", n_blocks + 1, at).astype(np.int64)
        self.image, self.data = image, at + 8 * (n_blocks + 1)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to ``stop`` of the segment; only their blocks are unpacked."""
        if stop <= start:
            return np.zeros(0, "<u4")
        size, first = self.block_ids, start // self.block_ids
        out = []
        for b in range(first, -(-stop // size)):
            n = min(size, self.n_ids - b * size)
            out.append(unpack_block(self.image[self.data + self.offsets[b] : self.data + self.offsets[b + 1]], n, self.bits))
        return np.concatenate(out)[start - first * size : stop - first * size]

    def document(self, number: int) -> np.ndarray:
        """All ids of the segment's document of that number."""
        return self.ids(int(self.ends[number - 1]) if number else 0, int(self.ends[number]))


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS,
              block_ids: int = BLOCK_IDS, task_chars: int = TASK_CHARS) -> None:
    """Encode every whole text (null: empty), append ``end_id``, write segments in ascending doc_id order.

    A null doc_id comes first; rows with equal ids are ordered by their text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    chars = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, serial = encoder(vocabulary), TaskContext.get().partitionId(), 0
        bits = id_bits(max(tokens.vocab_size, end_id + 1))
        doc_ids, held, size = [], [], 0

        def image() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"image": pa.array([build_segment(doc_ids, held, bits, part, serial, block_ids)], pa.binary())}
            )

        for batch in batches:
            encoded = tokens.encode_batch(batch.column(1), end_id)
            for doc_id, own in zip(batch.column(0).to_pylist(), encoded, strict=True):
                if held and size + len(own) > 4 * segment_ids:
                    yield image()
                    doc_ids, held, size, serial = [], [], 0, serial + 1
                doc_ids.append(doc_id)
                held.append(own)
                size += len(own)
        if held:
            yield image()

    ordered = rows.repartitionByRange(max(1, math.ceil(chars / task_chars)), "doc_id").sortWithinPartitions(
        "doc_id", "text"
    )
    images = ordered.mapInArrow(run, "image binary").select(F.col("image").cast("string").alias("value"))
    images.write.option("maxRecordsPerFile", 1).text(path)


SCHEMA = "part long, segment long, number long, doc_id long, n_tokens long, ids_crc32 long, before long"


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, part, segment, number of every document in the files below ``path``.

    ``start`` counts the ids of all documents before it: those in its
    segment, in the segments before it of its part (range partition), and in
    the parts before. Only totals per segment and per part are added up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for image in batch.column(0):
                s = Segment(image.as_py())
                starts = np.concatenate([[0], s.ends[:-1]])
                every = memoryview(s.ids(0, s.n_ids)).cast("B")  # each block is unpacked once
                crc = [zlib.crc32(every[4 * a : 4 * b]) for a, b in zip(starts.tolist(), s.ends.tolist(), strict=True)]
                numbers = [None if i < s.nulls else d for i, d in enumerate(s.doc_ids.tolist())]
                n = s.n_docs
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([s.part] * n, pa.int64()), "segment": pa.array([s.segment] * n, pa.int64()),
                    "number": pa.array(range(n), pa.int64()), "doc_id": pa.array(numbers, pa.int64()),
                    "n_tokens": pa.array(s.ends - starts, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                    "before": pa.array(starts, pa.int64()),
                })

    docs = (
        spark.read.format("binaryFile").load(path).filter(F.col("length") > 0).select("content").mapInArrow(run, SCHEMA)
    )
    return docs


def with_starts(docs: DataFrame) -> DataFrame:
    """``read_ids`` rows with the global ``start``."""
    segments = docs.groupBy("part", "segment").agg(F.sum("n_tokens").alias("ids"))
    parts = segments.groupBy(F.col("part").alias("p_part")).agg(F.sum("ids").alias("part_ids"))
    upto = Window.orderBy("p_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range partition
    parts = parts.withColumn("part_start", F.coalesce(F.sum("part_ids").over(upto), F.lit(0)))
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        segments.withColumn("in_part", F.coalesce(F.sum("ids").over(within), F.lit(0)))
        .join(parts, F.col("part") == F.col("p_part"))
        .select(F.col("part").alias("b_part"), F.col("segment").alias("b_segment"),
                (F.col("part_start") + F.col("in_part")).alias("base"))
    )
    return docs.join(base, (F.col("part") == F.col("b_part")) & (F.col("segment") == F.col("b_segment"))).select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "part", "segment", "number"
    )


def packed_documents(spark: SparkSession, docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Write ``docs`` as packed ids, read the files back, one row per document."""
    from signalbox.llm.common import landed

    path = fresh_path(spark, "token-ids")
    write_ids(docs, path, vocabulary, **options)
    return with_starts(landed(read_ids(spark, path), "token-docs"))

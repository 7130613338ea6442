"""Sum-of-squares online packing of token sequences.

Documents arrive one by one. Whole windows are cut off a document first; the
rest of s tokens goes to the fill level h that keeps the sum of squared counts
of partially filled windows smallest: with N[h] windows filled to h, moving
one from h to h + s changes the sum by 2 (N[h + s] - N[h]) + 2, closing one
(h + s = window) by 1 - 2 N[h], and opening one by 2 N[s] + 1. The counts are
one array with a cell per level; a placement is one vectorised minimum.

Each task packs its own partition with its own level array, so there is no
shuffle and a lost task is repeated alike. What stays partly filled at the
end of a partition is cut anew into full windows; the rest of less than one
window becomes sequences of power-of-two lengths, which need no padding.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbox.llm.common import utf8
from signalbox.llm.token_ids import END_ID, encoder

WINDOW = 4096
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class LevelPacker:
    """Online sum-of-squares packing; pieces are (document, start, ids as bytes)."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.counts = np.zeros(window, np.int64)  # N[h], h = 1 .. window - 1; N[0] stays 0
        self.open: dict[int, list[list[tuple]]] = defaultdict(list)  # level -> windows

    def place(self, piece: tuple, size: int) -> list[tuple] | None:
        """Put a piece of ``size`` < window tokens; returns a window that became full."""
        counts, room = self.counts, self.window - size
        # Levels 1 .. room - 1 stay partial, level room is closed by the piece.
        best, gain = 0, 2 * int(counts[size]) + 1
        held = np.flatnonzero(counts[1 : room + 1]) + 1
        if len(held):
            after = np.zeros(len(held), np.int64)
            inner = held < room
            after[inner] = 2 * counts[held[inner] + size] + 1
            change = after + 1 - 2 * counts[held]
            # Ties go to the fuller window.
            k = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[k] <= gain:
                best = int(held[k])
        window = self.open[best].pop() if best else []
        if best:
            counts[best] -= 1
        window.append(piece)
        if best + size == self.window:
            return window
        counts[best + size] += 1
        self.open[best + size].append(window)
        return None

    def add(self, doc: tuple, ids: bytes) -> Iterator[list[tuple]]:
        """Pack a document's ids; yields the windows that became full."""
        step = 4 * self.window
        cut = len(ids) // step * step
        for at in range(0, cut, step):
            yield [(doc, at // 4, ids[at : at + step])]
        if cut < len(ids):
            full = self.place((doc, cut // 4, ids[cut:]), (len(ids) - cut) // 4)
            if full:
                yield full

    def close(self) -> Iterator[list[tuple]]:
        """Cut what is partly filled into full windows and power-of-two sequences."""
        pieces = [p for level in sorted(self.open, reverse=True) for w in self.open[level] for p in w]
        left = sum(len(ids) for _, _, ids in pieces) // 4
        lengths = [self.window] * (left // self.window)
        rest = left % self.window
        lengths += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        pieces.reverse()
        for length in lengths:
            window, need = [], 4 * length
            while need:
                doc, start, ids = pieces.pop()
                window.append((doc, start, ids[:need]))
                if len(ids) > need:
                    pieces.append((doc, start + need // 4, ids[need:]))
                need -= min(need, len(ids))
            yield window


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: where each part of each document's ids went.

    A document's ids are those of its whole text (null: empty) and
    ``end_id``. ``start`` and ``length`` give the piece within them,
    ``ids_crc32`` its checksum (little-endian unsigned 32-bit ids),
    ``sequence_id`` and ``offset`` its place. Offsets of a sequence run
    without gaps from 0. Rows with equal ids are documents of their own; an
    empty table gives no rows. Memory: ids of partly filled windows and one
    Arrow batch of texts.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(SCHEMA))
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, tokens = LevelPacker(window), encoder(vocabulary)
        serial = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def emit(full: list[tuple]) -> None:
            nonlocal serial
            offset = 0
            for (doc_id, total), start, ids in full:
                n = len(ids) // 4
                rows.append((doc_id, start, n, zlib.crc32(ids), total, serial, offset))
                offset += n
            serial += 1

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for doc_id, text in zip(ids, texts, strict=True):
                own = tokens.encode(text.as_py().decode("utf-8", "replace")) + tail
                for full in packer.add((doc_id.as_py(), len(own) // 4), own):
                    emit(full)
                if len(rows) >= 5000:
                    yield _batch(rows, schema)
                    rows.clear()
        for full in packer.close():
            emit(full)
        if rows:
            yield _batch(rows, schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text")).mapInArrow(
        run, SCHEMA
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

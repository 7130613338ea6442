"""Quality rules with cross-document line frequency.

Lines are normalised and hashed; per host (the ``source`` column) the distinct
documents that hold a line are counted, equal texts counting once. A line is
boilerplate where it stands in more than ``max(min_docs, share * documents of
the host)`` distinct documents. Boilerplate lines are removed, and a document
is rejected if less than ``keep_share`` of its words remains, or if it fails
the base rules (too short, or too many repeated word triples).

The first pass shuffles (host, line hash, text hash) only, with map-side
distinct and count, so a line or a host that holds a third of all rows is
combined before it moves. A host has at most ``lines per document / share``
boilerplate lines; they come back to its documents as one packed array.

Near copies are distinct texts, so a large group of them would make its own
lines boilerplate. With ``near`` the lines above the limit are counted again,
once per class of near copies; only documents that hold such a line are
classed, as no other can lower a count. The limit itself stays a share of the
host's distinct texts.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbox.llm.common import col, landed, map_batches, sized_broadcast, unused_name, utf8
from signalbox.llm.jaccard_join import RARE_MISS, link_classes

MIN_DOCS = 10
SHARE = 0.1
KEEP_SHARE = 0.3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Characters counted as symbols and the white space between words: fixed values.
SYMBOLS = b"#*$%&|<>"
NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)
_LOWER_ZERO = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x30 if 0x30 <= b <= 0x39 else b for b in range(256)
)
_CONTINUATION = bytes(range(0x80, 0xC0))


def line_hash(line: bytes) -> int:
    """Signed hash of a line, lower-cased, digits as 0, white space runs as one space; 0 if it has no word."""
    words = line.translate(_LOWER_ZERO).split()
    if not words:
        return 0
    h = xxhash.xxh3_64_intdigest(b" ".join(words)) or 1
    return h - (1 << 64) if h >> 63 else h


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur at least twice in the text."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    w = np.array([numbers.setdefault(x, len(numbers)) for x in words], np.int64)
    n = len(numbers)
    pairs = np.unique(w[:-1] * n + w[1:], return_inverse=True)[1]
    key = pairs[:-1] * n + w[2:]
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    hit = count[inverse] > 1
    covered = np.zeros(len(w), bool)
    for shift in range(3):
        covered[shift : shift + len(hit)] |= hit
    return int(covered.sum())


def base_measures(text: bytes) -> dict[str, int]:
    """The base counts of a text's UTF-8 bytes."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.split()]
    chars = b"".join(words).translate(None, _CONTINUATION)
    return {
        "n_words": len(words),
        "word_chars": len(chars),
        "n_symbols": len(text.translate(None, NOT_SYMBOLS)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated_words(words),
    }


def _packed(above: DataFrame) -> DataFrame:
    """host, lines: the lines of each host as one array of sixteen hex digits each, unhexed."""
    # hex() of a long is its two's complement.
    packed = F.unhex(F.array_join(F.transform(F.array_sort("all"), lambda x: F.lpad(F.hex(x), 16, "0")), ""))
    return above.groupBy("host").agg(F.collect_list("line").alias("all")).select("host", packed.alias("lines"))


def _class_counts(docs: DataFrame, limits: DataFrame, near: tuple[int, int]) -> DataFrame:
    """host, line, n: in how many classes of near copies (``near``: words of a shingle, percent) the lines of ``limits`` stand.

    Classes are those of ``jaccard_join.link_classes`` among the documents
    that hold such a line, with its chance ``RARE_MISS`` of a lost link.
    """
    held = "host string, lines array<long>, text binary"

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"host": [], "lines": [], "text": []}
        for host, text, packed in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            data = text.as_py()
            own = {line_hash(x) for x in data.split(b"\n")} & set(np.frombuffer(packed.as_py(), ">i8").tolist())
            if own:
                for name, value in (("host", host), ("lines", list(own)), ("text", data)):
                    out[name].append(value)
        return out

    rows = docs.select(col("source").cast("string").alias("host"), utf8("text").alias("text")).join(
        sized_broadcast(limits.select(F.col("host").alias("l_host"), F.col("lines").alias("packed"))),
        F.col("host").eqNullSafe(F.col("l_host")),
    )
    holders = map_batches(rows.select("host", "text", "packed"), run, held)
    holders = landed(holders.withColumn("doc_id", F.monotonically_increasing_id()), "line-holders")
    classes = link_classes(holders.select("doc_id", "text"), *near, miss=RARE_MISS).select(F.col("doc_id").alias("c_doc"), "class_set")
    lines = holders.select("doc_id", "host", "lines").join(classes, F.col("doc_id") == F.col("c_doc")).select(
        "host", F.explode("lines").alias("line"), "class_set"
    )
    return lines.distinct().groupBy("host", "line").agg(F.count("*").alias("n"))


def boilerplate_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, near: tuple[int, int] | None = None
) -> DataFrame:
    """host, lines (packed signed 64-bit hashes, ascending): the lines above the limit of each host.

    A null host is a host of its own. Hosts without such lines have no row.
    With ``near`` (words, percent) near copies count once, like equal texts.
    """

    def hashes(batch: pa.RecordBatch) -> dict:
        host, line, doc = [], [], []
        for h, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = text.as_py()
            own = {line_hash(x) for x in data.split(b"\n")} | {0}  # 0 counts the documents
            key = xxhash.xxh3_64_intdigest(data) & (1 << 63) - 1
            host.extend([h] * len(own))
            line.extend(own)
            doc.extend([key] * len(own))
        return {"host": host, "line": line, "doc": doc}

    rows = map_batches(
        docs.select(col("source").cast("string").alias("host"), utf8("text").alias("text")),
        hashes, "host string, line long, doc long",
    )
    counts = rows.distinct().groupBy("host", "line").agg(F.count("*").alias("n"))
    counts = landed(counts.filter((F.col("line") == 0) | (F.col("n") > min_docs)), "line-counts")
    totals = counts.filter("line = 0").select(F.col("host").alias("total_host"), F.col("n").alias("total"))

    def above(found: DataFrame) -> DataFrame:
        return found.filter((F.col("line") != 0) & (F.col("n") > min_docs)).join(
            sized_broadcast(totals), F.col("host").eqNullSafe(F.col("total_host"))
        ).filter(F.col("n") > F.col("total") * share)

    limits = _packed(above(counts))
    if near is None:
        return limits
    limits = landed(limits, "frequent-lines")
    return limits if limits.isEmpty() else _packed(above(_class_counts(docs, limits, near)))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(
    docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, keep_share: float = KEEP_SHARE,
    clean_text: bool = False, near: tuple[int, int] | None = None,
) -> DataFrame:
    """All columns of ``docs`` but the text, the measures and the verdicts of every row.

    Added: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (base
    measures of the whole text), removed_words (words in boilerplate lines),
    base_failed, kept; with ``clean_text`` also clean_text, the text without
    boilerplate lines (a text without any stays as it is; null stays null).
    Null text has no words and fails the base rules. Rows with equal ids are
    judged each on their own. Columns of ``docs`` with the same names give way
    to those added. ``near``: see ``boilerplate_lines``.
    """
    added = {*MEASURES, "removed_words", "base_failed", "kept", "clean_text"}
    carried = [c for c in docs.columns if c not in added]
    text, host, lines = (unused_name(docs, x) for x in ("text_", "host_", "lines_"))
    limits = landed(boilerplate_lines(docs, min_docs, share, near), "boilerplate")
    limits = limits.select(F.col("host").alias(host), F.col("lines").alias(lines))
    rows = docs.select(*[col(c) for c in carried]).join(
        sized_broadcast(limits), col("source").cast("string").eqNullSafe(col(host)), "left"
    )
    kept_columns = [c for c in carried if c != "text"]
    rows = rows.select(*[col(c) for c in kept_columns], col("text").cast("binary").alias(text), col(lines))
    schema = rows.drop(text, lines).schema
    for name in (*MEASURES, "removed_words"):
        schema = schema.add(name, "long")
    schema = schema.add("base_failed", "boolean").add("kept", "boolean")
    if clean_text:
        schema = schema.add("clean_text", "string")
    n = len(kept_columns)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in arrow}
            for value, packed in zip(batch.column(n), batch.column(n + 1), strict=True):
                data, limit = value.as_py(), packed.as_py()
                body = data or b""
                m = base_measures(body)
                removed, kept_lines = 0, None
                if limit:
                    above = set(np.frombuffer(limit, ">i8").tolist())
                    parts = body.split(b"\n")
                    drop = [line_hash(x) in above for x in parts]
                    if any(drop):
                        removed = sum(len(x.split()) for x, d in zip(parts, drop, strict=True) if d)
                        kept_lines = b"\n".join(x for x, d in zip(parts, drop, strict=True) if not d)
                failed = m["n_words"] < MIN_WORDS or 100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"]
                for name in MEASURES:
                    out[name].append(m[name])
                out["removed_words"].append(removed)
                out["base_failed"].append(failed)
                out["kept"].append(not failed and m["n_words"] - removed >= keep_share * m["n_words"])
                if clean_text:
                    clean = data if kept_lines is None else kept_lines
                    out["clean_text"].append(None if clean is None else clean.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(n)]
                + [pa.array(out[f.name], f.type) for f in list(arrow)[n:]], schema=arrow,
            )

    return rows.mapInArrow(run, schema)

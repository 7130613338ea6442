"""Certified packing: exact optimum on small cases, contract on edge cases, gain by repacking."""

import random
import zlib
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalbox.llm import certified_packing as C
from signalbox.llm.token_ids import PieceEncoder, vocabulary_path

VOCABULARY = vocabulary_path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, item string, size int, part string, round int, length string"


def optimum(sizes, window):
    """Fewest sequences, by trying every sequence for the largest item first."""
    sizes = tuple(sorted(sizes, reverse=True))

    @cache
    def fits(i, rooms):
        if i == len(sizes):
            return True
        return any(
            r >= sizes[i] and (j == 0 or rooms[j - 1] != r)
            and fits(i + 1, tuple(sorted((*rooms[:j], r - sizes[i], *rooms[j + 1 :]))))
            for j, r in enumerate(rooms)
        )

    k = -(-sum(sizes) // window)
    while not fits(0, (window,) * k):
        k += 1
    return k


def test_bounds_hold_and_best_fit_is_valid():
    rng = random.Random(7)
    tight = 0
    for _ in range(400):
        window = rng.choice([7, 10, 20, 33])
        sizes = [rng.randint(1, window) for _ in range(rng.randint(0, 9))]
        best = optimum(sizes, window)
        bound = C.lower_bound(np.bincount(np.array(sizes, int), minlength=window + 1), window)
        assert bound <= best
        tight += bound == best
        falling = -np.sort(-np.array(sizes, np.int64))
        where = C.best_fit_decreasing(falling, window)
        fill = np.bincount(where, weights=falling) if len(sizes) else np.zeros(0)
        assert (fill <= window).all() and len(fill) >= best
    assert tight > 350
    # The functions beat the plain volume bound.
    assert C.lower_bound(np.bincount([6] * 5, minlength=11), 10) == 5
    assert C.lower_bound(np.bincount([4] * 9, minlength=12), 11) == 5


def whole_ids(texts):
    library = PieceEncoder(VOCABULARY).library
    return [np.array([*library.encode(t or "", add_special_tokens=False).ids, C.END], "<u4") for t in texts]


def documents(seed=2, n=150):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéßΣ") for _ in range(rng.randint(1, 7)))
    texts = [None, "", " \n", "a", "İ, Σ. É, end.\nNext line, too.", "a" * 3000, "word " * 3000]
    texts += [" ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(n)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(None, "null id"), (4, "again"), (4, "again")]


@pytest.mark.parametrize("part_items", [10, 50_000])
def test_every_id_lies_in_one_piece(spark, part_items):
    rows, window = documents(), 128
    df = spark.createDataFrame([(*r, "x", 1, "y", 2, "z") for r in rows], SCHEMA)
    got = C.pack(df, VOCABULARY, window=window, part_items=part_items).collect()
    by_doc, sequences = {}, {}
    for p in got:
        by_doc.setdefault(p.doc_id, []).append(p)
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert 0 < at <= window
    expected = {}
    for (doc_id, _), ids in zip(rows, whole_ids([t for _, t in rows]), strict=True):
        for number, at in enumerate(range(0, len(ids), window)):
            part = ids[at : at + window]
            expected.setdefault(doc_id, []).append((number, at, len(part), zlib.crc32(part.tobytes())))
    assert {d: sorted((p.piece, p.start, p.length, p.ids_crc32) for p in ps) for d, ps in by_doc.items()} == {
        d: sorted(ps) for d, ps in expected.items()}
    counts = np.bincount([p.length for p in got], minlength=window + 1)
    assert C.lower_bound(counts, window) <= len(sequences) <= C.lower_bound(counts, window) + (3 if part_items > 10 else 12)


def test_repacking_needs_fewer_sequences(spark):
    """Small partitions have gaps; exchanging documents between them closes most."""
    df = spark.createDataFrame([(*r, "x", 1, "y", 2, "z") for r in documents(5, 700)], SCHEMA)
    used = [
        C.pack(df, VOCABULARY, window=256, part_items=12, rounds=rounds).select("sequence_id").distinct().count()
        for rounds in (1, 8)
    ]
    assert used[1] < used[0]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.pack(empty, VOCABULARY).collect() == []
    whole = spark.createDataFrame([(1, "a " * 2047, "x", 1, "y", 2, "z")], SCHEMA)
    assert [tuple(r) for r in C.pack(whole, VOCABULARY).select("start", "length", "offset").collect()] == [(0, 2048, 0)]


def test_query_is_near_its_bound(spark):
    from signalbox.llm import queries as Q

    packed = Q.op13_certified_packing(spark, "/root/testdata/sf0.01").cache()
    counts = np.zeros(C.WINDOW + 1, int)
    for r in packed.groupBy("length").count().collect():
        counts[r.length] = r["count"]
    used = packed.select("sequence_id").distinct().count()
    over = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m"))
    assert over.filter((F.col("n") > C.WINDOW) | (F.col("n") != F.col("m"))).count() == 0
    assert used <= C.lower_bound(counts, C.WINDOW) * 1.005 + 1

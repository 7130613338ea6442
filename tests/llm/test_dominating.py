"""Documents that dominate their source, in the mix."""

import random

import numpy as np
import pytest

from signalbox.llm import cube_mix as M


def _mixed(spark, sizes_of: dict[str | None, list[int]], seed=0):
    rows, at = [], 0
    for source, sizes in sizes_of.items():
        for n in sizes:
            rows.append((at, " ".join(["w"] * n), source))
            at += 1
    random.Random(seed).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return docs, M.mix(docs).collect()


def test_the_others_make_up_for_dominating_documents(spark):
    rng = random.Random(9)
    short = lambda n: [rng.randint(20, 80) for _ in range(n)]
    sources = {"a": short(3000) + [20_000], "b": short(3000) + [100_000, 60_000], "c": short(1500) + [9_000] * 4, None: short(400)}
    docs, got = _mixed(spark, sources)
    taken, target = {}, {}
    for r in got:
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 2 * r.size
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
        target[r.source_size] = r.target
    assert len(taken) == 4
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.01 * t, (s, t, taken[s])
    assert sorted(map(repr, got)) == sorted(map(repr, M.mix(docs.repartition(5)).collect()))


@pytest.mark.parametrize("prob", [0.07, 0.43, 0.5, 0.9])
def test_decisions_can_be_made_up_for(prob):
    for seed in range(40):
        size = np.array([20_000, 5_000, 5_000, 900])
        total = int(size.sum()) + 150_000
        taken = (size * M.decide(size, prob, total, ("s",), seed)).sum()
        assert 0 <= prob * total - taken <= 150_000
    # One document is nearly all of the source: the choice that comes closer.
    for seed in range(20):
        assert M.decide(np.array([1000]), 0.3, 1010, ("s",), seed).tolist() == [0.0]
        assert M.decide(np.array([1000]), 0.8, 1010, ("s",), seed).tolist() == [1.0]


def test_dominating_documents_keep_their_probability():
    size, total = np.array([20_000]), 170_000
    chosen = [M.decide(size, 0.43, total, ("s",), seed)[0] for seed in range(2000)]
    assert np.mean(chosen) == pytest.approx(0.43, abs=0.04)


def test_a_source_of_one_document_and_of_empty_ones(spark):
    _, got = _mixed(spark, {"a": [500], "b": [0, 0, 0], "c": [0] * 30 + [700]})
    assert len(got) == 35
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)

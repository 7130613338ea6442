"""Broadcasts are bounded by bytes, and joins beyond the bound give the same rows."""

import random

from pyspark.sql import functions as F

from signalbox.llm import common
from signalbox.llm import line_quality as Q
from tests.llm.test_operators import docs_frame


def _hinted(df):
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()


def test_long_values_are_not_broadcast(spark):
    short = spark.range(100).select("id", F.array(F.lit("x"), F.lit(None).cast("string")).alias("v"))
    assert common.rows_and_bytes(short) == (100, 100 * (8 + 8 + 9 + 8))
    assert _hinted(common.sized_broadcast(short))
    long = spark.range(70).select("id", F.array(F.repeat(F.lit("x"), F.lit(1 << 20))).alias("v"))
    assert not _hinted(common.sized_broadcast(long))


def test_judge_is_the_same_beyond_the_bound(spark, monkeypatch):
    rng = random.Random(33)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    menu = prose(6)
    rows = [(i, f"{prose(60)}\n{menu}", rng.choice(["a", "b", None])) for i in range(90)]
    docs = docs_frame(spark, rows)
    want = sorted(map(repr, Q.judge(docs, clean_text=True).collect()))
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    assert sorted(map(repr, Q.judge(docs, clean_text=True).collect())) == want
    assert sum("removed_words=6" in r for r in want) == 90

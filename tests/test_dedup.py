import random

from hypothesis import given, settings, strategies as st

from signalbox.operators import dedup
from tests.conftest import rows
from tests.helpers import movement_table, cancellation_table


def _mv(train="T1", stanox="00001", status="LATE", delay=60.0, planned=0, actual=60_000, name="N"):
    return (train, stanox, "TPL", "AAA", name, "ARRIVAL", planned, actual, status, delay)


def test_exact_copies_collapse(spark):
    df = movement_table(spark, [_mv(), _mv(), _mv(), _mv(train="T2")])
    assert dedup.dedup_movements(df).count() == 2
    assert dedup.dedup_movements_on_write(df).count() == 2


def test_copies_differing_only_in_status(spark):
    df = movement_table(spark, [_mv(status="LATE"), _mv(status="late")])
    # write-time key ignores the status; read-time key includes it
    assert rows(dedup.dedup_movements_on_write(df).select("variation_status")) == [("LATE",)]
    assert dedup.dedup_movements(df).count() == 2


def test_null_key_parts_are_equal(spark):
    df = movement_table(spark, [_mv(train=None, stanox=None), _mv(train=None, stanox=None), _mv(train=None)])
    assert dedup.dedup_movements(df).count() == 2


def test_keep_first_prefers_order_then_columns(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "z"), ("k", 1, "a"), ("j", None, "q")],
                               "k string, o int, v string")
    from pyspark.sql import functions as F

    out = dedup.keep_first(df, ["k"], [F.col("o")])
    assert rows(out) == [("j", None, "q"), ("k", 1, "a")]


def test_cancellation_keys(spark):
    base = ("T1", "S1", "1", "00001", "TPL", "AAA", "N", 5, "R1", "AT ORIGIN")
    other_reason = base[:8] + ("R2",) + base[9:]
    df = cancellation_table(spark, [base, base, other_reason])
    assert dedup.dedup_cancellations_on_write(df).count() == 1  # reason not in write key
    assert dedup.dedup_cancellations(df).count() == 2  # reason in read key


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["T1", "T2", None]), st.sampled_from(["LATE", "EARLY"]),
                          st.integers(0, 3)), min_size=1, max_size=25),
       st.integers(0, 1000))
def test_dedup_is_idempotent_and_order_independent(spark, items, seed):
    data = [_mv(train=t, status=s, actual=a * 1000, delay=float(a)) for t, s, a in items]
    shuffled = data[:]
    random.Random(seed).shuffle(shuffled)
    a = dedup.dedup_movements(movement_table(spark, data))
    b = dedup.dedup_movements(movement_table(spark, shuffled).repartition(3))
    assert rows(a) == rows(b)
    assert rows(dedup.dedup_movements(a)) == rows(a)
    assert a.count() == len(set(data))


def test_missing_key_column_is_an_error(spark):
    import pytest

    df = movement_table(spark, [])
    for call in (dedup.dedup_movements, dedup.dedup_movements_on_write):
        with pytest.raises(ValueError, match="planned_timestamp"):
            call(df.drop("planned_timestamp"))

"""The cascade of time buckets equals the plain series, in parts and in batches."""

import os
import random

from signalbox.operators import rollup as R
from signalbox.operators import stats
from signalbox.operators import timeseries as ts
from signalbox.operators import transforms as tf
from signalbox.sinks.writers import ParquetFactSink
from signalbox.streaming.clean import IncrementalClean
from signalbox.streaming.rollup import RollupStep, read_rollup
from tests.conftest import rows
from tests.helpers import T0, cancellation_table, movement_table


def _facts(seed, n=300):
    rng = random.Random(seed)
    mv = [(f"T{i}", "1", "TPL", "AAA", rng.choice(["hot", "hot", "b", None]), "ARRIVAL", T0,
           rng.choice([None, T0 + rng.randint(0, 300_000_000)]), rng.choice(["LATE", "late", "EARLY", None]),
           rng.choice([None, rng.randint(-9000, 90_000) / 1000.0])) for i in range(n)]
    cx = [(f"T{i}", "S", "1", "1", "TPL", "AAA", rng.choice(["hot", "b", None]),
           rng.choice([None, T0 + rng.randint(0, 300_000_000)]), "R", "X") for i in range(n)]
    return mv, cx


def test_rates_follow_from_the_partials(spark):
    mv, cx = (t for t in _facts(1))
    mv, cx = movement_table(spark, mv), cancellation_table(spark, cx)
    partials = R.bucket_partials(mv, cx).cache()
    timed = tf.with_event_time(mv, "actual_timestamp")
    for duration in ("10 minutes", "1 hour", "1 day"):
        late = ts.count_by_time(stats.late_movements(timed), "actual_timestamp", "n", duration)
        assert rows(R.count_over_time(partials, "late", duration, "actual_timestamp", "n")) == rows(late)
        events = ts.window_events(mv, cx).filter("event_time IS NOT NULL")
        plain, rolled = ts.station_window_stats(events, duration), R.window_stats(partials, duration)
        key = ["window_start", "window_end", "station", "event_count", "cancellation_count"]
        assert rows(plain.select(*key)) == rows(rolled.select(*key))
        means = [dict(((r.window_start, r.station), r.avg_delay) for r in df.collect()) for df in (plain, rolled)]
        assert all((a is None) == (means[1][k] is None) and (a is None or abs(a - means[1][k]) < 1e-9)
                   for k, a in means[0].items())
    canx = tf.with_event_time(cx, "canx_timestamp")
    assert rows(R.count_over_time_filled(partials, "cancellations", "1 hour", "t", "n")) == rows(
        ts.count_by_time_filled(canx, "canx_timestamp", "n", "1 hour"))


def test_parts_add_up(spark):
    mv, cx = _facts(2)
    whole = R.bucket_partials(movement_table(spark, mv), cancellation_table(spark, cx))
    parts = [R.bucket_partials(movement_table(spark, mv[i::3]), cancellation_table(spark, cx[i::3])) for i in range(3)]
    assert rows(R.merge_partials(parts[2].unionByName(parts[0]).unionByName(parts[1]))) == rows(whole)
    hours = R.roll_up(whole, "1 hour")
    assert rows(R.roll_up(hours, "1 day")) == rows(R.roll_up(whole, "1 day"))
    assert R.bucket_partials(movement_table(spark, []), cancellation_table(spark, [])).count() == 0


def test_batches_with_replays_add_up(spark, tmp_dir):
    mv, cx = _facts(3, 120)
    sink = ParquetFactSink(os.path.join(tmp_dir, "facts"))
    clean = IncrementalClean(spark, sink, os.path.join(tmp_dir, "clean"))
    path = os.path.join(tmp_dir, "rollup")
    clean.then = RollupStep(spark, clean, path)
    for batch in range(3):
        again = slice(0, 20) if batch else slice(0)
        sink.write(movement_table(spark, mv[40 * batch:40 * batch + 40] + mv[again]),
                   cancellation_table(spark, cx[40 * batch:40 * batch + 40] + cx[again]), batch)
        clean(batch)
    want = rows(R.bucket_partials(clean.history("movements"), clean.history("cancellations")))
    assert sum(r[2] for r in want) > 60
    for first, last in ((2, 2), (1, 2), (0, 1)):  # ranges are worked on again after their marks were lost
        assert rows(read_rollup(spark, path)) == want
        clean.then.process(first, last)
    assert rows(read_rollup(spark, path)) == want

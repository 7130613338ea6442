"""Station outliers from the carried state: equal to a full run to the last digit, without its scan."""

import os
import random

from signalbox.operators import anomaly
from signalbox.sinks.writers import ParquetFactSink
from signalbox.streaming.clean import IncrementalClean, read_clean_table
from signalbox.streaming.outliers import OutlierState
from tests.conftest import rows
from tests.helpers import T0, cancellation_table, movement_table


def _mv(name, delay, train, at=0):
    return (train, "00001", "TPL", "AAA", name, "ARRIVAL", T0 + at, T0 + at, "LATE", delay)


class Feed:
    """Batches written to the fact tables and folded into the clean ones."""

    def __init__(self, spark, folder):
        self.spark = spark
        self.sink = ParquetFactSink(os.path.join(folder, "facts"))
        self.clean = IncrementalClean(spark, self.sink, os.path.join(folder, "clean"))
        self.state = OutlierState(spark, os.path.join(folder, "ab"), self.clean, station_bound=10)

    def write(self, batch_id, data):
        self.sink.write(movement_table(self.spark, data), cancellation_table(self.spark, []), batch_id)
        self.clean(batch_id)

    def full(self):
        history = read_clean_table(self.spark, self.clean.path("movements"), "movements")
        return anomaly.detect_station_delay_outliers(history)


def _batches(seed, n_batches=5, per_batch=70):
    """Skewed stations, delays that drift, missing values, replays of earlier rows."""
    rng = random.Random(seed)
    batches, old = [], []
    for b in range(n_batches):
        batch = []
        for i in range(per_batch):
            name = rng.choice(["hot", "hot", "hot", "b", "c", None])
            delay = rng.choice([None, rng.randint(-300_000, 400_000) / 1000.0,
                                rng.randint(0, 90_000) / 1000.0, rng.expovariate(1 / 300.0) * (3 if b == 0 else 1)])
            batch.append(_mv(name, delay, f"{b}-{i}", at=rng.randint(0, 3) * 86_400_000))
        batch += [_mv("const", 0.1, f"k{b}-{i}") for i in range(3)]
        if b % 2:
            batch.append(_mv("hot", 50_000.5, f"big{b}"))
        batches.append(batch + rng.sample(old, min(len(old), 10)))
        old += batch
    return batches


def test_state_equals_full_run_in_any_order(spark, tmp_dir):
    batches = _batches(1)
    results = []
    for order in (range(5), (3, 0, 4, 2, 1)):
        feed = Feed(spark, os.path.join(tmp_dir, str(len(results))))
        for number, b in enumerate(order):
            feed.write(number, batches[b])
            found = rows(feed.state.fold(number, number))
            assert found == rows(feed.full())  # every column, scores to the last digit
        results.append(found)
    # Replays differ in nothing here, so the order of arrival leaves no trace.
    assert results[0] == results[1] and len(results[0]) >= 2


def test_a_batch_reads_its_own_rows_and_the_state_only(spark, tmp_dir):
    rng = random.Random(3)
    feed = Feed(spark, tmp_dir)
    sizes = (400, 60, 30, 45)
    for number, size in enumerate(sizes):
        feed.write(number, [_mv(f"s{i % 3}", rng.gauss(60, 20), f"{number}-{i}") for i in range(size)]
                   + [_mv("s1", 60 + 300.0 + number, f"o{number}")])
        found = rows(feed.state.fold(number, number))
        assert feed.state.rows_read == {"added": size + 1, "history": 0}
        assert found == rows(feed.full()) and len(found) == number + 1
    tail = spark.read.parquet(feed.state.tail_path)
    assert tail.filter("batch_id > 0").count() < 0.2 * sum(sizes[1:])  # later batches leave their high delays only
    # The history can even be out of reach.
    os.rename(feed.clean.path("movements"), feed.clean.path("movements") + "-old")
    feed.sink.write(movement_table(spark, [_mv("s2", 62.0, "new")]), cancellation_table(spark, []), 4)
    feed.clean(4)
    again = rows(feed.state.fold(4, 4))
    assert len(again) == len(found)


def test_a_falling_limit_reads_the_rows_between(spark, tmp_dir):
    feed = Feed(spark, tmp_dir)
    wide = [_mv("a", float(d), f"w{i}") for i, d in enumerate([0, 900] * 20 + [1200, 1500])]
    feed.write(0, wide)
    assert rows(feed.state.fold(0, 0)) == rows(feed.full()) == []
    reads = []
    for number in range(1, 5):
        feed.write(number, [_mv("a", 5.0 + i % 2, f"n{number}-{i}") for i in range(400 * number)])
        found = rows(feed.state.fold(number, number))
        assert found == rows(feed.full())
        reads.append(feed.state.rows_read["history"])
    assert found and any(reads)  # old rows became outliers


def test_a_range_worked_on_again_gives_the_same(spark, tmp_dir):
    feed = Feed(spark, tmp_dir)
    batches = _batches(8, 4)
    for number, batch in enumerate(batches):
        feed.write(number, batch)
    feed.state.fold(0, 0)
    feed.state.fold(1, 2)
    feed.state.fold(1, 2)  # the progress mark was lost
    feed.state.fold(1, 3)
    assert rows(feed.state.fold(1, 3)) == rows(feed.full())
    stats = anomaly.stats_of_moments(feed.state.state.read(3).drop("mark")).select("local_name", "n", "mean", "std")
    history = read_clean_table(spark, feed.clean.path("movements"), "movements")
    assert rows(stats) == rows(anomaly.station_delay_stats(history).select("local_name", "n", "mean", "std"))

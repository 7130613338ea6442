"""The mix of the pipeline, where the splits of its input change between two scans."""

import random

from signalbox.llm import cube_mix as M
from signalbox.llm.common import fresh_path


def test_mixed_rows_do_not_follow_the_splits(spark):
    rng = random.Random(32)
    rows = [(i, " ".join(["w"] * rng.randint(1, 60)), rng.choice("abc")) for i in range(400)]
    path = fresh_path(spark, "split-docs")
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8).write.parquet(path)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    held = {n: spark.conf.get(n) for n in names}

    def mixed():
        return M.mixed_rows(spark.read.parquet(path))

    want = sorted(map(tuple, mixed().collect()))
    try:
        late = mixed()  # sizes and choice are made here, the rows are read after the change
        for n in names:
            spark.conf.set(n, "2k")
        got = sorted(map(tuple, late.collect()))
    finally:
        for n, v in held.items():
            spark.conf.set(n, v)
    assert got == want

"""A corpus pipeline over ``documents``: quality, near duplicates, secrets, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbox.llm import cube_mix, jaccard_join, line_quality, packing, secret_forest
from signalbox.llm.common import col, landed, small_batches, table
from signalbox.llm.token_ids import vocabulary_path

# Near duplicates: shingles of five words, similarity of 80 % or more.
WORDS, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines leave the texts; rejected documents go. Near copies count a line once."""
    small_batches(spark)
    other = {c: f"c{i}" for i, c in enumerate(docs.columns) if c not in ("text", "source")}
    plain = docs.select(*[col(c).alias(other.get(c, c)) for c in docs.columns])
    kept = line_quality.judge(plain, clean_text=True, near=(WORDS, PERCENT)).filter("kept")
    changed = F.col("removed_words") > 0

    def out(name: str):
        if name == "text":
            return F.col("clean_text").alias("text")
        if name == "n_chars":
            length = F.when(changed, F.length("clean_text")).otherwise(F.col(other[name]))
            return length.cast(docs.schema[name].dataType).alias(name)
        return F.col(other.get(name, name)).alias(name)

    return kept.select(*[out(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, that of the smallest id (null last).

    Null, empty and wordless texts all stay; repeated rows (equal id and text)
    are one row. Postings may miss a link of long texts with a chance of
    1e-15, the order of a collision of the 64-bit hashes.
    """
    small_batches(spark)
    return jaccard_join.one_per_class(docs, WORDS, PERCENT, miss=jaccard_join.RARE_MISS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    small_batches(spark)
    return secret_forest.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    small_batches(spark)
    return cube_mix.mixed_rows(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed token sequences."""
    small_batches(spark)
    return packing.pack(docs, vocabulary_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("pack_windows", pack_windows),
]

# SQL expresses neither the forest nor the mix; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""A group of near copies in one source keeps a representative through quality rules and near duplicates."""

import random

import corpus_pipeline
from signalbox.llm import line_quality as Q
from tests.conftest import SF_SMALL


def test_one_near_copy_survives_both_stages(spark):
    rng = random.Random(31)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    clean = [prose(12) for _ in range(20)]
    menu = [prose(5) for _ in range(4)]
    rows = []
    for i in range(60):  # another word at the end of one line each
        own = list(clean)
        own[i % 20] += f" {prose(1)}"
        rows.append((i, "\n".join(own), "hot"))
    rows += [(100 + i, "\n".join([prose(60), *menu]), "hot") for i in range(40)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.quality_rules(spark, docs, SF_SMALL)
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert set(texts) == {i for i, _, _ in rows}
    assert all(texts[i] == t for i, t, _ in rows if i < 60)  # no line of theirs is boilerplate
    assert all(m not in texts[i] for i in range(100, 140) for m in menu)  # the menu still is
    left = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, kept, SF_SMALL).collect()}
    assert left == {0} | set(range(100, 140))
    # The query's own rule, that of its SQL, counts distinct texts.
    plain = {r.doc_id: r.kept for r in Q.judge(docs).collect()}
    assert not any(plain[i] for i in range(60)) and all(plain[i] for i in range(100, 140))

"""Merkle manifest against a plain construction of the trees."""

import hashlib
import random
import zlib

import pytest

from signalbox.llm import merkle as M
from signalbox.llm import queries as Q

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree int, place string, carry long, level int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(doc_id, text, lang, source, n_chars):
    return h(*map(field, (doc_id, source, lang, n_chars, text)))


def grown(level):
    """Root and, per leaf, the (left, right) siblings up to it."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for path, i in zip(paths, at, strict=True):
            run = i - i % 3
            path.append((level[run:i], level[i + 1 : run + 3]))
        level = [h(*level[i : i + 3]) for i in range(0, len(level), 3)]
        at = [i // 3 for i in at]
    return level[0], paths


def expected(rows):
    """Sorted (doc_id, leaf, subroot, root, proof digest, folded root)."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf_of(*r), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        by_source[name].sort(key=lambda x: x[:3])
        trees[name] = grown([x[2] for x in by_source[name]])
    root, tops = grown([trees[n][0] for n in names])
    out = []
    for name, top in zip(names, tops, strict=True):
        subroot, paths = trees[name]
        for (_, _, leaf, r), path in zip(by_source[name], paths, strict=True):
            doc_id, text, *rest = r
            start = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text is not None:
                start = leaf_of(doc_id, text.replace("\n", ""), *rest)
            proof = ""
            for left, right in path + top:
                start = h(*left, start, *right)
                proof += "".join(left + right)
            out.append((doc_id, leaf, subroot, root, h(proof), start, start == root))
    return sorted(out, key=str)


def some_rows(sizes, seed=1):
    rng, rows = random.Random(seed), []
    for source, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "plain", "two\nlines", "\n", "é中\n" * 3, "long\n" * 2000])
            rows.append((rng.choice([None, rng.randint(-3, 40_000)]) if n < 50 else rng.randint(0, 9000), text,
                         rng.choice([None, "en", "fr"]), source, rng.choice([None, 0, 17])))
    return rows


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {None: 1, "a": 3}, {"é": 4, "z": 27, "Z": 28, None: 9, "": 2}, {"hot": 2300, "b": 2, "c": 1, None: 731},
    {f"s{i}": 1 + i % 4 for i in range(40)},
])
def test_manifest_equals_plain_trees(spark, tmp_path, sizes):
    rows = some_rows(sizes)
    rows += rows[:2]  # equal rows are leaves of their own
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in Q.op12_merkle_manifest(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == expected(rows)


def test_upper_segments_are_shared_in_chunks(spark, monkeypatch):
    """A source of many chunks joins its upper segment chunk by chunk, without losing a leaf."""
    monkeypatch.setattr(M, "CHUNK", 7)
    rows = [(i, "t\n", "en", f"s{i % 2}", i) for i in range(100)]
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)
    got = {r.doc_id: r for r in M.manifest(df).collect()}
    assert len(got) == 100
    for doc_id, leaf, subroot, root, proof, *_ in expected(rows):
        r = got[doc_id]
        path = [(bytes(s.left), bytes(s.right)) for s in r.proof]
        assert (r.leaf, r.subroot, r.root) == (leaf, subroot, root)
        assert h("".join(a.hex() + b.hex() for a, b in path)) == proof


def test_empty_table(spark):
    assert M.manifest(spark.createDataFrame([], SCHEMA)).collect() == []

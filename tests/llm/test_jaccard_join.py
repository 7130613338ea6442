import random

import numpy as np
import pytest

from signalbox.llm import jaccard_join as J
from signalbox.llm.components import components


def _similar(rng, size, percent, universe):
    """A random pair just above the similarity: equal sizes or a subset, spread differences."""
    base = rng.sample(universe, size)
    both = size
    drop = rng.randint(0, max(0, size * (100 - percent) // 100))
    a = set(base[: size - drop // 2])
    b = set(base[drop - drop // 2 :])
    extra = rng.sample(universe, 3)
    if rng.random() < 0.5:
        b |= set(extra[: rng.randint(0, 3)])
    inter, union = len(a & b), len(a | b)
    del both
    return a, b, union and 100 * inter >= percent * union


@pytest.mark.parametrize("percent", [50, 60, 80, 90, 95])
def test_similar_sets_share_a_posting(percent):
    rng = random.Random(percent)
    universe = [rng.getrandbits(64) for _ in range(5000)]
    bands, seen = J.Bands(percent), 0
    for _ in range(3000):
        a, b, linked = _similar(rng, rng.choice([1, 2, 3, 5, 8, 9, 10, 12, 17, 30, 60, 200, 700]), percent, universe)
        if not (linked and a and b):
            continue
        seen += 1
        keys = [set(J.postings(np.array(sorted(x), np.uint64), bands).tolist()) for x in (a, b)]
        assert keys[0] & keys[1], (len(a), len(b))
    assert seen > 500


def _inside(rng, j, m):
    """A number of segment ``j`` of ``m``."""
    return (((j << 32) // m + 1 + rng.getrandbits(16)) << 32) | rng.getrandbits(32)


@pytest.mark.parametrize("percent", [80, 90])
def test_pairs_that_agree_in_empty_segments_only_share_a_posting(percent):
    """Every segment differs but for the empty ones, in as many elements as similar sets may."""
    rng, bands = random.Random(percent), J.Bands(percent)
    checked, thin = 0, 0
    for _ in range(30_000):
        size = rng.randint(8, 60) if rng.random() < 0.8 else rng.randint(60, 400)
        k = bands.band(size)
        twos, m = bands.allocation(k)
        if twos or m < 3 or bands.ends[k] < 3 * m:
            continue
        empty = set(rng.sample(range(m), rng.randint(1, m - 1)))
        full = [j for j in range(m) if j not in empty]
        few = set(rng.sample(full, rng.randint(0, len(full) - 1)))  # empty in one, one element in the other
        many = [j for j in full if j not in few]
        a = {_inside(rng, rng.choice(many), m) for _ in range(size)}
        b = set(a)
        for j in few:
            (a if rng.random() < 0.5 else b).add(_inside(rng, j, m))
        changes = many + rng.choices(many, k=max(0, bands.differences(k) - len(full)))
        for j in changes:
            own = [x for x in b & a if (x >> 32) * m >> 32 == j]
            if own and rng.random() < 0.5:
                b.discard(rng.choice(own))
            else:
                (a if rng.random() < 0.5 else b).add(_inside(rng, j, m))
        if not a or not b or 100 * len(a & b) < percent * len(a | b):
            continue
        checked += 1
        thin += 2 * len(empty) + len(few) > m
        keys = [set(J.postings(np.array(sorted(x), np.uint64), bands).tolist()) for x in (a, b)]
        assert keys[0] & keys[1], (len(a), len(b), m, empty)
    assert checked > 1000 and thin > 100


@pytest.mark.parametrize("miss", [0.0, J.RARE_MISS])
@pytest.mark.parametrize("percent", [80, 90])
def test_large_similar_sets_share_a_posting(percent, miss):
    """As different as similar sets may be, at every place of their size band."""
    rng, bands = np.random.default_rng(percent), J.Bands(percent, miss)
    for size in [366, 718, 1500, 1501, 2000, 2400, 3000] * 12:
        every = rng.integers(0, 1 << 64, 2 * size, dtype=np.uint64)
        inter = int(np.ceil(size * percent / 100)) if rng.random() < 0.5 else int(np.ceil(2 * size * percent / (100 + percent)))
        a, b = every[:size], np.concatenate([every[:inter], every[size : size + (size - inter)]])
        if rng.random() < 0.5:
            b = every[:inter]
        if 100 * inter < percent * (len(a) + len(b) - inter):
            continue
        keys = [set(J.postings(np.unique(x), bands).tolist()) for x in (a, b)]
        assert keys[0] & keys[1], (len(a), len(b))


@pytest.mark.parametrize("percent", [80, 90])
def test_postings_are_bounded_whatever_the_hashes_are(percent):
    rng, bands = np.random.default_rng(5), J.Bands(percent)
    for size in (9, 40, 200, 2000):
        for spread in (1 << 64, 1 << 63, 1 << 60, 1 << 33, 1 << 20):
            s = np.unique(rng.integers(0, spread, size, dtype=np.uint64))
            most = sum(4 * (len(s) + 3 * sum(bands.allocation(k))) for k in bands.spaces(len(s)))
            assert 0 < len(J.postings(s, bands)) <= most


def test_words_are_hashed_alike_wherever_they_stand(monkeypatch):
    words = [b"a", b"A", b"ab", b"ba", b"\xc3\xa9t\xc3\xa9", b"x" * 64, b"x" * 65, b"x" * 300, b"AB", b"Z" * 70, b"z" * 70]
    alone = [J.word_hashes(w) for w in words]
    assert all(len(h) == 1 for h in alone)
    lower = [w.lower() for w in words]
    for i, x in enumerate(lower):
        for j, y in enumerate(lower):
            assert (alone[i][0] == alone[j][0]) == (x == y)
    rng = random.Random(6)
    for piece in (J.PIECE, 200, J.LONG_WORD):
        monkeypatch.setattr(J, "PIECE", piece)
        J._byte_values.cache_clear()
        for _ in range(200):
            order = [rng.randrange(len(words)) for _ in range(rng.randint(0, 60))]
            gaps = [bytes(rng.choices(b" \t\n\x0b\x0c\r", k=rng.randint(1, 3))) for _ in range(len(order) + 1)]
            text = gaps[0] + b"".join(words[i] + g for i, g in zip(order, gaps[1:], strict=True))
            if rng.random() < 0.5:
                text = text.strip()
            assert J.word_hashes(text).tolist() == [alone[i][0] for i in order]
    monkeypatch.undo()
    J._byte_values.cache_clear()


def test_bands_cover_every_similar_size():
    for percent in (50, 80, 90):
        bands = J.Bands(percent)
        for r in range(1, 400):
            for s in range(r, bands.largest(r) + 1):
                assert set(bands.spaces(r)) & set(bands.spaces(s)), (percent, r, s)
                k = max(set(bands.spaces(r)) & set(bands.spaces(s)))
                assert (r + s) * (100 - percent) // (100 + percent) <= bands.differences(k)


def test_links_matrix_equals_sets():
    rng = random.Random(1)
    sets = [np.array(sorted(rng.sample(range(1, 60), rng.randint(1, 40))), np.uint64) for _ in range(60)]
    got = J.links(sets, 50)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            x, y = set(a.tolist()), set(b.tolist())
            assert got[i, j] == (i != j and 100 * len(x & y) >= 50 * len(x | y))


def test_components_of_a_path_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (500, 500)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 1 for i in range(1, 41))
    assert all(got[i] == 100 for i in range(100, 130))
    assert got[500] == 500
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_equal_brute_force(spark):
    rng = random.Random(31)
    edges = [(i, i + 1) for i in range(-300, 300)] + [(5_000, i) for i in range(4_000, 4_400)]  # a path, a hub
    edges += [(rng.randrange(10_000, 10_400), rng.randrange(10_000, 10_400)) for _ in range(260)]
    edges += [(-(2**63), 2**63 - 1), (7_777, 7_777), (9_000, 9_001), (9_001, 9_000), (9_000, 9_001)]
    root = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for u, v in edges:
            low = min(root[u], root[v])
            changed |= root[u] != low or root[v] != low
            root[u] = root[v] = low
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert len(got) == len(root) and {r.node: r.label for r in got} == root


def _brute(rows, words, percent):
    sets = []
    for _, text in rows:
        w = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
        grams = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
        sets.append(grams)
    n = len(rows)
    linked = [[i != j and bool(sets[i]) and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) for j in range(n)] for i in range(n)]
    out = []
    for i in range(n):
        reach, todo = {i}, [i]
        while todo:
            x = todo.pop()
            for y in range(n):
                if linked[x][y] and y not in reach:
                    reach.add(y)
                    todo.append(y)
        ids = [rows[j][0] for j in reach if rows[j][0] is not None]
        out.append((rows[i][0], len(sets[i]), min(ids, default=None), sum(linked[i])))
    return sorted(out, key=repr)


def _texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    rows = []
    for i in range(60):
        base = [word() for _ in range(rng.choice([1, 2, 3, 6, 20, 60, 150]))]
        rows.append((i, " ".join(base)))
        for c in range(rng.choice([0, 0, 1, 4])):
            own = list(base)
            for _ in range(rng.choice([0, 1, 2, 3])):
                own[rng.randrange(len(own))] = word()
            rows.append((1000 + 10 * i + c, " ".join(own).upper() if rng.random() < 0.2 else "\n".join(own)))
    return rows + [(5000, None), (5001, ""), (5002, " \t "), (5003, "x" * 100_000), (None, rows[0][1]), (rows[3][0], rows[3][1])]


@pytest.mark.parametrize(("words", "percent", "block"), [(3, 90, 512), (5, 80, 3), (2, 50, 512)])
def test_near_duplicates_equal_brute_force(spark, words, percent, block):
    rows = _texts(words)
    docs = spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "doc_id long, text string, set_id string, n_links int")
    got = J.link_classes(docs, words, percent, block)
    assert got.count() == len(rows)
    got = J.near_duplicates(docs, words, percent).collect()
    assert sorted([tuple(r) for r in got], key=repr) == _brute(rows, words, percent)


def test_one_row_of_each_class_stays(spark):
    rows = _texts(9)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in J.one_per_class(docs, 3, 90).collect()]
    brute = _brute(rows, 3, 90)
    empties = [r for r in rows if not (r[1] or "").split()]
    classes = {c for i, n, c, _ in brute if n}
    assert len(kept) == len(classes) + len(empties)
    assert {i for i, t in kept if (t or "").split()} == classes
    assert J.one_per_class(docs.limit(0), 3, 90).count() == 0


def test_links_between_two_blocks_equal_sets():
    rng = random.Random(2)
    sets = [np.array(sorted(rng.sample(range(1, 60), rng.randint(1, 40))), np.uint64) for _ in range(50)]
    want = J.links(sets, 50)
    for columns in (1, 7, 2048):
        assert np.array_equal(J.links_between(sets[:20], sets[20:], 50, columns), want[:20, 20:])
    left, right = np.arange(0, 50, 2), np.arange(1, 50, 2)
    linked = want[np.ix_(left, right)]
    reach = {i: {i} for i in range(50)}
    for _ in range(50):
        for a, i in enumerate(left):
            for b, j in enumerate(right):
                if linked[a, b]:
                    reach[i] = reach[j] = reach[i] | reach[j]
    assert J.smallest_reached(linked, left, right, 50).tolist() == [min(reach[i]) for i in range(50)]


@pytest.mark.parametrize("bound", [{"block_sets": 3}, {"block_shingles": 400}])
def test_links_do_not_depend_on_the_blocks(spark, bound):
    rows = _texts(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = J.link_classes(docs, 5, 80, **bound).collect()
    least = {}
    for r in got:
        if r.doc_id is not None and r.class_set is not None:
            least[r.class_set] = min(least.get(r.class_set, r.doc_id), r.doc_id)
    found = [(r.doc_id, r.n_shingles, least.get(r.class_set, r.doc_id), r.n_links) for r in got]
    assert sorted(found, key=repr) == _brute(rows, 5, 80)


def test_pairs_of_a_shared_passage_are_verified_by_lists_not_by_closures(spark):
    """600 different documents around one passage: units stay lists of pairs that share a posting; links are exact."""
    rng = random.Random(41)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join(passage + [f"w{rng.getrandbits(40)}" for _ in range(80)])) for i in range(600)]
    near = passage + [f"n{i}" for i in range(80)]
    for i in range(60):  # near copies of one text that holds the passage too
        words = list(near)
        words[rng.randrange(45, 115)] = f"e{i}"
        rows.append((5000 + i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = J.landed(J._sets(docs, 5, 80, 0.0), "test-sets")
    units = J._units(J.landed(J._shared_postings(sets), "test-shared")).collect()
    lists = {}
    for u in units:
        lists.setdefault((u.unit, u.across), []).append(u)
    assert any(across for _, across in lists)
    compared = sum(len(x) ** 2 for x in lists.values())
    assert compared < 660**2 / 2
    assert all(len({u.core for u in x}) > 1 for (_, across), x in lists.items() if across)
    got = {r.doc_id: (r.class_set, r.n_links) for r in J.link_classes(docs, 5, 80).collect()}
    want = {i: (c, n) for i, _, c, n in _brute(rows, 5, 80)}
    assert {i: n for i, (_, n) in got.items()} == {i: n for i, (_, n) in want.items()}
    classes = {}
    for i, (c, _) in got.items():
        classes.setdefault(c, []).append(i)
    assert {i: min(x) for x in classes.values() for i in x} == {i: c for i, (c, _) in want.items()}

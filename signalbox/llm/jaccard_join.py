"""N-gram Jaccard self-join by universe partition and the pigeonhole principle.

A document is the set of its word shingles (as 64-bit hashes). Sets that reach
the similarity differ in at most H elements, and H follows from their sizes.
The universe of hashes is cut into segments so that every set falls into as
many parts; segment i tolerates v[i] differences less one, and the v[i] add up
to H + 1, so two similar sets must agree in a segment with v = 1 or differ by
at most one element in a segment with v = 2.

* Size bands: band k ends at U[k], U[k + 1] = U[k] / similarity, so similar sets
  lie in one band or in neighbouring ones. A set posts its segments in its own
  band's space and, if its size allows, in the space of the band below.
* Segment subsets: a segment with v = 1 posts the hash of its elements; one
  with v = 2 also posts its one-deletion neighbourhood. How many segments get
  v = 2 is chosen per band by a cost model (postings written plus expected
  chance matches).
* Slack: H is that of the largest sets of a space. A set of fewer elements
  differs from any similar one in at most H - c elements (c: its slack), so the
  two agree in at least 1 + c of the m = H + 1 segments.
* An empty segment would be one posting list for unrelated sets, so it is not
  posted. A set with e empty segments may leave out its first c - e segments as
  well: an agreement that is not empty remains, whatever the other leaves out.
  Where e > c all are posted, and more: let two such sets agree in a empty
  segments and in no other, and let b segments be empty in one and hold one
  element in the other. The rest, m - a - b segments, differ in one element
  each and in a - 1 - c more in total, so among any 2 a + b - c segments is one
  that differs by exactly one element and is not of the b. With s segments of
  at most one element, e >= a and s >= a + b, so each of the two posts the
  one-deletion neighbourhoods of its first e + s - c segments and both cover the
  first 2 a + b - c (c the larger slack). That is exact while these are at most
  m; a set with e + s - c > m posts its segments under a second, third and fourth
  order of the universe too, and where it is as thin in all of them, its empty
  segments like any others. So a set posts at most 4 * (elements + 3 m) keys a
  space, whatever its hashes are. Bands whose segments have fewer than three
  elements on average post empty segments like any others.
* The join is exact by default. A caller may allow a chance of a miss
  (``miss``): where a band has so many segments that a similar pair agrees in a
  larger one but for that chance (an estimate that treats segments as
  independent), segments of up to three elements are not posted, which keeps
  shared passages from joining long documents into large clusters.

Candidates are the pairs that share a posting, not its transitive closure. A
set that shares two postings or more with the first set of their lists (one is
enough in spaces of few segments) belongs to that set's core: cores are
components of such links, so copies of one text are one core. All pairs of a
core are verified at once; of a posting list that holds several cores, the
pairs between them. Each text is read and cut into shingles a second time
once, then sent to its core and such lists. Verification is exact, by products
of set-membership matrices in pairs of blocks of bounded size. Pairs within a
core are never written: a block pair returns one row per set with the smallest
set it reaches and its number of links. Links between cores are written as pairs,
as lists may repeat them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalbox.llm.common import (
    col,
    give_back,
    landed,
    sized_broadcast,
    utf8,
)
from signalbox.llm.components import components

WORDS = 3
PERCENT = 90
BLOCK_SETS = 2048
BLOCK_SHINGLES = 1 << 22
SEEN_SETS = 100_000
# A chance of a miss per link that a caller may allow: the order of a collision of 64-bit hashes.
RARE_MISS = 1e-15
ORDERS = 4
FEW_SEGMENTS = 6
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_GAP = re.compile(rb"[\x20\x09-\x0D]")
# Words are hashed many at a time, in pieces of a text of at most PIECE bytes and the rest of a word.
PIECE, LONG_WORD = 1 << 18, 64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (multiply and shift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _byte_values() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(value per byte, A-Z as a-z; which bytes part words; powers of an odd number; powers of its inverse)."""
    values = _mixed(np.arange(1, 257, dtype=np.uint64))
    values[0x41:0x5B] = values[0x61:0x7B]
    gaps = np.zeros(256, bool)
    gaps[[0x20, *range(0x09, 0x0E)]] = True
    base = 0x9E3779B97F4A7C15

    def powers(of: int) -> np.ndarray:
        steps = np.full(2 * PIECE, of, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return values, gaps, powers(base), powers(pow(base, -1, 1 << 64))


def _hashes_of_piece(piece: bytes) -> np.ndarray:
    """64-bit hashes of the words of at most 2 * PIECE bytes: polynomials of their bytes, by differences of sums.

    Words over LONG_WORD bytes, for which such polynomials are weak, are hashed one by one.
    """
    values, gaps, powers, inverse = _byte_values()
    buffer = np.frombuffer(piece, np.uint8)
    edges = np.flatnonzero(np.diff(gaps[buffer], prepend=True, append=True))
    start, end = edges[::2], edges[1::2]
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(values[buffer] * powers[: len(buffer)], out=sums[1:])
    length = end - start
    out = _mixed((sums[end] - sums[start]) * inverse[start] + length.astype(np.uint64))
    for i in np.flatnonzero(length > LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(piece[start[i] : end[i]].translate(_LOWER))
    return out


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of each word of the text in order, A-Z lower-cased."""
    if len(text) <= PIECE:
        return _hashes_of_piece(text)
    out, at = [], 0
    while at < len(text):
        cut = _GAP.search(text, at + PIECE)
        stop = cut.start() if cut else len(text)
        if stop - at <= 2 * PIECE:
            out.append(_hashes_of_piece(text[at:stop]))
        else:  # ends in a word of more than PIECE bytes
            *words, last = text[at:stop].split()
            out.append(_hashes_of_piece(b" ".join(words)))
            out.append(np.array([xxhash.xxh3_64_intdigest(last.translate(_LOWER))], np.uint64))
        at = stop
    return np.concatenate(out)


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """Ascending distinct hashes of the text's shingles (A-Z lower-cased).

    With fewer words than ``words`` the whole sequence is one; without words none.
    """
    h = word_hashes(text)
    if not len(h):
        return np.zeros(0, np.uint64)
    if len(h) < words:
        w = text.translate(_LOWER).split()
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(w), seed=len(w))], np.uint64)
    n = len(h) - words + 1
    total = np.zeros(n, np.uint64)
    for i in range(words):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
        total ^= total >> np.uint64(29)
    return np.unique(_mixed(total))


def set_number(shingles: np.ndarray) -> int:
    """Signed 64-bit number of a set."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


class Bands:
    """Size bands and the allocation of tolerated differences for one similarity."""

    #: Cost model: chance that a set holds a given other element, and the verification cost of a chance match.
    SHARED, VERIFY = 0.3, 50.0

    def __init__(self, percent: int = PERCENT, miss: float = 0.0):
        self.percent, self.miss = percent, miss
        self.ends = [1]

    def largest(self, size: int) -> int:
        """Size of the largest set that one of ``size`` elements can be similar to."""
        return size * 100 // self.percent

    def band(self, size: int) -> int:
        while self.ends[-1] < size:
            self.ends.append(max(self.ends[-1] + 1, self.largest(self.ends[-1])))
        return int(np.searchsorted(self.ends, size))

    def differences(self, k: int) -> int:
        """H: most elements in which similar sets of space ``k`` differ."""
        while len(self.ends) <= k:
            self.band(self.ends[-1] + 1)
        both = self.ends[k] + self.largest(self.ends[k])
        return both * (100 - self.percent) // (100 + self.percent)

    @lru_cache(maxsize=None)  # noqa: B019  a handful of bands
    def allocation(self, k: int) -> tuple[int, int]:
        """(segments with v = 2, segments with v = 1), the cheapest that add up to H + 1."""
        need = self.differences(k) + 1

        def cost(twos: int) -> float:
            ones = max(0, need - 2 * twos)
            each = self.ends[k] / (twos + ones)
            chance = ones * self.SHARED**each + twos * (1 + each) * self.SHARED ** max(each - 1, 0)
            return ones + twos * (1 + each) + self.VERIFY * chance

        twos = min(range((need + 1) // 2 + 1), key=cost)
        return twos, max(0, need - 2 * twos)

    @lru_cache(maxsize=None)  # noqa: B019
    def unposted(self, k: int) -> int:
        """Segments with so many elements or fewer are not posted in space ``k`` (-1: none is left out for its size).

        A similar pair differs in at most H = m - 1 elements, which leave each
        of m segments untouched with a chance of about 1 / e.
        """
        twos, m = self.allocation(k)
        if twos or not self.miss:
            return -1
        mean = (1 + (self.ends[k - 1] if k else 0)) / m
        best, below, term = -1, 0.0, math.exp(-mean)
        for t in range(4):
            below += term
            term *= mean / (t + 1)
            if (1 - (1 - below) / math.e) ** m < self.miss:
                best = t
        return best

    def slack(self, size: int, k: int) -> int:
        """By how many elements less than H a set of ``size`` elements can differ from a similar one in space ``k``."""
        other = self.largest(size) if self.band(size) == k else self.ends[k]
        return self.differences(k) - (size + other) * (100 - self.percent) // (100 + self.percent)

    def spaces(self, size: int) -> list[int]:
        """Spaces that a set of ``size`` elements posts in."""
        k = self.band(size)
        return [k] + ([k - 1] if k and size <= self.largest(self.ends[k - 1]) else [])


def _ordered_postings(shingles: np.ndarray, k: int, twos: int, m: int, order: int, slack: int | None,
                      least: int) -> tuple[list[np.ndarray], np.ndarray, bool]:
    """(posting keys, keys of the empty segments, is thin) of a set in space ``k`` under one order of the universe.

    Without ``slack`` empty segments are posted like any others; segments of ``least`` elements or fewer are not.
    """
    if order:
        shingles = np.sort(_mixed(shingles ^ np.uint64(order * 0xA0761D6478BD642F & (1 << 64) - 1)))
    own = _mixed(shingles ^ np.uint64(0xD6E8FEB86659FD93))
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own, dtype=np.uint64)])
    # Hashes are ascending, so the segments of the universe are runs of them.
    part = ((shingles >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    edge = np.searchsorted(part, np.arange(m + 1, dtype=np.uint64))
    count = np.diff(edge).astype(np.uint64)
    total = running[edge[1:]] - running[edge[:-1]]
    place = _mixed(np.arange(m, dtype=np.uint64) + np.uint64((k + 1) << 32 | order << 30))
    full = _mixed(total + _mixed(place + count))
    if slack is None:
        out = [full[count > least] if least >= 0 else full]
        if twos:  # one-deletion neighbourhoods: an element's segment without it
            at = np.flatnonzero(part < np.uint64(twos))
            of = part[at].astype(int)
            out.append(_mixed(total[of] - own[at] + _mixed(place[of] + count[of] - np.uint64(1))))
        return out, full[:0], False
    empty = full[count == 0]
    left_out = max(0, slack - len(empty))
    out, first = [full[left_out:][count[left_out:] > 0]], 0
    if len(empty) > slack:
        first = len(empty) + int((count <= 1).sum()) - slack
        n = min(first, m)
        salt = place[:n] + np.uint64(1 << 62)
        some = np.flatnonzero(count[:n] > 0)
        out.append(_mixed(total[some] + _mixed(salt[some] + count[some])))
        of = part[: edge[n]].astype(int)
        at = np.flatnonzero(count[of] > 1)
        of = of[at]
        out.append(_mixed(total[of] - own[at] + _mixed(salt[of] + count[of] - np.uint64(1))))
    return out, empty, first > m


def postings(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """Signed 64-bit posting keys of a set."""
    if not len(shingles):
        return np.zeros(0, np.int64)
    out = []
    for k in bands.spaces(len(shingles)):
        twos, ones = bands.allocation(k)
        m = twos + ones
        least = bands.unposted(k)
        slack = bands.slack(len(shingles), k) if least < 0 and not twos and bands.ends[k] >= 3 * m else None
        thin, order, empties, made = True, 0, [], len(out)
        while thin and order < ORDERS:
            keys, empty, thin = _ordered_postings(shingles, k, twos, m, order, slack, least)
            out += keys
            empties.append(empty)
            order += 1
        if thin:
            out += empties
        # The lowest bit tells spaces of few segments, in which one posting makes a core.
        out[made:] = [x >> np.uint64(1) << np.uint64(1) | np.uint64(m <= FEW_SEGMENTS) for x in out[made:]]
    return np.unique(np.concatenate(out)).view(np.int64)


SETS = "doc_id long, n_shingles long, set_id long, keys array<long>"


def _sets(docs: DataFrame, words: int, percent: int, miss: float) -> DataFrame:
    """Per document: set size, set number (null: no words) and posting keys.

    Of equal sets that a task meets, the first alone carries the keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent, miss), set()
        for batch in batches:
            n, number, keys = [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), words)
                n.append(len(s))
                number.append(set_number(s) if len(s) else None)
                if number[-1] is None or number[-1] in seen:
                    keys.append([])
                else:
                    if len(seen) >= SEEN_SETS:
                        seen.clear()
                    seen.add(number[-1])
                    keys.append(postings(s, bands))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n_shingles": pa.array(n, pa.int64()),
                "set_id": pa.array(number, pa.int64()), "keys": pa.array(keys, pa.list_(pa.int64())),
            })
        seen.clear()
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text")).mapInArrow(run, SETS)


def _shared_postings(sets: DataFrame) -> DataFrame:
    """(key, u, v): the sets of each posting list with its smallest set v < u. Streams over each list."""
    rows = sets.filter(F.size("keys") > 0).select(F.explode("keys").alias("key"), "set_id")
    upto = Window.partitionBy("key").orderBy("set_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    linked = rows.withColumn("first", F.min("set_id").over(upto)).filter("first < set_id")
    return linked.select("key", F.col("set_id").alias("u"), F.col("first").alias("v"))


def _units(shared: DataFrame) -> DataFrame:
    """(unit, set_id, core, across): what is verified together, a core or (``across``) a list that holds several cores."""
    pairs = landed(shared.groupBy("u", "v").agg(F.min("key").alias("key"), F.max("key").alias("last")), "posting-pairs")
    close = (F.col("key") != F.col("last")) | (F.col("key").bitwiseAND(F.lit(1)) == 1)
    cores = landed(components(pairs.filter(close).select("u", "v")).select(
        F.col("node").alias("of"), F.col("label").alias("core")), "cores")

    def with_core(rows: DataFrame, of: str, name: str) -> DataFrame:
        known = cores.select(F.col("of").alias(f"of_{name}"), F.col("core").alias(f"known_{name}"))
        joined = rows.join(sized_broadcast(known), F.col(of) == F.col(f"of_{name}"), "left")
        return joined.withColumn(name, F.coalesce(f"known_{name}", of)).drop(f"of_{name}", f"known_{name}")

    loose = with_core(with_core(pairs.filter(~close), "u", "core_u"), "v", "core_v").filter("core_u <> core_v")
    keys = landed(loose.select(F.col("key").alias("across_key")).distinct(), "lists-of-several-cores")
    listed = shared.join(sized_broadcast(keys), F.col("key") == F.col("across_key")).select("key", "u", "v")
    members = listed.select("key", F.explode(F.array("u", "v")).alias("set_id")).distinct()
    across = with_core(members, "set_id", "core").select(
        F.col("key").alias("unit"), "set_id", "core", F.lit(True).alias("across"))
    within = cores.select(F.col("core").alias("unit"), F.col("of").alias("set_id"), "core", F.lit(False).alias("across"))
    return within.unionAll(across)


def membership(sets: list[np.ndarray], columns: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(0/1 matrix sets x column groups, weights): elements with the same owners are one column.

    Elements of a single set have no column. At most ``columns`` columns are made at a time.
    """
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    del order
    start = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    length = np.diff(np.append(start, len(every)))
    del every
    pattern = np.add.reduceat(_mixed(owner.astype(np.uint64) + np.uint64(1)) | np.uint64(1), start)
    shared = length > 1
    _, first, weight = np.unique(pattern[shared], return_index=True, return_counts=True)
    where, size = start[shared][first], length[shared][first]
    for at in range(0, len(where), columns):
        n = size[at : at + columns]
        column = np.repeat(np.arange(len(n)), n)
        within = np.arange(len(column)) - np.repeat(np.cumsum(n) - n, n)
        matrix = np.zeros((len(sets), len(n)), np.float32)
        matrix[owner[np.repeat(where[at : at + columns], n) + within], column] = 1
        yield matrix, weight[at : at + columns].astype(np.float32)


def links_between(left: list[np.ndarray], right: list[np.ndarray], percent: int, columns: int = 2048) -> np.ndarray:
    """Boolean matrix left x right: which sets (ascending distinct hashes) link. ``right`` may be ``left`` itself."""
    sets = left if right is left else left + right
    at = 0 if right is left else len(left)
    size = np.array([len(s) for s in right], np.int64)
    common = np.zeros((len(left), len(right)), np.float64)
    for matrix, weight in membership(sets, columns):
        common += (matrix[: len(left)] * weight) @ matrix[at:].T
    # 100 * common >= percent * (both sizes - common), whole numbers that a double holds exactly
    np.rint(common, out=common)
    common *= 100 + percent
    out = np.empty(common.shape, bool)
    for i, own in enumerate(left):
        out[i] = common[i] >= percent * (len(own) + size)
    return out


def links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix: which of the sets link with each other; the diagonal is False."""
    out = links_between(sets, sets, percent)
    np.fill_diagonal(out, False)
    return out


def smallest_reached(linked: np.ndarray, left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Per position 0 ... n - 1 the smallest one that it reaches by links between ``left`` and ``right`` positions."""
    root = np.arange(n, dtype=np.int32)
    while True:
        new = root.copy()
        new[left] = np.minimum(new[left], np.where(linked, root[right][None, :], n).min(axis=1, initial=n))
        new[right] = np.minimum(new[right], np.where(linked, root[left][:, None], n).min(axis=0, initial=n))
        new = new[new]
        if (new == root).all():
            return root
        root = new


VERIFIED = "u long, v long, n_links long"


def _verify(percent: int):
    """One block pair of a unit: in a core, per set, the smallest set it reaches (or itself) and its links.

    Of a list of several cores, its links between them as pairs u > v, without a number of links.
    """

    def run(block: pa.Table) -> pa.Table:
        number, at = np.unique(block["set_id"].to_numpy(), return_index=True)
        hashes, copies, own = block["shingles"], block["copies"].to_numpy()[at], block["own"].to_numpy()[at]
        core, across = block["core"].to_numpy()[at], block["across"][0].as_py()
        sets = [np.frombuffer(hashes[int(i)].as_py(), np.uint64) for i in at]
        every, n = np.arange(len(number)), np.zeros(len(number), np.int64)
        p, q = block["p"][0].as_py(), block["q"][0].as_py()
        if p == q:
            left = right = every
            linked = links(sets, percent)
        else:  # pairs across the two blocks only; those within one belong to its own pair (p, p)
            left, right = every[own == p], every[own == q]
            linked = links_between([sets[i] for i in left], [sets[i] for i in right], percent)
        del hashes, sets
        if across:
            linked &= core[left][:, None] != core[right][None, :]
            i, j = np.nonzero(linked)
            u, v = number[left[i]], number[right[j]]
            found = np.unique(np.stack([np.maximum(u, v), np.minimum(u, v)]), axis=1)
            out = pa.table({"u": found[0], "v": found[1], "n_links": pa.nulls(found.shape[1], pa.int64())})
        else:
            n[left] = linked @ copies[right]
            if p != q:
                n[right] = copies[left] @ linked
            out = pa.table({"u": number, "v": number[smallest_reached(linked, left, right, len(number))], "n_links": n})
        del linked
        if len(number) > 256:
            give_back()
        return out

    return run


def link_classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block_sets: int = BLOCK_SETS,
                 block_shingles: int = BLOCK_SHINGLES, miss: float = 0.0) -> DataFrame:
    """doc_id, n_shingles, set_id, class_set, n_links per row of ``docs``.

    Rows with equal ``class_set`` are connected by links of at least
    ``percent`` % Jaccard similarity; ``n_links`` counts the other rows a row
    links to directly (equal sets included). A null or wordless text has no
    set (null set_id and class_set, 0 shingles) and links with nothing. A core
    or list is cut into so many blocks that one holds about ``block_sets``
    sets and ``block_shingles`` shingles at most. With ``miss`` = 0 no link is
    lost (but for equal 64-bit hashes); a caller may allow a chance per link.
    """
    sets = landed(_sets(docs, words, percent, miss), "shingle-sets")
    shared = landed(_shared_postings(sets), "shared-postings")
    units = _units(shared).select("unit", F.col("set_id").alias("c_set"), "core", "across")
    copies = sets.filter("set_id IS NOT NULL").groupBy("set_id").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("rep"), F.max("n_shingles").alias("size")
    )
    members = landed(units.join(copies, F.col("c_set") == F.col("set_id")).drop("c_set"), "unit-members")
    blocks = F.greatest(F.count("*") / block_sets, F.sum("size") / block_shingles)
    sizes = members.groupBy(F.col("unit").alias("s_unit"), F.col("across").alias("s_across")).agg(
        F.ceil(blocks).cast("int").alias("n_blocks")
    )
    # A set is in one core and in as many lists as it has postings at most.
    wanted = landed(
        members.join(sizes, (F.col("unit") == F.col("s_unit")) & (F.col("across") == F.col("s_across")))
        .groupBy("rep", "set_id", "copies", "core").agg(F.collect_list(F.struct("unit", "across", "n_blocks")).alias("units")),
        "candidates",
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text")).join(
        sized_broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("rep"))
    ).select("text", "set_id", "copies", "core", "units")

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py(), words) for t in batch.column(0)]
            # Another row may have the same id and another text.
            same = pa.array([len(s) > 0 and set_number(s) == n for s, n in zip(found, batch.column(1).to_pylist(), strict=True)])
            out = batch.set_column(0, "shingles", pa.array([s.tobytes() for s in found], pa.binary()))
            yield out.filter(same)
        give_back()

    met = (
        rows.mapInArrow(again, "shingles binary, set_id long, copies long, core long, "
                               "units array<struct<unit long, across boolean, n_blocks int>>")
        .select("shingles", "set_id", "copies", "core", F.inline("units"))
        .withColumn("own", F.pmod(F.xxhash64("set_id"), F.col("n_blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .withColumn("p", F.least("own", "other")).withColumn("q", F.greatest("own", "other"))
        .drop("other", "n_blocks")
    )
    verified = landed(met.groupBy("unit", "across", "p", "q").applyInArrow(_verify(percent), VERIFIED), "verified")
    joined = components(verified.filter("u <> v").select("u", "v"))
    # Several lists may find the same link between cores.
    pairs = landed(verified.filter("n_links IS NULL").select("u", "v").distinct(), "links-between-cores")
    both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    others = copies.select(F.col("set_id").alias("o_set"), "copies")
    counted = verified.filter("n_links IS NOT NULL").select("u", "n_links").unionAll(
        both.join(others, F.col("v") == F.col("o_set")).select("u", F.col("copies").alias("n_links"))
    )
    n_links = counted.groupBy("u").agg(F.sum("n_links").alias("n"))
    known = (
        copies.select(F.col("set_id").alias("k_set"), "copies")
        .join(n_links, F.col("k_set") == F.col("u"), "left")
        .join(joined, F.col("k_set") == F.col("node"), "left")
        .select("k_set", F.coalesce("label", "k_set").alias("class_set"),
                (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    known = landed(known, "set-classes")
    return sets.drop("keys").join(sized_broadcast(known), F.col("set_id") == F.col("k_set"), "left").select(
        "doc_id", "n_shingles", "set_id", "class_set", F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links per document.

    ``component_id`` is the smallest doc_id reachable by links, itself
    included (null ids are ignored where another exists).
    """
    rows = landed(link_classes(docs, words, percent), "link-classes")
    least = rows.filter("class_set IS NOT NULL").groupBy(F.col("class_set").alias("l_set")).agg(
        F.min("doc_id").alias("least")
    )
    return rows.join(sized_broadcast(least), F.col("class_set") == F.col("l_set"), "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"), "n_links"
    )


def one_per_class(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, miss: float = 0.0) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest doc_id (null last).

    Texts without words all stay. Repeated rows (equal id and shingles) are
    one row. Unless an id is repeated, rows are kept by anti-join with the
    ids of the others, so texts are not shuffled while that list is small.
    """
    rows = landed(link_classes(docs, words, percent, miss=miss), "link-classes").filter("set_id IS NOT NULL")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("set_id").alias("set"))
    first = rows.groupBy(F.col("class_set").alias("f_set")).agg(F.min(order).alias("first"))
    marked = rows.join(sized_broadcast(first), F.col("class_set") == F.col("f_set")).select(
        "doc_id", "set_id", order.eqNullSafe(F.col("first")).alias("stays")
    )
    marked = landed(marked, "marked")
    repeated = landed(
        marked.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 OR doc_id IS NULL").select(
            F.col("doc_id").alias("r_id")
        ), "repeated",
    )
    dropped = marked.filter(~F.col("stays")).select(F.col("doc_id").alias("d_id"))
    own = col("doc_id").cast("long")
    single = docs.join(sized_broadcast(repeated), own.eqNullSafe(F.col("r_id")), "left_anti").join(
        sized_broadcast(dropped.filter("d_id IS NOT NULL")), own == F.col("d_id"), "left_anti"
    )
    if repeated.isEmpty():
        return single
    name = "set_number_of_row"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set((t.as_py() or "").encode(), words) for t in batch.column("text")]
            yield batch.append_column(name, pa.array([set_number(s) if len(s) else None for s in found], pa.int64()))

    several = docs.join(sized_broadcast(repeated), own.eqNullSafe(F.col("r_id")), "left_semi")
    several = several.mapInArrow(number, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))
    stays = marked.filter("stays").select(F.col("doc_id").alias("s_id"), F.col("set_id").alias("s_set")).distinct()
    kept = several.join(
        sized_broadcast(stays), own.eqNullSafe(F.col("s_id")) & (col(name) == F.col("s_set")), "left_semi"
    ).dropDuplicates(["doc_id", name])
    return single.unionByName(kept.drop(name)).unionByName(several.filter(col(name).isNull()).drop(name))

"""Word-piece counts by a linear longest-match automaton.

Greedy longest-match splitting walks a trie of the vocabulary. Where the walk
fails, a failure link says at which node it goes on and how many pieces were
finished (popped) on the way, so counting needs one step per byte and no
piece is ever built. The links are found breadth first: for a node v reached
from parent p by byte b, if v is a piece the link pops just that piece and
goes to the continuation root; otherwise links are followed from p's link
until a node has a child for b, adding up the popped pieces.

The vocabulary is a public byte-level list: entries with the word mark start
a word, all others continue one. A word that cannot be split is one unknown
piece. Counts of distinct words are kept per worker in a bounded dictionary.
"""

from __future__ import annotations

import json
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbox.llm.common import map_batches, utf8, worker_cache

KEPT_WORDS = 400_000
# A word is a run of bytes that are neither white space, control nor ASCII
# punctuation, or one ASCII punctuation mark.
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[!-/:-@\[-`{-~]")
NONE = -1


def byte_alphabet() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable bytes stand for themselves; the others are letters from
    U+0100 on, in ascending byte order.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def word_pieces(path: str) -> tuple[set[bytes], set[bytes]]:
    """(pieces that start a word, pieces that continue one) of a byte-level vocabulary file."""
    alphabet = byte_alphabet()
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    starts, continues = set(), set()
    for entry in vocabulary:
        if any(c not in alphabet for c in entry):
            continue
        data = bytes(alphabet[c] for c in entry)
        if data.startswith(b" "):
            starts.add(data[1:])
        else:
            continues.add(data)
    return starts - {b""}, continues - {b""}


class LongestMatchCounter:
    """Number of greedy longest-match pieces of a word, one automaton step per byte."""

    def __init__(self, starts: set[bytes], continues: set[bytes]):
        # Nodes 0 and 1 are the roots for a word's start and its continuation.
        self.child: dict[int, int] = {}  # node << 8 | byte -> node
        parent, byte, piece = [NONE, NONE], [0, 0], [False, False]
        for root, pieces in ((0, starts), (1, continues)):
            for data in pieces:
                node = root
                for b in data:
                    key = node << 8 | b
                    if key not in self.child:
                        self.child[key] = len(parent)
                        parent.append(node)
                        byte.append(b)
                        piece.append(False)
                    node = self.child[key]
                piece[node] = True
        nodes = len(parent)
        self.link, self.popped = [NONE] * nodes, [0] * nodes
        below: list[list[int]] = [[] for _ in range(nodes)]
        for node in range(2, nodes):
            below[parent[node]].append(node)
        queue = deque(below[0] + below[1])
        while queue:
            node = queue.popleft()
            queue.extend(below[node])
            if piece[node]:
                self.link[node], self.popped[node] = 1, 1
                continue
            at, pops = self.link[parent[node]], self.popped[parent[node]]
            while at != NONE and (at << 8 | byte[node]) not in self.child:
                pops += self.popped[at]
                at = self.link[at]
            if at != NONE:
                self.link[node], self.popped[node] = self.child[at << 8 | byte[node]], pops

    def count(self, word: bytes) -> int:
        """Pieces of a non-empty word; 0 if it cannot be split."""
        child, link, popped = self.child, self.link, self.popped
        node = total = 0
        for b in word:
            key = node << 8 | b
            while key not in child:
                total += popped[node]
                node = link[node]
                if node == NONE:
                    return 0
                key = node << 8 | b
            node = child[key]
        while node != 1:  # the rest of the walk is popped down to the continuation root
            total += popped[node]
            node = link[node]
            if node == NONE:
                return 0
        return total


def _counter(path: str) -> tuple[LongestMatchCounter, dict[bytes, int]]:
    return worker_cache(f"automaton of {path}", lambda: (LongestMatchCounter(*word_pieces(path)), {}))


SCHEMA = "doc_id long, n_words long, n_tokens long, n_unknown long"


def count_pieces(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_words, n_tokens (pieces, an unknown word counting as one) and n_unknown words.

    Whole texts are counted, words of any length; null or empty text has no
    words. One row per input row, repeated ids included.
    """

    def run(batch: pa.RecordBatch) -> dict:
        counter, known = _counter(vocabulary)
        n_words, n_tokens, n_unknown = [], [], []
        for text in batch.column(1):
            words = WORD.findall(text.as_py())
            if len(known) > KEPT_WORDS:
                known.clear()
            for word in set(words).difference(known):
                known[word] = counter.count(word)
            counts = list(map(known.__getitem__, words))
            unknown = counts.count(0)
            n_words.append(len(words))
            n_tokens.append(sum(counts) + unknown)
            n_unknown.append(unknown)
        return {"doc_id": batch.column(0), "n_words": n_words, "n_tokens": n_tokens, "n_unknown": n_unknown}

    return map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text")), run, SCHEMA
    )

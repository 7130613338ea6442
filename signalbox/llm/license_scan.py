"""Licence scan through a positional rare-token index.

The index is built over licence templates. A word's IDF over the templates
ranks it; each template posts its rarest words with their positions. A file's
words are looked up in the index; every hit at file position p on a posting
(template, q) votes for the template standing at p - q. Postings are
intersected by that relative position, and a template is accepted where
enough of its rare words agree and its mandatory key phrases stand at their
places. The template list is a fixed, bounded set of notices, so the index is
small and every task builds it; documents are read once, without a shuffle.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbox.llm.common import map_batches, utf8

# Bytes that belong to words (digits, a-z after lower-casing, all of UTF-8's
# multi-byte sequences); every other byte becomes a space.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text's UTF-8 bytes."""
    return text.translate(WORD_BYTES).split()


@dataclass(frozen=True)
class Template:
    """A notice and the phrases of it that a match must hold (none: the whole notice)."""

    label: str
    notice: str
    key_phrases: tuple[str, ...] = ()


# The phrases that are counted as base places: fixed values.
BASE_TEMPLATES = (
    Template("mit", "under the mit license"),
    Template("apache-2", "apache license version 2"),
    Template("cc-by-nc", "cc by nc"),
)

# Openings and marks of common licences (public texts): fixed values.
NOTICE_TEMPLATES = (
    Template("agpl-3", "gnu affero general public license version 3"),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except "
             "in compliance with the license you may obtain a copy of the license at",
             ("apache license version 2", "in compliance with the license")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
             "provided that the following conditions are met",
             ("redistribution and use in source and binary forms", "the following conditions are met")),
    Template("cc-by", "creative commons attribution 4 0 international"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "cc0 1 0 universal"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without "
             "fee is hereby granted", ("permission to use copy modify", "without fee is hereby granted")),
    Template("lgpl", "gnu lesser general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
             "associated documentation files the software to deal in the software without restriction",
             ("permission is hereby granted free of charge", "deal in the software without restriction")),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license",)),
    Template("proprietary", "all rights reserved"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)


class RareTokenIndex:
    """Postings of every template's rarest words, and the check of a voted place."""

    def __init__(self, base: Sequence[Template] = BASE_TEMPLATES, notices: Sequence[Template] = NOTICE_TEMPLATES,
                 rare_words: int = 2, min_votes: float = 0.6):
        self.templates = [*base, *notices]
        self.n_base = len(base)
        self.words = [words_of(t.notice.encode()) for t in self.templates]
        df = Counter(w for ws in self.words for w in set(ws))
        self.idf = {w: math.log((1 + len(self.words)) / n) for w, n in df.items()}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.needed: list[int] = []
        for t, ws in enumerate(self.words):
            rarest = sorted(set(ws), key=lambda w: (-self.idf[w], ws.index(w)))[:rare_words]
            spots = [(w, q) for q, w in enumerate(ws) if w in rarest]
            for w, q in spots:
                self.postings[w].append((t, q))
            whole = not self.templates[t].key_phrases
            self.needed.append(len(spots) if whole else math.ceil(min_votes * len(spots)))
        self.phrases = [self._placed(t) for t in range(len(self.templates))]
        self.postings = dict(self.postings)

    def _placed(self, t: int) -> list[tuple[int, list[bytes]]]:
        """Mandatory phrases of a template with their positions in it."""
        ws, out = self.words[t], []
        for phrase in self.templates[t].key_phrases or (self.templates[t].notice,):
            ps = words_of(phrase.encode())
            out.append((next(q for q in range(len(ws)) if ws[q : q + len(ps)] == ps), ps))
        return out

    def matches(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, start, share of its words that stand in place) for every accepted place."""
        index, votes = self.postings, Counter()
        hits = [p for p, w in enumerate(words) if w in index]
        for p in hits:
            for t, q in index[words[p]]:
                if p >= q:
                    votes[t, p - q] += 1
        found = []
        for (t, start), n in votes.items():
            if n < self.needed[t]:
                continue
            if all(words[start + q : start + q + len(ps)] == ps for q, ps in self.phrases[t]):
                ws = self.words[t]
                same = sum(a == b for a, b in zip(ws, words[start : start + len(ws)], strict=False))
                found.append((t, start, same / len(ws)))
        return found


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, match_starts array<long>, match_labels array<string>"
)


def scan_licenses(docs: DataFrame, index: RareTokenIndex | None = None) -> DataFrame:
    """One row per document with its licence labels and the places they stand at.

    n_words counts all words; n_base, first_word, last_word and base_labels
    tell of the base phrases; labels adds those of the notices; score is the
    largest share of a template's words found in place (0 without a match);
    match_starts and match_labels list every accepted place in text order.
    Null text is empty: no words, no labels (empty strings), null positions.
    Rows with equal ids are scanned each on their own.
    """
    index = index or RareTokenIndex()

    def scan(batch: pa.RecordBatch) -> dict:
        out = {name.split()[0]: [] for name in SCHEMA.split(", ")}
        out["doc_id"] = batch.column(0)
        for text in batch.column(1):
            words = words_of(text.as_py())
            found = sorted(index.matches(words), key=lambda m: (m[1], m[0]))
            base = [(t, s) for t, s, _ in found if t < index.n_base]
            starts = [s for _, s in base]
            label = [index.templates[t].label for t, _, _ in found]
            out["n_words"].append(len(words))
            out["n_base"].append(len(base))
            out["first_word"].append(min(starts, default=None))
            out["last_word"].append(max(starts, default=None))
            out["base_labels"].append(",".join(sorted({index.templates[t].label for t, _ in base})))
            out["labels"].append(",".join(sorted(set(label))))
            out["score"].append(max((x for _, _, x in found), default=0.0))
            out["match_starts"].append([s for _, s, _ in found])
            out["match_labels"].append(label)
        return out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    return map_batches(rows, scan, SCHEMA)

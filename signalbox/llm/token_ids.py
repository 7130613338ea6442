"""Token ids of whole texts by the ``tokenizers`` library, word by word where that is exact.

Both public vocabularies used here never join characters across white space,
so the ids of a text are the ids of its pieces in a row: pieces start at a
space, or at a line end between two other characters. Each piece goes through
the library once per worker and is kept in one of two bounded dictionaries, a
full one taking the older one's place. A closing
full stop or comma after a letter is a token run of its own (for the byte-level
vocabulary any ASCII marks that start with no apostrophe are), and the
vocabulary without case reads ASCII letters as small ones; a new piece that
differs from a known one in these alone needs no call. Pieces of plain Latin
letters are a token run as they stand and go straight to the library's merge
model; all others pass its normaliser and splitter. Where a space follows
other white space the byte-level pattern may split the run differently; such
texts are encoded whole.

``encode_batch`` cuts the texts of an Arrow column by array operations and
looks each distinct piece of the column up once; the ids of all texts are then
taken by the pieces' numbers.
"""

from __future__ import annotations

import os
import re
import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from signalbox.llm.common import worker_cache
from signalbox.llm.wordpiece_count import byte_alphabet

END_ID = 2
KEPT_PIECES = 500_000  # a full dictionary becomes the older one, which is asked before a piece counts as new
KEPT_CHARS = 48  # longer pieces are encoded each time
BATCH_BYTES = 4 << 20  # texts cut at once by encode_batch, unless a single one is longer
MARKS = string.punctuation.replace("'", "")  # behind a letter, a run of these is split off; an apostrophe may not be
_SPACE_RUN = re.compile(r"\s ")
_ANY_RUN = re.compile(r"\s\s|\s\Z")
# Letters whose small letters and composed forms are single letters as well.
_LETTERS = re.compile("\n?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e]+").fullmatch


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of a vocabulary file."""
    return worker_cache(f"pieces of {path}", lambda: PieceEncoder(path))


class PieceEncoder(dict):
    """Ids of texts (little-endian unsigned 32-bit); the dictionary holds those of known pieces."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.vocab_size = self.library.get_vocab_size()
        # White space before a piece matters only where the vocabulary marks it.
        self.spaced = "Ġthe" in self.library.get_vocab()
        self.merge = self.library.model.tokenize
        self.added = [token.content for token in self.library.get_added_tokens_decoder().values()]
        self.older = {}  # the pieces kept before the dictionary was last full
        self.letter = {b: c for c, b in byte_alphabet().items()}
        self.line_end = self._whole("\n")
        self.ends = {c: self._whole(c) for c in ".,"}

    def _whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _pieces(self, text: str) -> list[str] | None:
        """The text cut at spaces (the first piece has none before it); None: not to be cut."""
        if not self.spaced:
            return text.replace("\n", " ").split(" ")
        if not _ANY_RUN.search(text):
            return text.replace("\n", " \n").split(" ")
        return None if " \n" in text or _SPACE_RUN.search(text) else text.split(" ")

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self._new(piece)
        if len(piece) <= KEPT_CHARS:
            if len(self) >= KEPT_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def _new(self, piece: str) -> bytes:
        """Ids of a piece that is not kept."""
        if self.spaced and piece.isascii() and piece.isalpha():
            return self._run("Ġ" + piece)
        # A dotted capital I is a letter and a mark in small letters, and the mark joins what follows.
        if len(piece) > 1 and piece[-1] in self.ends and piece[-2].isalpha() and piece[-2] != "İ":
            return self[piece[:-1]] + self.ends[piece[-1]]
        if not self.spaced and piece.isascii() and not piece.islower() and piece.isalpha():
            return self[piece.lower()]
        if _LETTERS(piece):
            return self._merged(piece)
        if self.spaced:
            word = piece.rstrip(MARKS)
            if word != piece and word[-1:].isalpha() and not any(token in piece for token in self.added):
                return self[word] + self._run(piece[len(word) :])
        return self._whole(piece if not self.spaced or piece.startswith("\n") else " " + piece)

    def _run(self, run: str) -> bytes:
        """Ids of a run that the splitter keeps together, in the letters of the vocabulary."""
        return array("I", [t.id for t in self.merge(run)]).tobytes()

    def _merged(self, piece: str) -> bytes:
        """Ids of a piece of letters, with a line end before them or not."""
        lead, start = ("Ġ" if self.spaced else ""), b""
        if piece[0] == "\n":
            piece, lead, start = piece[1:], "", self.line_end
        if not self.spaced:
            piece = piece.lower()
        if not piece.isascii():
            piece = "".join(map(self.letter.__getitem__, piece.encode()))
        return start + self._run(lead + piece)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text."""
        pieces = self._pieces(text)
        if pieces is None:
            return self._whole(text)
        if self.spaced:
            return self._whole(pieces[0]) + b"".join(map(self.__getitem__, pieces[1:]))
        return b"".join(map(self.__getitem__, pieces))

    def encode_batch(self, texts: pa.Array, end_id: int | None = None) -> list[bytes]:
        """Ids of whole texts (UTF-8, no nulls), each followed by ``end_id`` if given."""
        try:
            texts = texts.cast(pa.large_string())
        except pa.ArrowInvalid:  # not UTF-8
            texts = pa.array([t.as_py().decode("utf-8", "replace") for t in texts], pa.large_string())
        share = np.cumsum(pc.binary_length(texts).to_numpy()) // BATCH_BYTES
        bounds = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), len(texts)]
        tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        return [ids for a, b in zip(bounds, bounds[1:]) if a < b for ids in self._batch(texts.slice(a, b - a), tail)]

    def _batch(self, texts: pa.Array, tail: bytes) -> list[bytes]:
        lines = " \n" if self.spaced else " "
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", lines), " ")
        ends = cut.offsets.to_numpy()[1:] - cut.offsets[0].as_py()
        firsts = np.concatenate([[0], ends[:-1]])
        pieces = cut.flatten().dictionary_encode()
        known, numbers = pieces.dictionary, pieces.indices.to_numpy()
        found = list(map(self.__getitem__, known.to_numpy(zero_copy_only=False)))
        whole = np.zeros(len(texts), bool)
        if self.spaced:
            # A first piece has no space before it, so it is a piece of its own.
            first_pieces = known.take(pa.array(numbers[firsts])).to_pylist()
            numbers = numbers.copy()
            numbers[firsts] = len(found) + np.arange(len(texts))
            found += map(self._whole, first_pieces)
            # White space at a piece's end, or at its start but for one line end, is part of a run.
            bare = pc.binary_length(pc.utf8_trim_whitespace(known)).to_numpy()
            runs = (bare + pc.starts_with(known, "\n").to_numpy(zero_copy_only=False)
                    != pc.binary_length(known).to_numpy()) | (bare == 0)
            runs = np.concatenate([runs, [p[-1:].isspace() for p in first_pieces]])
            whole = np.logical_or.reduceat(runs[numbers], firsts)
        found.append(tail)
        numbers = np.insert(numbers, ends, len(found) - 1)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        places = np.cumsum(sizes) - sizes
        taken = sizes[numbers]
        stops = np.cumsum(taken)
        steps = np.repeat(places[numbers] - (stops - taken), taken)
        steps += np.arange(len(steps))
        ids = memoryview(np.frombuffer(b"".join(found), "<u4")[steps]).cast("B")
        stops = 4 * stops[ends + np.arange(len(texts))]
        out = [bytes(ids[a:b]) for a, b in zip([0, *stops.tolist()], stops.tolist())]
        for i in np.flatnonzero(whole).tolist():
            out[i] = self.encode(texts[i].as_py()) + tail
        return out

"""Token ids of whole columns of texts: exact, each distinct piece looked up once, known pieces kept."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from signalbox.llm import bitpack_ids, token_ids
from signalbox.llm.token_ids import PieceEncoder, vocabulary_path

TEXTS = [
    "", " ", "\n", "a\n", " a", "\na", "a\t b", "a \tb", "a\t\tb\nc", "a  b", "a\n\nb", "\x1c a", "a  b",
    "The word, the word. The word!! the (word) the word's 'word' word'!! wordn't...", "x_y__ a_ 12.5% 3rd!",
    "über\nÇa va?! naïve; İstanbul, İ! Жук!! 中文。 é!! l’eau…", "<|endoftext|> a<|endoftext|>!! <|endoftext|>!",
    "word " * 40 + "word", "one\ntwo three\nfour***",
]


def _library(encoder: PieceEncoder, text: str) -> bytes:
    return np.array(encoder.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("batch_bytes", [1, 60, 1 << 20])
def test_columns_of_texts_give_the_librarys_ids(monkeypatch, vocabulary, batch_bytes):
    monkeypatch.setattr(token_ids, "BATCH_BYTES", batch_bytes)
    encoder = PieceEncoder(vocabulary_path(vocabulary))
    given = pa.array([t.encode() for t in TEXTS], pa.binary())
    end = np.array([2], "<u4").tobytes()
    for _ in range(2):
        assert encoder.encode_batch(given, 2) == [_library(encoder, t) + end for t in TEXTS]
    assert [encoder.encode(t) for t in TEXTS] == [_library(encoder, t) for t in TEXTS]
    assert encoder.encode_batch(given.slice(0, 0)) == []


def test_bytes_that_are_no_utf8_are_replaced():
    encoder = PieceEncoder(vocabulary_path("byte_bpe_50k.json"))
    given = [b"a \xff\xfe b!!", b"plain", b"c\xed\xa0\x80\n"]
    expected = [_library(encoder, t.decode("utf-8", "replace")) for t in given]
    assert encoder.encode_batch(pa.array(given, pa.binary())) == expected


def test_a_piece_is_looked_up_once_a_column(monkeypatch):
    looked = []
    monkeypatch.setattr(PieceEncoder, "__getitem__", lambda e, p: looked.append(p) or dict.__getitem__(e, p), raising=False)
    encoder = PieceEncoder(vocabulary_path("byte_bpe_50k.json"))
    encoder.encode_batch(pa.array([b"same words and same words"] * 500, pa.binary()))
    assert sorted(looked) == ["and", "same", "words"]


def test_a_full_dictionary_forgets_no_piece_in_use(monkeypatch):
    monkeypatch.setattr(token_ids, "KEPT_PIECES", 20)
    encoder = PieceEncoder(vocabulary_path("byte_bpe_50k.json"))
    calls, merge = [], encoder.merge
    encoder.merge = lambda run: calls.append(run) or merge(run)
    for i in range(100):
        encoder.encode(f"x known {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}")
        assert len(encoder) <= 20 and len(encoder.older) <= 20
    assert calls.count("Ġknown") == 1


def test_closing_marks_need_no_splitter(monkeypatch):
    encoder = PieceEncoder(vocabulary_path("byte_bpe_50k.json"))
    expected = _library(encoder, "x loud!! loud?! loud***")
    whole, asked = encoder._whole, []
    monkeypatch.setattr(encoder, "_whole", lambda text: asked.append(text) or whole(text))
    assert encoder.encode("x loud!! loud?! loud***") == expected
    assert asked == ["x"]


def test_segments_hold_the_librarys_ids(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None])], "doc_id long, text string")
    vocabulary = vocabulary_path("byte_bpe_50k.json")
    found = bitpack_ids.packed_documents(spark, docs, vocabulary, segment_ids=50, task_chars=100).orderBy("doc_id").collect()
    encoder = PieceEncoder(vocabulary)
    sizes = [len(_library(encoder, t)) // 4 + 1 for t in [*TEXTS, ""]]
    assert [r.n_tokens for r in found] == sizes
    assert [r.start for r in found] == [sum(sizes[:i]) for i in range(len(sizes))]

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from brute import frame, odd_rows

from caremarts.llm.bpe import BlockEncoder, WordBpe, decode, encode, encoded_digest
from caremarts.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary())


@pytest.fixture(scope="module")
def bpe():
    with open(vocabulary(), encoding="utf-8") as f:
        return WordBpe(f.read())


def expected(library, text):
    got = library.encode(text or "", add_special_tokens=False)
    ids = np.array(got.ids, "<u4").tobytes()
    back = library.decode(got.ids, skip_special_tokens=False)
    return len(got.ids), hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_random_texts_as_the_library_has_them(bpe, library):
    rnd = random.Random(5)
    letters = "aaaabcdeinrst 'lmv12\n\t\x1c\x1f\x85\xa0​ éßİıΣσςΑÅﬁ中😀👍½²٣!?.,-_<|>"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 50))) for _ in range(3000)]
    texts += ["<|endoftext|>", "x<|startoftext|>y<|endoftext|", "a" * 3000, "abab" * 500, "it's I'LL", " ", ""]
    ids, ends = BlockEncoder(bpe).encode(pa.array(texts))
    for i, own in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[ends[i] : ends[i + 1]].tolist() == own.ids, texts[i]


def test_equal_letters_merge_from_the_left(bpe, library):
    for text in ("aaa", "aaaa", "aaaaa", "oooooo", "lllll eeeee", "ssssssss"):
        ids, _ = BlockEncoder(bpe).encode(pa.array([text]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_cache_is_dropped_and_filled_again(bpe, library, monkeypatch):
    monkeypatch.setattr("caremarts.llm.bpe.CACHED_CHUNKS", 3)
    coder = BlockEncoder(bpe)
    for block in (["one two three four"], ["five two"], ["one", "six seven"]):
        ids, _ = coder.encode(pa.array(block))
        assert ids.tolist() == [i for t in block for i in library.encode(t, add_special_tokens=False).ids]


def test_odd_rows_and_empty_table(spark, library):
    docs = odd_rows(spark)
    got = sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encoded_digest(docs, vocabulary()).collect())
    assert got == sorted(expected(library, r.text) for r in docs.collect())
    assert encoded_digest(docs.limit(0), vocabulary()).count() == 0


def test_arrays_decode_and_clashing_columns_are_replaced(spark, library):
    docs = frame(spark, ["some words", None]).selectExpr("*", "'x' as IDS", "1 as decoded")
    coded = encode(docs, vocabulary())
    assert [c.lower() for c in coded.columns].count("ids") == 1
    rows = {r.doc_id: r for r in decode(coded, vocabulary()).collect()}
    assert rows[1].ids == [] and rows[1].decoded == ""
    assert rows[0].decoded == library.decode(rows[0].ids, skip_special_tokens=False)

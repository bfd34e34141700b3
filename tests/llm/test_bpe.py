import hashlib
import random
import time

import numpy as np
import pytest
from tokenizers import Tokenizer

from lectern.llm import bpe
from lectern.llm.bpe import Codec, decode_of, encode_of, round_trip
from lectern.llm.tokens import VOCABULARY, encode

LIBRARY = Tokenizer.from_file(VOCABULARY)


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def strange_texts():
    rng = random.Random(1)
    blanks = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0　 ​﻿ab'sSre1² ½Ⅷ"
    parts = ["aaaa", "aa", "a", "<|endoftext|>", "<|endof", "don't", " ", "  ", "\n", "'ll", "1111", "é", "日本", "😀", "\0"]
    out = ["", " ", "<|endoftext|>", "a<|endoftext|><|endoftext|>b", "a" * 5000, " " * 5000, "ab" * 3000]
    for _ in range(400):
        out.append("".join(rng.choice(blanks) for _ in range(rng.randrange(40))))
        out.append("".join(rng.choice(parts) for _ in range(rng.randrange(30))))
        out.append("".join(chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(0x10000, 0x11000)])) for _ in range(20)))
    return out


def test_ids_and_text_equal_the_library():
    texts = strange_texts()
    own = Codec()
    for text, ids in zip(texts, own.encode_batch(texts), strict=True):
        assert ids.tolist() == ids_of(text) == encode(text)
        assert own.decode(ids) == text == LIBRARY.decode(ids.tolist(), skip_special_tokens=False)


def test_every_letter_of_unicode():
    letters = [chr(i) for i in range(0x30000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(f"a{c}b 1{c}!" for c in letters[i : i + 1000]) for i in range(0, len(letters), 1000)]
    assert [ids.tolist() for ids in Codec().encode_batch(texts)] == [ids_of(text) for text in texts]


def test_incomplete_bytes_decode_as_the_library_does():
    rng = random.Random(2)
    own = Codec()
    for _ in range(300):
        ids = [rng.randrange(50_257) for _ in range(10)]
        assert own.decode(np.array(ids)) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_small_blocks_and_cache(monkeypatch):
    texts = strange_texts()
    want = [ids.tolist() for ids in Codec().encode_batch(texts)]
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 100)
    monkeypatch.setattr(bpe, "CACHED_WORDS", 30)
    monkeypatch.setattr(bpe, "ROUND_SYMBOLS", 50)
    assert [ids.tolist() for ids in Codec().encode_batch(texts)] == want


@pytest.mark.parametrize("limit", [0, 3, 100])
def test_long_words_rank_by_rank(monkeypatch, limit):
    monkeypatch.setattr(bpe, "LONG_WORD", limit)
    rng = random.Random(limit)
    texts = strange_texts()[-600:]
    texts += ["".join(rng.choices(letters, k=rng.randrange(400))) for letters in ("ab", "aé", "the", "qwertyuiopasdf", "aAbB") for _ in range(40)]
    assert [ids.tolist() for ids in Codec().encode_batch(texts)] == [ids_of(text) for text in texts]


def test_a_word_of_a_million_letters():
    rng = random.Random(3)
    word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    begin = time.perf_counter()
    ids = Codec().encode_batch([word, "x" * 1_000_000])
    assert time.perf_counter() - begin < 60
    assert [i.tolist() for i in ids] == [encode(word), encode("x" * 1_000_000)]


def test_a_special_token_costs_nothing():
    words = " ".join(f"new{i}word" for i in range(20_000))
    begin = time.perf_counter()
    ids = Codec().encode_batch([words, "a<|endoftext|>b"])
    assert time.perf_counter() - begin < 3
    assert [i.tolist() for i in ids] == [ids_of(words), ids_of("a<|endoftext|>b")]


def test_query_against_the_library(answer, documents):
    got = {r.doc_id: r for r in answer("op10_bpe")}
    assert len(got) == len(documents)
    for d in documents:
        ids = ids_of(d.text)
        row = got[d.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()


def test_columns_and_edges(spark):
    rows = [(1, "héllo <|endoftext|> wörld", 7), (1, "héllo <|endoftext|> wörld", 7), (None, None, 8), (2, "", None), (3, "x " * 300_000, 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    assert {(r.doc_id, r.n_tokens) for r in round_trip(frame).collect()} == {(i, len(ids_of(t or ""))) for i, t, _ in rows}
    both = frame.select("text", encode_of("text").alias("ids")).select("text", "ids", decode_of("ids").alias("back"))
    for row in both.collect():
        assert row.ids == ids_of(row.text or "") and row.back == (row.text or "")


def test_empty(spark):
    assert round_trip(spark.createDataFrame([], "doc_id long, text string")).count() == 0

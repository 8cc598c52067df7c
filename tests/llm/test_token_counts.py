from __future__ import annotations

import random

import public_tokenizers
import pytest
from cases import by_repr, frame, odd_documents
from tokenizers import Tokenizer

from stratamart.llm import token_counts as tc

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def counter():
    return tc.MergeCounter(PATH)


def test_odd_documents(spark, library):
    rows = odd_documents() + [(7, "a <|endoftext|>b<|startoftext|><|ENDOFTEXT|>"), (8, "word " * 2500)]
    wanted = [(doc_id, len((text or "").encode()), library(text), library(text) > 2048) for doc_id, text in rows]
    found = [tuple(row) for row in tc.token_counts(frame(spark, rows), PATH).collect()]
    assert by_repr(found) == by_repr(wanted)


def test_every_code_point(library, counter):
    signs = [chr(code) for code in range(0x110000) if not 0xD800 <= code < 0xE000]
    for at in range(0, len(signs), 512):
        text = "".join(f"a{sign}b {sign}1{sign} " for sign in signs[at : at + 512])
        if library(text) != counter.count(text):
            assert [sign for sign in signs[at : at + 512] if library(f"a{sign}b {sign}1") != counter.count(f"a{sign}b {sign}1")] == []


def test_random_texts(library, counter):
    pick = random.Random(11)
    pool = [chr(code) for code in [*range(32, 127), *range(0xC0, 0x250), *range(0x300, 0x320)]]
    pool += list("\x1c\x85\xa0 Σİ하각ह़🙂‍\n\t") + ["<|endoftext|>", "'ll", "'S"]
    for _ in range(3000):
        text = "".join(pick.choice(pool) for _ in range(pick.randrange(60)))
        assert library(text) == counter.count(text), ascii(text)


def test_texts_in_parts(library, counter, monkeypatch):
    text = " ".join("x" * (at % 40) + "é <|endoftext|>\x1cy" for at in range(400))
    monkeypatch.setattr(tc, "PART_CHARS", 10)
    assert counter.count(text) == library(text)


def test_full_tables_begin_anew(library, counter):
    own = tc.MergeCounter(PATH)
    own.runs.most = own.words.most = 3
    text = "one two three four five one two three four " * 5
    assert own.count(text) == library(text) and len(own.runs) <= 3


def test_a_symbol_that_the_vocabulary_lacks(counter):
    own = tc.MergeCounter(PATH)
    own.vocabulary = own.vocabulary - {"b"}
    own.ranks = {}
    assert own.count_word("abc") == 2


def test_empty_table(spark):
    assert tc.token_counts(frame(spark, []), PATH).collect() == []

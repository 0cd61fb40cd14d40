import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strata.llm import tokens
from strata.llm.queries import vocabulary

ODD = [
    "", None, " \n", "don't it's 'S we'LL x'll, y'd. 'tis", "<|endoftext|> a<|startoftext|>b <|EndOfText|>",
    "éå İstanbul STRASSE ß ẞ ﬁ", "123abc4.5,6!? a,b.c;d'e", "ΑΣ σς İ", "a​b ﻿c d­d",
    "#hash### foo### a.'s b,'t c!!'re", "\x00a \x1fb a\x1cb\x1d\x1e", "\xa0a　b c\x85e", "漢字kanji,カナ 😀😀,a",
]


@pytest.fixture(scope="module")
def encoder():
    return tokens.WordIds(vocabulary())


def plain(texts):
    tokenizer = Tokenizer.from_file(vocabulary())
    return [tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]


def test_odd_texts(encoder):
    assert [x.tolist() for x in encoder.encode(ODD)] == plain(ODD)


def test_random_texts(encoder):
    rnd = random.Random(1)
    alphabet = "abzAZ019 ,.;:!?#$%&*'’-_<|>\t\n ́éß漢İ😀\xa0\x1c\x85"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 40))) for _ in range(3000)]
    assert [x.tolist() for x in encoder.encode(texts)] == plain(texts)


def test_long_text_and_a_table_that_starts_anew(encoder, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    texts = ["some words, and others. " * 100_000, "words and more words", "x" * 3_000]
    got = encoder.encode(texts)
    assert got[0].tolist() == plain([texts[0][:24]])[0] * 100_000
    assert [x.tolist() for x in got[1:]] == plain(texts[1:])


@pytest.mark.parametrize("mark", "\x1c\x1d\x1e\x1f")
def test_long_text_is_not_cut_inside_a_word(encoder, mark):
    head = "some words, and " * (1 << 16)
    text = head + f"{mark}- {mark}{mark}, the end"
    assert len(head) == 1 << 20 and "".join(tokens._pieces(text)) == text
    tail = plain([text[len(head) - 16 :]])[0]
    assert encoder.encode([text])[0].tolist()[-len(tail) :] == tail


def test_new_words_of_many_texts_are_learned_together(monkeypatch):
    encoder, calls = tokens.WordIds(vocabulary()), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: calls.append(len(words)) or learn(words))
    texts = [None, *(f"new{k} letters{'ab' * (k % 50)}, x" for k in range(1000))]
    got = [x.tolist() for x in encoder.encoded(pa.array(texts, pa.string()))]
    assert got == plain(texts) and len(calls) == 1
    monkeypatch.setattr(tokens, "GROUP", 500)
    assert [x.tolist() for x in encoder.encoded(pa.array(texts, pa.string()))] == got

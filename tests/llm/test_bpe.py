"""Pieces of whole runs of texts: ids as the library gives them for whole texts, and what is handed to it."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from innledger.llm import bpe

BPE = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(BPE)
PARTS = [
    *"aZ09 ' \n\t\r.,;-_#éß×́١½中　  \u0085​ ﻿\U0001f600\U00010330\0",
    *("'s", "'ll", "'S", "''", "don't", "  ", " \n", "\n\n", "’s", "<|endoftext|>", "<|endof", "text|>", " the", "Été"),
]


def encoded(cache, texts):
    ids, counts = cache.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    return [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)]


def test_random_texts_equal_the_library(monkeypatch):
    monkeypatch.setattr(bpe, "RUN_PIECES", 7)
    draw = random.Random(5)
    cache = bpe.PieceCache(BPE, 200)
    for _ in range(400):
        texts = ["".join(draw.choices(PARTS, k=draw.randrange(12))) for _ in range(draw.randrange(20))]
        want = [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]
        assert encoded(cache, [*texts, None, ""]) == [*want, [], []]
        part = pa.array([None, "a b", *texts], pa.string())[2:]
        assert cache.encode(part)[0].tolist() == sum(want, [])


def test_neighbours_of_every_kind_equal_the_library():
    cache = bpe.PieceCache(BPE)
    some = [chr(c) for c in (*range(0x600), *range(0x2000, 0x2070), *range(0x2FF0, 0x3010))]
    texts = [f"{a}{c}{b}" for c in some for a in ("a", "1", "!", "'", " ", "\n ", "") for b in ("s", "2", ".", " ", "\n", " b", "")]
    assert encoded(cache, texts) == [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_word_is_encoded_once_whatever_marks_follow(monkeypatch):
    cache = bpe.PieceCache(BPE)
    handed = []
    real = cache.encode_batch
    cache.encode_batch = lambda texts, **more: handed.extend(texts) or real(texts, **more)
    texts = [f"so wonderfully{mark} so\nwonderfully{mark}{i}" for i, mark in enumerate([",", ".", ";", "!", "...", "?!", ")", '"'] * 3)]
    assert encoded(cache, texts) == [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]
    assert "".join(handed).count("wonderfully") == 2  # with a space before, and without

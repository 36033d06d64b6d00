"""Backtracked ids against the library, and small vocabularies against plain merging."""

import hashlib
import os
import random
import sys

import public_tokenizers
import pytest
import sentencepiece

sys.path.insert(0, os.path.dirname(__file__))
from cases import ODD, frame, prose  # noqa: E402

from pathlark.llm import sentence_pieces as sp  # noqa: E402

PATH = public_tokenizers.path(sp.MODEL)
TEXTS = [
    *ODD, prose(1, 400), prose(1, 400), "▁x▁ ▁", "<s> a </s> <0x0A>", *(" " * k + "w" + " " * (k // 2) for k in range(1, 40, 3)),
    "日本語" * 2000, "ab" * 3000, " " * 3001, "éé ﬁ ﻿    ", "x" * 1_200_000,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_documents_equal_library(spark, library):
    docs = frame(spark, TEXTS)
    got = {r.doc_id: r for r in sp.decode(sp.encode(docs, PATH), PATH).collect()}
    digests = {r.doc_id: r for r in sp.digests(docs, PATH).collect()}
    assert len(got) == len(digests) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids = library.encode(text or "")
        assert len(got[i].ids) == 4 * len(ids) == 4 * digests[i].n_tokens, i
        assert bytes(got[i].ids) == b"".join(x.to_bytes(4, "little") for x in ids), i
        assert got[i].text == library.decode(ids), i
        assert digests[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_repeated_ids_and_empty_table(spark):
    docs = frame(spark, ["a b", None])
    twice = docs.unionByName(docs).withColumn("doc_id", docs.doc_id * 0)
    assert sp.digests(twice, PATH).count() == 4
    assert sp.digests(docs.filter("false"), PATH).count() == 0
    assert sp.digests(docs.withColumn("doc_id", docs.doc_id.cast("string").cast("long") * None), PATH).filter("doc_id is null").count() == 2


def test_random_pieces_equal_library(library):
    of, draw = sp.Encoder(PATH), random.Random(3)
    pieces = [p.replace("▁", " ") for p in of.merges.scores]
    for _ in range(4000):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(1, 12)))
        assert of.encode(text) == library.encode(text), repr(text)
        text = "".join(draw.choice("aeinrst hl▁ \n一é.,=-_*0019") for _ in range(draw.randint(1, 50)))
        assert of.encode(text) == library.encode(text), repr(text)


@pytest.mark.parametrize("seed", range(40))
def test_small_vocabularies_equal_plain_merging(seed):
    """Merges learned in any order over few letters: overlapping, equal and unreachable pieces, shared scores."""
    draw = random.Random(seed)
    pieces = ["a", "b", "c"]
    for _ in range(25):
        pieces.append("".join(draw.sample(pieces, 2) if draw.random() < 0.7 else [draw.choice(pieces)] * 2))
    pieces = list(dict.fromkeys(p for p in pieces if 1 < len(p) < 12))
    if seed % 4 == 3:
        draw.shuffle(pieces)  # parts may come after the whole
    scores = {p: -float(i) for i, p in enumerate(pieces)}
    if seed % 4 == 2:
        for p in pieces[len(pieces) // 2 :]:
            scores[p] = -99.0
    merges = sp.Merges(scores)
    for n in (1, 2, 3, 5, 8, 13, 60):
        for _ in range(60):
            text = "".join(draw.choice("abcd") for _ in range(n))
            assert merges.pieces(text) == merges.plainly(text), (scores, text)


def test_models_without_byte_fallback_are_refused(monkeypatch):
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "is_byte", lambda self, i: False)
    with pytest.raises(ValueError):
        sp.Encoder(PATH)

"""Byte BPE and wavelet shards against the libraries themselves."""

import base64
import hashlib
import os
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
from cases import ODD, frame, prose  # noqa: E402

from pathlark.llm import bpe, wavelet  # noqa: E402

TEXTS = [*ODD, prose(1, 400), prose(1, 400), prose(2, 3000), "y" * 3000 + " z", " \n " * 900 + "end", "e's " * 500]


@pytest.fixture(scope="module")
def tik():
    with open(public_tokenizers.path(bpe.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk,overlap", [(1 << 15, 512), (200, 60), (64, 64)])
def test_bpe_equals_library_and_round_trips(spark, tik, chunk, overlap):
    path = public_tokenizers.path(bpe.RANKS)
    got = {r.doc_id: (bytes(r.ids), bytes(r.bytes)) for r in bpe.decode(bpe.encode(frame(spark, TEXTS), path, chunk=chunk, overlap=overlap), path).collect()}
    for i, t in enumerate(TEXTS):
        want = np.asarray(tik.encode_ordinary(t or ""), dtype="<u4").tobytes()
        assert got[i] == (want, (t or "").encode()), i


def test_bpe_repeated_ids_and_empty_table(spark):
    path = public_tokenizers.path(bpe.RANKS)
    docs = frame(spark, ["a b", prose(3, 500)])
    twice = docs.unionByName(docs).withColumn("doc_id", docs.doc_id * 0)
    assert bpe.encode(twice, path, chunk=100, overlap=40).count() == 4
    assert bpe.digests(docs.filter("false"), path).count() == 0


def library_ids(text):
    t = Tokenizer.from_file(public_tokenizers.path(wavelet.TOKENIZER))
    t.encode_special_tokens = True
    return [*t.encode(text or "", add_special_tokens=False).ids, wavelet.END]


@pytest.mark.parametrize("size", [1 << 20, 50])
def test_shards_equal_library(spark, workdir, size):
    texts = [*TEXTS, "Hello, <|endoftext|> Σας ΣΑΣ. İstanbul don't DON'T x.,.,"]
    wavelet.write_shards(frame(spark, texts), public_tokenizers.path(wavelet.TOKENIZER), f"{workdir}/w", size=size)
    got = {r.doc_id: r for r in wavelet.token_index(spark, f"{workdir}/w").collect()}
    at = 0
    for i, t in enumerate(texts):
        ids = library_ids(t)
        assert (got[i].start, got[i].n_tokens) == (at, len(ids)), i
        assert got[i].ids_crc32 == zlib.crc32(np.asarray(ids, "<u4").tobytes())
        at += len(ids)


def test_empty_table_has_no_shards(spark, workdir):
    wavelet.write_shards(frame(spark, ["a"]).filter("false"), public_tokenizers.path(wavelet.TOKENIZER), f"{workdir}/w")
    assert wavelet.token_index(spark, f"{workdir}/w").count() == 0


@pytest.mark.parametrize("n,kinds", [(0, 1), (1, 1), (700, 1), (5000, 2), (5000, 700)])
def test_access_rank_and_select(n, kinds):
    ids = np.random.default_rng(n + kinds).integers(0, kinds, n) * 3 + 5
    shard = wavelet.Shard(wavelet.build(ids, np.array([7]), np.array([n])))
    assert shard.tokens().tolist() == ids.tolist()
    for i in range(0, n, 97):
        assert shard.access(i) == ids[i]
    for token in set(ids[:5].tolist()) | {1}:
        where = np.flatnonzero(ids == token)
        assert shard.count(token) == len(where)
        assert shard.count(token, n // 2) == (where < n // 2).sum()
        for j in range(0, len(where), 50):
            assert shard.locate(token, j) == where[j]
        with pytest.raises(IndexError):
            shard.locate(token, len(where))


def test_digest_columns(spark, tik):
    path = public_tokenizers.path(bpe.RANKS)
    row = bpe.digests(frame(spark, ["Hello there"]), path).collect()[0]
    ids = np.asarray(tik.encode_ordinary("Hello there"), "<u4")
    assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
    assert row.decoded_sha256 == hashlib.sha256(b"Hello there").hexdigest()


def test_query_equals_library_with_its_defaults(spark, workdir):
    texts = [*TEXTS, "end of page <|endoftext|> next page", "Σας<|startoftext|>A <|ENDOFTEXT|> b", "<|endoftext|>", "a <|endoftext| > b"]
    frame(spark, texts).select("doc_id", "text").write.parquet(f"{workdir}/documents.parquet")
    got = {r.doc_id: r for r in wavelet.op5_token_shards(spark, workdir).collect()}
    whole, at = Tokenizer.from_file(public_tokenizers.path(wavelet.TOKENIZER)), 0
    for i, t in enumerate(texts):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, wavelet.END]
        assert (got[i].start, got[i].n_tokens) == (at, len(ids)), i
        assert got[i].ids_crc32 == zlib.crc32(np.asarray(ids, "<u4").tobytes())
        at += len(ids)

"""Removed bytes against a dictionary of all windows."""

import hashlib
import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from cases import ODD, frame, prose  # noqa: E402

from pathlark.llm import substrings  # noqa: E402


def brute(texts, length):
    seen, out = set(), {}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            w = data[p : p + length]
            if w in seen:
                gone[p : p + length] = True
            seen.add(w)
        edge = np.diff(np.r_[0, gone.astype(int), 0])
        spans = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[i] = (len(data), spans, hashlib.sha256(kept).hexdigest())
    return out


def texts():
    out = [*ODD, "", "x" * 5000, "ab" * 700, "abc" * 400 + "ab" * 300]
    base = [prose(i, 220) for i in range(5)]
    out += base + base[:2]
    rng = np.random.default_rng(2)
    for k in range(40):
        words = prose(100 + k, 120).split(" ")
        a = int(rng.integers(0, 150))
        part = base[k % 5].split(" ")[a : a + int(rng.integers(10, 60))]
        out.append(" ".join(words[:60] + part + words[60:]))
        out.append(" ".join(w if rng.random() > 0.04 else w + "q" for w in base[k % 5].split(" ")))
    passage = " ".join(base[0].split(" ")[40:60])
    out += [prose(300 + k, 15) + " " + passage + " " + prose(400 + k, 15) for k in range(30)]
    out += [passage + "é" * k + "日本" * 60 + passage * 2 for k in range(4)]
    return out


@pytest.mark.parametrize("hot,held", [(substrings.HOT, substrings.HELD), (3, substrings.HELD), (3, 50)])
def test_same_as_all_windows(spark, monkeypatch, hot, held):
    monkeypatch.setattr(substrings, "HELD", held)
    all_texts = texts()
    rows = substrings.repeated_spans(frame(spark, all_texts).repartition(5, "doc_id"), hot=hot).collect()
    got = {r.doc_id: (r.n_bytes, [(s.start, s.end) for s in r.spans], r.kept_sha256) for r in rows}
    want = brute(all_texts, 100)
    assert len(rows) == len(all_texts)
    assert {i: (got[i], want[i]) for i in want if got[i] != want[i]} == {}


def test_short_length(spark):
    all_texts = [prose(i, 40) for i in range(30)] + ["abab" * 20]
    rows = substrings.repeated_spans(frame(spark, all_texts), length=20, gram=8).collect()
    want = brute(all_texts, 20)
    assert {r.doc_id: (r.n_bytes, [(s.start, s.end) for s in r.spans], r.kept_sha256) for r in rows} == want


def test_table_against_all_windows(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    want = brute([r.text for r in rows], 100)
    got = {r.doc_id: r for r in substrings.op1_repeated_substrings(spark, sf).collect()}
    for i, r in enumerate(rows):
        n, spans, sha = want[i]
        assert (got[r.doc_id].n_bytes, got[r.doc_id].n_removed, got[r.doc_id].n_spans, got[r.doc_id].kept_sha256) == (n, sum(b - a for a, b in spans), len(spans), sha)


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = frame(spark, [prose(1, 100)])
    rows = substrings.repeated_spans(docs.unionByName(docs).unionByName(docs.withColumn("doc_id", docs.doc_id * 0 + None))).collect()
    assert [len(r.spans) for r in rows] == [0, 0, 0]
    assert substrings.repeated_spans(docs.filter("false")).count() == 0


def test_previous_and_next_smaller():
    rng = np.random.default_rng(0)
    run = np.sort(rng.integers(0, 20, 200))
    position = rng.permutation(200)
    want = [any(position[j] < position[i] for j in range(200) if run[j] == run[i]) for i in range(200)]
    assert substrings.previous_factors(position, run).tolist() == want

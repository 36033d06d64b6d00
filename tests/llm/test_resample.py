"""Importance resampling against a plain computation, and its bracket on hard distributions."""

import hashlib
import math
import os
import re
import sys
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from cases import ODD, frame, prose  # noqa: E402

from pathlark.llm import resample as R  # noqa: E402
from pathlark.llm.common import text_buffer  # noqa: E402

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def bags(text, longest):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(texts, target, buckets, longest, percent, least):
    of = lambda x: zlib.crc32(x.encode()) % buckets
    s, t = (Counter(of(f) for x in some for f in bags(x, longest)[1]) for some in (texts, target))
    S, T = sum(s.values()), sum(t.values())
    rows = []
    for i, x in enumerate(texts):
        words, found = bags(x, longest)
        gains = [math.floor(1000 * math.log((t[of(f)] + 1.0) * (S + buckets) / ((s[of(f)] + 1.0) * (T + buckets)))) for f in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0]))
    rank = {r[0]: k for k, r in enumerate(able[: percent * len(able) // 100], 1)}
    return [(*r, rank.get(r[0])) for r in rows]


TEXTS = [*ODD, *(prose(i, 5 + 3 * i) for i in range(40)), "Été " * 30, "X" * 70 + " " + "x" * 70 + " é" + "ü" * 40, "a" * 1_100_000, "A\x00b/c:d@e`f{g"]
TARGET = [None, "", prose(3, 50), prose(5, 80), "été a"]


@pytest.mark.parametrize("buckets,longest,percent,least", [(10_000, 1, 10, 20), (64, 3, 50, 0), (1000, 2, 100, 5), (64, 1, 1, 20)])
def test_equals_plain_computation(spark, buckets, longest, percent, least):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = R.resampled(frame(spark, TEXTS), target, buckets, longest, percent, least, accuracy=20)
    assert sorted(tuple(r) for r in got.collect()) == brute(TEXTS, TARGET, buckets, longest, percent, least)


def test_checksums():
    flat, at = text_buffer(pa.array(TEXTS))
    low, starts, ends, rows = R.words(flat, at)
    state = R.fed(np.full(len(starts), 0xFFFFFFFF, np.uint32), low, starts, ends) ^ np.uint32(0xFFFFFFFF)
    want = [(i, zlib.crc32(w.encode())) for i, t in enumerate(TEXTS) for w in bags(t, 1)[0]]
    assert list(zip(rows.tolist(), state.tolist(), strict=True)) == want


@pytest.mark.parametrize("kind", ["all equal", "half equal", "two", "wide", "one"])
@pytest.mark.parametrize("percent", [10, 100])
def test_cutoff_of_hard_distributions(spark, kind, percent):
    n = 1 if kind == "one" else 1000
    value = {"all equal": lambda i: 5, "half equal": lambda i: 7 if i % 2 else -i, "two": lambda i: i % 2, "wide": lambda i: (i * 7919) % 1000 - 500,
             "one": lambda i: 3}[kind]
    rows = [(i // 2 * 2 if kind == "two" else i, 20 if i % 10 else 19, 20, 0, value(i)) for i in range(n)] + [(None, 30, 30, 0, 5)]
    rows += rows[-3:]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    got = [tuple(r) for r in R.drawn(scored, percent, 20, accuracy=10).collect()]
    assert sorted(map(str, (r[:5] for r in got))) == sorted(map(str, rows))
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    want = able[: percent * len(able) // 100]
    ranked = sorted((r for r in got if r[5] is not None), key=lambda r: r[5])
    assert [r[5] for r in ranked] == list(range(1, len(want) + 1))
    assert [r[:5] for r in ranked] == want


def test_query_equals_sql(spark, workdir):
    docs = frame(spark, [t for t in TEXTS if len(t or "") < 10_000]).withColumn("doc_id", F.when(F.col("doc_id") != 12, F.col("doc_id")))
    docs.unionByName(docs.filter("doc_id % 7 = 1")).write.parquet(f"{workdir}/documents.parquet")
    spark.createDataFrame([(i, t) for i, t in enumerate(TARGET)], "item_id long, text string").write.parquet(f"{workdir}/benchmark.parquet")
    got = R.op13_importance_resampling(spark, workdir)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{workdir}/{name}.parquet/*.parquet'")
    rel = con.sql(R.ORACLE)
    at = [rel.columns.index(c) for c in got.columns]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=str)


def test_empty_tables(spark, workdir):
    target = spark.createDataFrame([], "text string")
    assert R.resampled(frame(spark, ["a"]).filter("false"), target).count() == 0
    assert sorted(tuple(r) for r in R.resampled(frame(spark, TEXTS), target).collect()) == brute(TEXTS, [], 10_000, 1, 10, 20)

"""Line classes against all pairs of lines with a plain edit distance."""

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from cases import ODD, frame, prose  # noqa: E402

from pathlark.llm import lines  # noqa: E402


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, s, n):
    s = list(s)
    for _ in range(n):
        at, what = rng.randrange(len(s) + 1), rng.randrange(3)
        if what == 0:
            s.insert(at, rng.choice("abcé日"))
        elif s:
            at = min(at, len(s) - 1)
            s[at : at + 1] = [] if what == 1 else rng.choice("xyzé")
    return "".join(s)


def test_banded_distance():
    rng = random.Random(1)
    pairs = []
    for _ in range(600):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 40)))
        pairs.append((a, edited(rng, a, rng.randrange(0, 6))))
    for edits in (1, 2, 3):
        arrays = [[np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in x] for x in zip(*pairs, strict=True)]
        got = lines.within(arrays[0], arrays[1], edits)
        assert got.tolist() == [distance(a, b) <= edits for a, b in pairs]


def brute(texts, edits, least):
    places = [(d, i, s) for d, t in enumerate(texts) for i, s in enumerate((t or "").split("\n")) if s.strip(" \t\v\f\r")]
    root = list(range(len(places)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for j in range(len(places)):
        for i in range(j):
            a, b = places[i][2], places[j][2]
            near = min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= edits
            if find(i) != find(j) and (a == b or near and distance(a, b) <= edits):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    out = {d: [] for d in range(len(texts))}
    for j, (d, i, _) in enumerate(places):
        if find(j) != j:
            out[d].append(i)
    return out


def made_up():
    rng = random.Random(7)
    base = ["".join(rng.choice("abcdefgh é日") for _ in range(rng.randrange(6, 45))) for _ in range(25)]
    texts = list(ODD)
    for _ in range(30):
        texts.append("\n".join(edited(rng, rng.choice(base), rng.randrange(0, 4)) for _ in range(rng.randrange(1, 8))))
    texts += ["ok\nno\n\n \nok", "ok\n--\n\t", "no\nnO\n--"]
    texts += [f"line number {k:04d} of the same table, with a counter" for k in range(0, 40, 3)]
    texts += ["same first line of all\n" + prose(k, 12) for k in range(8)]
    return texts


@pytest.mark.parametrize("edits,least,dense", [(2, 12, lines.DENSE), (1, 8, lines.DENSE), (3, 12, lines.DENSE), (2, 12, 1)])
def test_classes_equal_all_pairs(spark, edits, least, dense):
    texts = made_up()
    rows = lines.near_lines(frame(spark, texts).repartition(4, "doc_id"), edits, least, dense).collect()
    want = brute(texts, edits, least)
    assert {r.doc_id: r.removed for r in rows} == want
    assert all(r.n_lines == len((texts[r.doc_id] or "").split("\n")) for r in rows) and sum(map(len, want.values())) > 40


def test_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    got = {r.doc_id: r for r in lines.op2_near_lines(spark, sf).collect()}
    # beyond exact copies by definition: lines of all pairs of near lengths would take long here
    seen, exact = set(), {}
    for d, t in enumerate(texts):
        own = t.split("\n")
        exact[d] = [i for i, s in enumerate(own) if s.strip() and (s in seen or seen.add(s))]
    assert all(set(exact[d]) <= set(got[d].removed) for d in exact) and sum(map(len, exact.values())) > 10


def test_texts_without_lines_and_edge_cases(spark):
    line = "a line that is long enough to be compared"
    docs = frame(spark, [f"x\n{line}\ny", f"{line}!\nshort", None, line])
    both = docs.unionByName(docs).unionByName(docs.withColumn("doc_id", docs.doc_id * 0 + None))
    found = lines.near_lines(both)
    assert found.count() == 12
    out = lines.without_lines(both, found)
    assert out.columns == both.columns and out.count() == 12
    assert {(r.doc_id, r.text) for r in out.collect() if r.doc_id is not None} == {(0, f"x\n{line}\ny"), (1, "short"), (2, None), (3, "")}
    assert lines.near_lines(docs.filter("false")).count() == 0

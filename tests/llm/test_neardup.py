"""Near-duplicate classes against all pairs compared by the definition."""

import os
import sys
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from cases import ODD, frame, prose  # noqa: E402

from pathlark.llm import links, neardup  # noqa: E402


def bag(text):
    words = [w for w in (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").replace("\v", " ").split(" ") if w]
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) > 4 else Counter([tuple(words)] if words else [])


def by_definition(a, b):
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a | b) for i in a if i in b)


def brute(texts):
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    bags = [bag(t) for t in texts]
    for j in range(len(texts)):
        for i in range(j):
            if (texts[i] or "") == (texts[j] or "") or (set(bags[i]) & set(bags[j]) and by_definition(bags[i], bags[j]) >= 0.8 - 1e-9):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in range(len(texts))}


def edited(text, every, shift=0):
    return " ".join(w + "x" if (i + shift) % every == every - 1 else w for i, w in enumerate(text.split()))


@pytest.fixture(scope="module")
def texts():
    out = [*ODD, "", None, "a", "one two three", "one two three", ODD[6]]
    for s in range(4):
        base = prose(s, 150)
        out += [base, base, edited(base, 60), edited(base, 70, 9), edited(base, 40, 3), edited(base, 25), base + " " + prose(s + 90, 12)]
    chain = prose(40, 200)
    for k in range(8):  # each like the next one, the ends unlike each other
        chain = " ".join(w + str(k) if k * 24 <= i < k * 24 + 12 else w for i, w in enumerate(chain.split()))
        out.append(chain)
    return out + [(prose(5, 30) + " \n ") * 6, (prose(5, 30) + " \n ") * 7]


def test_classes_equal_all_pairs(spark, texts):
    want = brute(texts)
    rows = neardup.classes(frame(spark, texts)).collect()
    assert {r.doc_id: r.class_id for r in rows} == want and len(rows) == len(texts)
    assert all(r.kept == (r.doc_id == r.class_id) for r in rows)


def test_documents_of_the_small_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id")
    rows = docs.select("doc_id", "text").collect()
    want = brute([r.text for r in rows])
    ids = [r.doc_id for r in rows]
    got = {r.doc_id: r.class_id for r in neardup.op4_near_duplicates(spark, sf).collect()}
    assert got == {ids[i]: ids[k] for i, k in want.items()}


def test_similarity_by_definition():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a = Counter({int(i): int(rng.integers(1, 6)) for i in rng.choice(30, 12, False)})
        b = Counter({int(i): int(rng.integers(1, 6)) for i in rng.choice(30, 9, False)})
        pack = lambda c: np.asarray(sorted(c), "<u8").tobytes() + np.asarray([c[k] for k in sorted(c)], "<u4").tobytes()
        assert abs(neardup.probability_jaccard(pack(a), pack(b)) - by_definition(a, b)) < 1e-9


def test_components_agree_in_share_with_similarity():
    a = {i: 1 + i % 3 for i in range(200)}
    b = {i: 1 + i % 3 for i in range(40, 240)}
    rows = np.r_[np.zeros(200, int), np.ones(200, int)]
    found = neardup.mix(np.asarray([*a, *b], dtype=np.uint64))
    names = neardup.prob_min_hash(rows, found, np.asarray([*a.values(), *b.values()]), 2, 4096)
    assert abs((names[0] == names[1]).mean() - by_definition(Counter(a), Counter(b))) < 0.04


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 160)}


def star(n, words=200, edits=4, seed=5):
    """A text and n copies, each alike to it by 0.8 or a little more and less to each other."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}x{int(rng.integers(1000))}" for i in range(words)]
    out = [" ".join(base)]
    for k in range(n):
        own = list(base)
        for at in rng.choice(np.arange(8, words - 8, 5), edits, False):
            own[at] = f"e{k}y{at}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("middle", [0, 150])
def test_edited_copies_of_one_text_are_one_class(spark, middle):
    """Found only through the text they were made from, whichever document that is. Another family stays apart."""
    family, other = star(300), star(40, seed=6)
    family = family[1 : middle + 1] + family[:1] + family[middle + 1 :]
    some = [neardup_bag(t) for t in (family[middle], family[0 if middle else 1], family[-1])]
    assert min(neardup.probability_jaccard(some[0], x) for x in some[1:]) >= 0.8 > neardup.probability_jaccard(*some[1:])
    rows = neardup.classes(frame(spark, family + other).repartition(5, "text")).collect()
    assert {r.class_id for r in rows} == {0, 301}


def neardup_bag(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    _, found, weights = neardup.weighted(raw, np.array([0, len(raw)]))
    return found.tobytes() + weights.astype("<u4").tobytes()


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = frame(spark, [prose(1, 50), prose(2, 50)])
    twice = docs.unionByName(docs).unionByName(docs.withColumn("doc_id", docs.doc_id * 0 + None))
    rows = neardup.classes(twice).collect()
    assert len(rows) == 6 and {(r.doc_id, r.class_id, r.kept) for r in rows} == {(0, 0, True), (1, 1, True), (None, None, True)}
    assert neardup.classes(docs.filter("false")).count() == 0


def grown(n, words=160, seed=11):
    """Each text is an earlier one with a few words replaced."""
    rng = np.random.default_rng(seed)
    out = [[f"w{seed}x{i}" for i in range(words)]]
    for k in range(1, n):
        own = list(out[int(rng.integers(len(out)))])
        for at in rng.choice(words, int(rng.integers(1, 5)), False):
            own[at] = f"e{k}y{at}"
        out.append(own)
    return [" ".join(x) for x in out]


def of_all_pairs(bags, buckets, similarity=0.8):
    """The smallest number of each one's class if all pairs of all buckets are compared."""
    root = np.arange(len(bags))
    for own in buckets:
        for i in own:
            for j in own:
                if root[i] != root[j] and neardup.probability_jaccard(bags[i], bags[j]) >= similarity - 1e-9:
                    low, high = sorted((root[i], root[j]))
                    root[root == high] = low
    return root.tolist()


@pytest.mark.parametrize("tile", [neardup.TILE, 9])
def test_all_pairs_of_a_bucket_count(spark, tile):
    """One band of one component: a pair that is not compared in its bucket is found in no other."""
    texts = grown(150) + grown(90, seed=12)
    bags = [neardup_bag(t) for t in texts]
    names = []
    for t in texts:
        raw = np.frombuffer(t.encode(), np.uint8)
        names.append(int(neardup.prob_min_hash(*neardup.weighted(raw, np.array([0, len(raw)])), 1, 1)[0, 0]))
    want = of_all_pairs(bags, [[i for i, x in enumerate(names) if x == n] for n in sorted(set(names))])
    rows = neardup.classes(frame(spark, texts).repartition(5, "text"), bands=1, rows=1, tile=tile).collect()
    assert {r.doc_id: r.class_id for r in rows} == dict(enumerate(want))


@pytest.mark.parametrize("across", [False, True])
def test_crossing_links_what_all_pairs_link(across):
    rng = np.random.default_rng(3)
    bags, roots = [], []
    for family in range(4):
        shingles = np.sort(rng.integers(1 << 62, size=60).astype(np.uint64))
        for k in range(12):
            counts = np.maximum(1, rng.integers(-1, 4, 60)) if family % 2 else np.ones(60, int)
            counts[rng.choice(60, k, False)] = 0
            bags.append(shingles[counts > 0].tobytes() + counts[counts > 0].astype("<u4").tobytes())
            roots.append(100 * family + k // 2)
    tile, roots = np.arange(len(bags)) % 2, np.array(roots)
    some = neardup.crossing([*bags, b""], np.r_[tile, 0], np.r_[roots, 999], across, 0.7)
    assert all(neardup.probability_jaccard(bags[i], bags[j]) >= 0.7 and roots[i] != roots[j] and not (across and tile[i] == tile[j]) for i, j in some)
    same = [(i, j) for i in range(48) for j in range(i) if roots[i] == roots[j]]
    wanted = [(i, j) for i in range(48) for j in range(i) if neardup.probability_jaccard(bags[i], bags[j]) >= 0.7 and not (across and tile[i] == tile[j])]

    def classes_of(pairs):
        root = list(range(48))
        for i, j in pairs:
            root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
        return root

    assert classes_of(same + some) == classes_of(same + wanted) and some

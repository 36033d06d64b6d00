"""Benchmark passages against all windows of all documents."""

import os
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))
from cases import ODD, frame, prose  # noqa: E402

from pathlark.llm import decontaminate as dc  # noqa: E402


def grams(words):
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or [tuple(words)]


def alike(a, b):
    rest, shared = list(b), 0
    for x in a:
        if x in rest:
            rest.remove(x)
            shared += 1
    return shared / (len(a) + len(b) - shared)


def brute(texts, items):
    out = {}
    for d, t in enumerate(texts):
        words = (t or "").lower().split()
        for i, item in items:
            want = (item or "").lower().split()
            m = len(want)
            if not want or not words or len(words) < m < 5:
                continue
            best = max((alike(grams(words[s : s + m]), grams(want)), -s) for s in range(max(1, len(words) - m + 1)))
            if best[0] >= 0.8:
                out[d, i] = (-best[1], round(best[0], 9))
    return out


def test_same_as_all_windows(spark):
    odd = [x for x in ODD if x is None or x.isascii()]
    items = [(i, prose(50 + i, n)) for i, n in enumerate((12, 25, 40, 40, 70))] + [(7, "two words"), (8, None), (9, " "), (10, prose(52, 40))]
    texts = list(odd)
    for i in range(5):
        words = items[i][1].split()
        texts.append(prose(i, 60) + " " + " ".join(words) + " " + prose(i + 9, 80))
        texts.append(" ".join(words[: len(words) // 2]) + " EXTRA " + " ".join(words[len(words) // 2 :]))
        texts.append(prose(i + 30, 300) + " " + items[i][1].upper())
        texts.append(" ".join(words[: int(len(words) * 0.85)]))
    texts += [prose(77, 100), "zero two words one", "two words", texts[-3]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(texts, items)
    assert len(want) > 12
    for chars in (dc.ITEM_CHARS, 300):
        rows = dc.contamination(frame(spark, texts), bench, item_chars=chars).collect()
        got = {(r.doc_id, r.item_id): (r.start_word, round(r.similarity, 9)) for r in rows}
        assert got == want and len(rows) == len(want)


def test_all_fingerprints_within_the_radius_are_found():
    rng = np.random.default_rng(3)
    items = dc.Items([(i, prose(i, 20)) for i in range(60)])
    own = items.by_size[m] if (m := max(items.by_size, key=lambda k: len(items.by_size[k]))) else None
    prints = np.concatenate([items.prints[own] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, False))) for k in range(0, 30)])
    w, i, away = items.within(m, prints)
    distance = np.bitwise_count(prints[:, None] ^ items.prints[own])
    assert {(a, b) for a, b in zip(w.tolist(), i.tolist(), strict=True)} == {(a, int(own[b])) for a, b in zip(*np.nonzero(distance <= dc.RADIUS), strict=True)}
    assert (away <= dc.RADIUS).all()


def test_empty_tables(spark):
    docs, bench = frame(spark, ["a b c d e f"]), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert dc.contamination(docs.filter("false"), bench).count() == 0
    assert dc.contamination(docs, bench.filter("false")).count() == 0
    assert dc.contamination(docs.unionByName(docs), bench).count() == 2

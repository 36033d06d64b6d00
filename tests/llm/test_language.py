"""Language labels: the shortcut against plain Viterbi, learning only from rows not held out, edge cases."""

import os
import sys
import zlib

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))
from cases import ODD, frame  # noqa: E402

from pathlark.llm import language  # noqa: E402

DE = "der schnelle braune fuchs springt über den faulen hund und läuft durch den wald nach hause weil es regnet "
EN = "the quick brown fox jumps over the lazy dog and runs through the forest towards home because it rains "


def plain_viterbi_value(scores, penalty):
    best = scores[0].copy()
    for row in scores[1:]:
        best = np.maximum(best, best.max() - penalty) + row
    return best.max()


def test_labels_reach_the_best_value():
    rng = np.random.default_rng(5)
    for _ in range(60):
        sizes = rng.integers(1, 30, 5)
        scores = -rng.gamma(1.0, rng.choice([1, 8]), (sizes.sum(), 3))
        opens = np.r_[0, np.cumsum(sizes)[:-1]]
        got = language.labels(scores, opens, 7.0)
        for a, n in zip(opens, sizes, strict=True):
            own, path = scores[a : a + n], got[a : a + n]
            value = own[np.arange(n), path].sum() - 7.0 * (path[1:] != path[:-1]).sum()
            assert abs(value - plain_viterbi_value(own, 7.0)) < 1e-6


def train(spark):
    rows = [(i, (DE if i % 2 else EN) * 3, "de" if i % 2 else "en") for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_spans_of_mixed_text_and_odd_rows(spark):
    model = language.fit(train(spark))
    assert model["langs"] == ["de", "en"]
    texts = [*ODD, DE, EN * 3 + DE * 2, "日本語 漢字", "1234 !!"]
    got = {r.doc_id: r for r in language.predict(frame(spark, texts), model).collect()}
    assert len(got) == len(texts)
    n = len(ODD)
    assert [got[i].lang_pred for i in (0, 1, 2, 3)] == ["und"] * 4 and got[0].score == 0
    assert got[n].lang_pred == "de" and got[n].score == 1
    mixed = got[n + 1]
    assert mixed.lang_pred == "en" and [s.lang for s in mixed.spans] == ["en", "de"]
    assert abs(mixed.spans[1].start - len(EN) * 3) < 12
    assert got[n + 2].score == 0 and got[n + 2].lang_pred in model["langs"]
    assert got[n + 3].lang_pred == "und"


def test_held_out_rows_teach_nothing(spark):
    docs = train(spark)
    held = {r.doc_id for r in docs.filter(language.held_out()).collect()}
    assert held == {i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 0}
    only = docs.filter(language.held_out())
    assert language.fit(only)["langs"] == []
    assert {r.lang_pred for r in language.predict(only, language.fit(only)).collect()} == {"und"}
    assert language.predict(docs.filter("false"), language.fit(docs)).count() == 0


def test_held_out_accuracy(spark, sf):
    got = language.op7_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out").toPandas()
    assert (held["lang"] == held["lang_pred"]).mean() > 0.97

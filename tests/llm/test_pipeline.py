"""The pipeline against the brute-force versions of its stages, one after the other, on one small table."""

import base64
import os
import sys

import numpy as np
import public_tokenizers
import tiktoken

sys.path.insert(0, os.path.dirname(__file__))
import test_decontaminate  # noqa: E402
import test_lines  # noqa: E402
import test_neardup  # noqa: E402
from cases import frame  # noqa: E402
from test_language import DE, EN  # noqa: E402

import corpus_pipeline  # noqa: E402
from pathlark.llm import lines  # noqa: E402


def table():
    rng = np.random.default_rng(11)

    def prose(words, n):
        return " ".join(rng.choice(words.split(), n))

    texts = [prose(DE if k % 2 else EN, 40) + "\n" + prose(DE if k % 2 else EN, 12) for k in range(30)]
    items = [(k, prose(EN, 30)) for k in range(4)]
    for k in range(6):
        texts.append(texts[k])  # copies
        near = texts[k + 10].split(" ")
        near[3] = "edited"
        texts.append(" ".join(near))
        texts.append(texts[k + 20].replace("\n", "! \n", 1))  # a line within two edits
    texts += [prose(EN, 30) + " " + items[k][1] + "\n" + prose(EN, 20) for k in range(4)]
    texts += [None, "", "12345 678", "日本語 漢字 かな", "short"]
    return texts, items


def test_same_as_brute_force(spark, workdir):
    texts, items = table()
    docs = frame(spark, texts).withColumn("lang", corpus_pipeline.F.expr("CASE WHEN doc_id < 30 THEN IF(doc_id % 2 = 1, 'de', 'en') END"))
    docs.write.parquet(f"{workdir}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{workdir}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, workdir).collect()}

    kept = {i: t for i, t in enumerate(texts) if t and any(c.isalpha() and c < "ɐ" for c in t)}
    ids = list(kept)
    gone = test_lines.brute([kept[i] for i in ids], lines.EDITS, lines.MIN_CHARS)
    kept = {i: "\n".join(s for n, s in enumerate(kept[i].split("\n")) if n not in gone[k]) for k, i in enumerate(ids)}
    root = test_neardup.brute([kept[i] for i in ids])
    kept = {i: kept[i] for k, i in enumerate(ids) if root[k] == k}
    ids = list(kept)
    hit = {d for d, _ in test_decontaminate.brute([kept[i] for i in ids], items)}
    kept = {i: kept[i] for k, i in enumerate(ids) if k not in hit}
    assert 4 <= len(hit) and len(kept) < len(texts) - 12
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tik = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {i: np.frombuffer(r.ids, "<u4").tolist() for i, r in got.items()} == {i: tik.encode_ordinary(t) for i, t in kept.items()}


def test_stages_keep_columns_and_clean_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert out.count() > 0.8 * docs.count()
        empty = stage(spark, docs.filter("false"), sf)
        assert empty.columns == docs.columns and empty.count() == 0


def test_near_duplicates_compare_all_pairs_of_a_bucket(spark, monkeypatch):
    """With one band of one component, links that all pairs of a bucket give are the only ones."""
    from test_neardup import grown, neardup, neardup_bag, np, of_all_pairs

    texts = grown(150)
    bags = [neardup_bag(t) for t in texts]
    buckets = {}
    for i, t in enumerate(texts):
        raw = np.frombuffer(t.encode(), np.uint8)
        buckets.setdefault(int(neardup.prob_min_hash(*neardup.weighted(raw, np.array([0, len(raw)])), 1, 1)[0, 0]), []).append(i)
    whole = neardup.classes
    monkeypatch.setattr(neardup, "classes", lambda docs: whole(docs, bands=1, rows=1))
    kept = corpus_pipeline.near_duplicates(spark, frame(spark, texts), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(of_all_pairs(bags, buckets.values())))

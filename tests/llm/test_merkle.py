"""The manifest against a plain recursion, its SQL, and proofs that tampering breaks."""

import hashlib
import os
import sys
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from cases import ODD, frame, prose  # noqa: E402

from pathlark.llm import merkle  # noqa: E402


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def tree(nodes, fan):
    """Root, and per leaf the (left, right) digests of each level."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(where):
            first = at - at % fan
            paths[i].append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + fan])))
        nodes = [sha(*nodes[a : a + fan]) for a in range(0, len(nodes), fan)]
        where = [at // fan for at in where]
    return nodes[0], paths


def brute(rows, fan):
    """rows of (group, key, hash); per row its (subroot, root, path), in the order of the groups."""
    groups = {}
    for g, key, h in rows:
        groups.setdefault(g, []).append((key is not None, key or 0, h, key))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = {g: (sorted(groups[g]), *tree([h for *_, h, _ in sorted(groups[g])], fan)) for g in order}
    root, tops = tree([built[g][1] for g in order], fan)
    return sorted((str(g), str(key), h, built[g][1], root, tuple(path + top))
                  for g, top in zip(order, tops, strict=True) for (_, _, h, key), path in zip(built[g][0], built[g][2], strict=True))


@pytest.mark.parametrize("fan,levels,sizes", [(2, 2, [1, 2, 3, 37, 64, 5]), (2, 10, [70, 1]), (3, 1, [29, 1, 4]), (5, 2, [26, 125]), (2, 3, [1])])
def test_manifest_equals_recursion(spark, fan, levels, sizes):
    rows = []
    for g, n in enumerate(sizes):
        for i in range(n):
            key = None if i == n // 2 and n > 3 else (i * 7919) % 1000 // (2 if g == 1 else 1)  # a null, and ties
            rows.append((None if g == 0 else f"é{g}" if g % 2 else f"z{g}", key, sha(str(g), str(i))))
    rows += rows[-1:] * 3  # repeated rows
    leaves = spark.createDataFrame(rows, "grp string, key long, hash string").withColumn("block", F.lit("clash")).withColumn("total", F.lit(1))
    leaves = leaves.drop("block", "total")
    got = merkle.manifest(leaves, [F.col("key")], fan, levels)
    got = sorted((str(r.grp), str(r.key), r.hash, r.subroot, r.root, tuple((x.left, x.right) for x in r.path)) for r in got.collect())
    assert got == brute(rows, fan)


def test_folding_leads_to_the_root_and_tampering_does_not(spark):
    rows = [("a" if i % 3 else None, i, sha(str(i))) for i in range(50)]
    out = merkle.manifest(spark.createDataFrame(rows, "grp string, key long, hash string"), [F.col("key")], 3, 1)
    out = out.withColumn("same", merkle.folded(F.col("hash"), F.col("path")) == F.col("root"))
    out = out.withColumn("other", merkle.folded(F.sha2("hash", 256), F.col("path")) == F.col("root"))
    assert out.filter("same AND NOT other").count() == 50


def test_query_equals_sql_and_recursion(spark, workdir):
    texts = [*ODD, prose(1, 30), prose(1, 30), "1:2-", *(str(i) for i in range(60))]
    docs = frame(spark, texts).withColumn("doc_id", F.when(F.col("doc_id") != 40, F.col("doc_id")))
    docs = docs.unionByName(docs.filter("doc_id % 10 = 3")).withColumn("n_chars", F.when(F.col("doc_id") != 14, F.col("n_chars")))
    docs.write.parquet(f"{workdir}/documents.parquet")
    got = merkle.op12_merkle_manifest(spark, workdir)
    rows = sorted(got.collect(), key=str)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{workdir}/documents.parquet/*.parquet'")
    rel = con.sql(merkle.ORACLE)
    at = [rel.columns.index(c) for c in got.columns]
    assert [tuple(r) for r in rows] == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=lambda r: _as(got.columns, r))
    hashes = [(r.lang, r.doc_id, sha(*(field(r[c]) for c in merkle.FIELDS))) for r in spark.read.parquet(f"{workdir}/documents.parquet").collect()]
    want = {(k, h): (sub, root, path) for _, k, h, sub, root, path in brute(hashes, 2)}
    for r in rows:
        sub, root, path = want[str(r.doc_id), r.leaf]
        assert (r.subroot, r.root) == (sub, root)
        hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
        if not hit:
            assert r.verified and r.folded_root == root
        elif r.doc_id != 14 and r.doc_id != 0:  # without n_chars nothing is changed
            assert not r.verified
    assert any(not r.verified for r in rows)


def _as(columns, row):
    return "Row(" + ", ".join(f"{c}={v!r}" for c, v in zip(columns, row, strict=True)) + ")"


def test_empty_table(spark, workdir):
    frame(spark, ["a"]).filter("false").write.parquet(f"{workdir}/documents.parquet")
    assert merkle.op12_merkle_manifest(spark, workdir).count() == 0

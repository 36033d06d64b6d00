"""Quality rules against their SQL twin, also on odd rows, and the verdict on made-up junk."""

import os
import sys

import duckdb
import pandas as pd  # noqa: F401

sys.path.insert(0, os.path.dirname(__file__))
from cases import ODD, frame, prose  # noqa: E402

from checks.compare import rows_of  # noqa: E402
from pathlark.llm import quality  # noqa: E402

TEXTS = [*ODD, "a b c d e a b c d e a b c d e", "one two three four five six seven eight nine ten one two three four five", "l\nl\n \nm\nl",
         " ".join(["the"] * 60), prose(1, 300), "*** ### " * 40, " ".join(f"w{i}***" for i in range(80)), "A a À é 日 1 2 | < > ; ( ) " * 9]


def same(docs, rows):
    c = duckdb.connect()
    c.register("documents", docs)
    want = c.sql(quality.ORACLE)
    return rows_of(rows.columns, rows.collect()), rows_of(want.columns, want.fetchall())


def test_same_as_sql(spark):
    docs = frame(spark, [t for t in TEXTS if t is None or "\x00" not in t])
    docs = docs.unionByName(docs)  # repeated rows
    out = quality.judge(docs).drop("class_distance", "word_distance")
    got, want = same(docs.select("doc_id", "text", "lang").toPandas(), out)
    assert got == want


def test_table_same_as_sql(spark, sf):
    got, want = same(spark.read.parquet(f"{sf}/documents.parquet").toPandas(), quality.op6_quality(spark, sf))
    assert got == want


def test_symbol_junk_goes_and_prose_stays(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    junk = spark.createDataFrame([(-1, " ".join(f"w{i}***" for i in range(80)), None), (-2, " ".join(["kept"] * 9), "en"),
                                  (-3, " ".join(f"{prose(i, 1)[:2]}gbe{chr(97 + i % 26)}{chr(97 + i // 26)}." for i in range(200)), None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.judge(docs.union(junk)).collect()}
    assert not got[-1].kept and not got[-1].base_failed and got[-2].base_failed
    assert not got[-3].kept and not got[-3].base_failed  # long, no common word, characters like any prose
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").collect()}
    clean = [r for r in got.values() if r.doc_id in good and not r.base_failed]
    assert len(clean) > 30 and all(r.kept for r in clean)


def test_no_references_and_empty_table(spark):
    docs = frame(spark, [prose(1, 100)]).drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert [r.kept for r in quality.judge(docs).collect()] == [True]
    assert quality.judge(docs.filter("false")).count() == 0


def test_native(spark, sf):
    plan = quality.op6_quality(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

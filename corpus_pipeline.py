"""A corpus pipeline over ``documents``: language, repeated lines, near duplicates, benchmark passages, tokens.

Each stage takes what its predecessor kept, with the columns of ``documents``; the last gives token ids.
Between the stages everything is written to the shared folder and read again, so a stage that reads its
input several times costs its predecessors nothing, and a lost executor no more than its own tasks.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlark.llm import bpe, decontaminate, language, lines, neardup
from pathlark.llm.common import read_table
from pathlark.session import clear_stored, stored, stored_tables


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or mostly in no learned language, go."""
    return language.accepted(docs, language.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose lines that nearly came before; n_chars follows. Every document stays, if only an empty one."""
    kept = lines.without_lines(docs, lines.near_lines(docs))
    if "n_chars" in docs.columns:
        kept = kept.select(*(F.length("text").cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars" else c for c in docs.columns))
    return kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class stays. Rows without an id stay."""
    dropped = neardup.classes(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(dropped.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go. They are known by a hash of their text, as ids may be missing."""
    by_text = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    hits = decontaminate.contamination(docs.select(by_text.alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"))
    hits = stored(hits.select(F.col("doc_id").alias("_hit")).distinct(), "hits")
    return docs.join(hits, by_text == F.col("_hit"), "left_anti").select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their number, and the digest of the text they decode to."""
    path = public_tokenizers.path(bpe.RANKS)
    rows = bpe.encode(docs, path, back=True)
    return rows.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
    ("decontamination", decontamination), ("byte_bpe", byte_bpe),
]
#: Edit joins, similarity classes and learned languages have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. Once a stage's result is written, the tables it was made from are removed."""
    docs, first = read_table(spark, sf_dir, "documents"), stored_tables()
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        clear_stored(spark, first, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Byte-level BPE over overlapping chunks, and back to bytes.

A text of up to ``chunk`` characters is one piece. A longer one is cut into chunks that overlap; all
chunks are pre-tokenised in parallel, and where the pre-token boundaries of two neighbours meet again
in the overlap, the text is cut: the pattern reads forwards only, so from a shared boundary on both
see the same pre-tokens. The pieces between the cuts are encoded in parallel and joined per document.

Encoding and decoding of a text are one pass in one Python worker: ``encode`` with ``back`` decodes the ids of
each piece where they are made, and bytes are joined like ids.

Cuts are made only behind a character that is no white space, since the pattern looks one character
ahead behind white space only. If two neighbours share no boundary in their overlap (a pre-token longer
than that), the document is encoded in one piece.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pathlark.llm.common import id_and_text, read_table

RANKS = "byte_bpe_50k.tiktoken"
CHUNK = 1 << 15
OVERLAP = 1 << 9
#: The longest look at characters behind a match of the pattern, generously: matches that end closer to a
#: chunk's end than this may differ from those in the whole text.
MARGIN = 8


@cache
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encoded(texts: list[str], path: str, pattern: str) -> list[bytes]:
    """Ids as little-endian unsigned 32-bit integers."""
    bpe = encoding(path, pattern)
    return [np.asarray(bpe.encode_ordinary(x), dtype="<u4").tobytes() for x in texts]


def boundaries(text: str, pattern: str, first: int, last: int) -> list[int]:
    """Ends of pre-tokens in [first, last) with no white space before them."""
    out = []
    for m in regex.finditer(pattern, text):
        if m.end() >= last:
            break
        if m.end() >= first and not text[m.end() - 1].isspace():
            out.append(m.end())
    return out


def _chunked(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                starts = range(0, max(1, len(text)), chunk)
                for at in range(0, len(starts), 64):
                    part = starts[at : at + 64]
                    yield pa.RecordBatch.from_pydict({
                        "row": [row] * len(part), "doc_id": pa.array([doc] * len(part), pa.int64()),
                        "no": pa.array(range(at, at + len(part)), pa.int32()),
                        "core": [text[i : i + chunk] for i in part], "ahead": [text[i + chunk : i + chunk + overlap] for i in part],
                    })
    return run


def _bounded(pattern: str, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, tails = [], []
            for core, ahead in zip(batch["core"].to_pylist(), batch["ahead"].to_pylist(), strict=True):
                text, n = core + ahead, len(core)
                found = boundaries(text, pattern, 0, len(text) - MARGIN if ahead else len(text) + 1)
                heads.append([x for x in found if x < overlap])
                tails.append([x - n for x in found if x >= n])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))],
                names=[*batch.schema.names, "heads", "tails"],
            )
    return run


def decoded(ids: list[bytes], path: str, pattern: str) -> list[bytes]:
    bpe = encoding(path, pattern)
    return [bpe.decode_bytes(np.frombuffer(x, dtype="<u4").tolist()) for x in ids]


def _encoded(path: str, pattern: str, back: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                some = batch.slice(a, 256)
                ids = encoded(some["text"].to_pylist(), path, pattern)
                made = {"ids": ids} | ({"bytes": decoded(ids, path, pattern)} if back else {})
                names = [x for x in some.schema.names if x != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(some[x] for x in names), *(pa.array(x, pa.binary()) for x in made.values())], names=[*names, *made])
    return run


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, chunk: int = CHUNK, overlap: int = OVERLAP,
           back: bool = False) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit integers) of each row of documents; with ``back`` also
    ``bytes``, what the ids decode to.

    Null and empty texts have no ids. Rows with equal or null ids stay rows of their own. Other columns
    are not read. Each row of the input gives one row.
    """
    rows = id_and_text(docs)
    made = "ids binary, bytes binary" if back else "ids binary"
    one_pass = _encoded(path, pattern, back)
    short = rows.filter(F.length("text") <= chunk).mapInArrow(one_pass, f"doc_id long, {made}")
    # the position in the scan: the same again if a task is run again
    long = rows.withColumn("row", F.monotonically_increasing_id()).filter(F.length("text") > chunk).select("row", "doc_id", "text")
    parts = long.mapInArrow(_chunked(chunk, overlap), "row long, doc_id long, no int, core string, ahead string")
    parts = parts.repartition("row", "no").mapInArrow(
        _bounded(pattern, overlap), "row long, doc_id long, no int, core string, ahead string, heads array<int>, tails array<int>"
    )
    order = Window.partitionBy("row").orderBy("no")
    shared = F.array_intersect(F.lag("tails").over(order), F.col("heads"))
    cut = parts.select(
        "row", "doc_id", "no", "core", "ahead",
        F.when(F.col("no") == 0, 0).otherwise(F.array_min(F.filter(shared, lambda x: x < chunk))).alias("cut"),
    )
    cut = cut.select(
        "*", F.lead("cut").over(order).alias("till"),
        F.min(F.col("cut").isNotNull()).over(Window.partitionBy("row")).alias("whole"),
    )
    text = F.when(
        F.col("whole"), F.concat(F.expr("substr(core, cut + 1)"), F.expr("substr(ahead, 1, coalesce(till, 0))"))
    ).otherwise(F.col("core"))
    cut = cut.select("row", "doc_id", "no", "whole", text.alias("text"))
    met = cut.filter("whole").select("row", "doc_id", "no", "text").repartition("row", "no").mapInArrow(
        one_pass, f"row long, doc_id long, no int, {made}")

    def joined(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("no")
        return pd.DataFrame({"doc_id": part["doc_id"].iloc[:1]} | {c: [b"".join(part[c])] for c in part.columns[3:]})

    met = met.groupBy("row").applyInPandas(joined, f"doc_id long, {made}")
    rest = cut.filter(~F.col("whole")).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.array_join(F.expr("transform(array_sort(collect_list(struct(no, text))), x -> x.text)"), "").alias("text")
    ).select("doc_id", "text").mapInArrow(one_pass, f"doc_id long, {made}")
    return short.unionByName(met).unionByName(rest)


def _decoded(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                some = batch.slice(a, 256)
                back = pa.array(decoded(some["ids"].to_pylist(), path, pattern), pa.binary())
                yield pa.RecordBatch.from_arrays([some["doc_id"], some["ids"], back], names=["doc_id", "ids", "bytes"])
    return run


def decode(rows: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id``, ``ids`` and the raw ``bytes`` the ids stand for."""
    return rows.select("doc_id", "ids").mapInArrow(_decoded(path, pattern), "doc_id long, ids binary, bytes binary")


def digests(docs: DataFrame, path: str) -> DataFrame:
    return encode(docs, path, back=True).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))

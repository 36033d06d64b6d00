"""Reading documents, and numpy views of Arrow text that the operators share.

Inside tasks a batch of texts is one UTF-8 buffer plus row offsets. All hashing is polynomial modulo
2**64 with an odd base, whose inverse exists, so that the hash of any slice is two look-ups in a
running sum; ``mix`` spreads the result over all bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
U64 = np.uint64
#: Text handled at once inside a task, in bytes; a longer document is a piece of its own.
PIECE = 1 << 18


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Texts are long rows: fewer of them go to Python at a time than by default."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only the two columns the operators read; a null text counts as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_CACHE: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """Kept for texts of usual length only: a worker does not hold on to what one long document needed."""
    if n > 2 * PIECE:
        return _powers(base, n)
    if base not in _CACHE:
        _CACHE[base] = _powers(base, 2 * PIECE)
    return _CACHE[base][: n + 1]


def running(values: np.ndarray) -> np.ndarray:
    """Sums of value[i] * BASE**i before each position."""
    out = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum((values.astype(U64) + U64(1)) * powers(BASE, len(values))[:-1], out=out[1:])
    return out


def slice_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of [start, end), equal wherever the values are."""
    return mix((sums[end] - sums[start]) * powers(INVERSE, len(sums) - 1)[start] + (end - start).astype(U64))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and len + 1 offsets into them. Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row ranges with about ``limit`` bytes of text each, with their buffer and offsets."""
    for batch in batches:
        flat, at = text_buffer(batch.column(batch.schema.get_field_index(column)))
        row, n = 0, batch.num_rows
        while row < n:
            end = max(row + 1, int(np.searchsorted(at, at[row] + limit, side="right")) - 1)
            yield batch.slice(row, end - row), flat[at[row] : at[end]], at[row : end + 1] - at[row]
            row = end


def is_space(flat: np.ndarray) -> np.ndarray:
    return (flat == 32) | ((flat >= 9) & (flat <= 13))


def find_words(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words: runs of bytes outside ``\\x20\\x09-\\x0D`` within a row."""
    if not len(flat):
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~is_space(flat)
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    inner = at[1:-1]
    inner = inner[(inner > 0) & (inner < len(flat))]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(at, starts, side="right") - 1


def shingles(words: np.ndarray, rows: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each ``size`` words in a row, and where in ``words`` each starts.

    A row with fewer words, but at least one, has one shingle of all its words.
    """
    n = len(words)
    if not n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    sums = running(words)
    start = np.arange(n)
    end = np.minimum(start + size, n)
    full = (start + size <= n) & (rows[end - 1] == rows)
    firsts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    count = np.diff(np.r_[firsts, n])
    short = count < size
    keep = full
    keep[firsts[short]] = True
    end[firsts[short]] = firsts[short] + count[short]
    start = start[keep]
    return slice_hash(sums, start, end[keep]), start


def sent(keys: np.ndarray, block: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Records grouped by bucket of their key: (bucket, records as bytes)."""
    where = (keys >> U64(40)) % U64(buckets)
    order = np.argsort(where, kind="stable")
    where, block = where[order], block[order]
    cuts = np.flatnonzero(np.r_[True, where[1:] != where[:-1], True]) if len(where) else []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(where[a]), block[a:b].tobytes()


BLOCKS = pa.schema([("bucket", pa.int32()), ("block", pa.binary())])
BLOCKS_SQL = "bucket int, block binary"


def block_batch(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.binary())], schema=BLOCKS)


def gathered(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[tuple[int, np.ndarray]]:
    """Per bucket of this partition, all its records. The rows come sorted by bucket."""
    now, parts = None, []
    for batch in batches:
        for bucket, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if bucket != now and parts:
                yield now, np.concatenate(parts)
                parts = []
            now = bucket
            parts.append(np.frombuffer(block.as_buffer(), dtype=kind))
    if parts:
        yield now, np.concatenate(parts)


def exchanged(blocks: DataFrame, partitions: int) -> DataFrame:
    """Blocks of a bucket next to each other in one partition."""
    return blocks.repartition(partitions, "bucket").sortWithinPartitions("bucket")


def code_points(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The characters of a UTF-8 buffer as numbers, and the row offsets among them."""
    chars = np.frombuffer(flat.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lead = np.zeros(len(flat) + 1, np.int64)
    np.cumsum((flat & 0xC0) != 0x80, out=lead[1:])
    return chars, lead[at]

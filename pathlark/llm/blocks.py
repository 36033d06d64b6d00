"""Records that travel between tasks as blocks: (bucket, bytes) rows that Spark shuffles by bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pathlark.llm.common import U64, mix


def planes(x: np.ndarray) -> bytes:
    """Records byte by byte, so that bytes that are mostly zero stand together and compress."""
    return b"".join(np.ascontiguousarray(np.ascontiguousarray(x[k]).view(np.uint8).reshape(len(x), x.dtype[k].itemsize).T).tobytes() for k in x.dtype.names)


def records(data: bytes, kind: np.dtype) -> np.ndarray:
    n = len(data) // kind.itemsize
    out, at = np.zeros(n, kind), 0
    for name in kind.names:
        width = kind[name].itemsize
        flat = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        out[name] = np.ascontiguousarray(flat.T).view(kind[name]).ravel()
        at += n * width
    return out


def dealt(x: np.ndarray, by: np.ndarray, buckets: int, first: int = 0) -> list[tuple[int, bytes]]:
    where = (mix(by.astype(U64)) % U64(buckets)).astype(np.int64)
    order = np.argsort(where, kind="stable")
    x, where = x[order], where[order]
    cuts = np.flatnonzero(np.r_[True, where[1:] != where[:-1], True]) if len(where) else []
    return [(first + int(where[a]), planes(x[a:b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Blocks of each bucket of the partition, which is sorted by bucket."""
    now, parts = None, []
    for batch in batches:
        for bucket, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if bucket != now and parts:
                yield now, parts
                parts = []
            now = bucket
            parts.append(block)
    if parts:
        yield now, parts


def exchanged(blocks: DataFrame, partitions: int) -> DataFrame:
    return blocks.repartition(partitions, "bucket").sortWithinPartitions("bucket")


def sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    """``least`` over each ``width`` neighbours, by doubling."""
    size = 1
    while size * 2 <= width:
        x = least(x[:-size], x[size:])
        size *= 2
    return least(x[: len(x) - (width - size)], x[width - size :]) if width > size else x

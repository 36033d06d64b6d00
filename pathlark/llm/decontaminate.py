"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Words are lower-cased (ASCII) runs of non-white-space; shingles are five words and weigh as often as they
occur. For an item of m words each window of m words that shares a shingle with an item of that size
gets a 64-bit SimHash from running sums of its shingles' bits (a window that shares none has similarity
0 and cannot be a hit). Fingerprints are cut into ``BLOCKS`` blocks: two within ``RADIUS`` bits differ by
at most ``RADIUS // BLOCKS`` bits in some block, so a table of each block's near values finds all items
within the radius. These are compared exactly: sum of smaller weights over sum of larger ones. An item of fewer
than five words is one shingle of all its words; windows of so few words have one shingle, so equal hashes are
all there is to look for.

Items go to the tasks in groups of at most ``ITEM_CHARS`` characters, each group against all documents, so
that what is broadcast is bounded however large the benchmark is. Documents are never shuffled.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlark.llm.common import U64, find_words, id_and_text, mix, pieces, read_table, running, shingles, slice_hash

SIZE = 5
SIMILARITY = 0.8
RADIUS = 20
BLOCKS = 7
ITEM_CHARS = 32_000_000
#: Windows whose running sums are held at once.
STRETCH = 1 << 13
FOUND = "doc_id long, item_id long, start_word long, end_word long, distance int, similarity double"
CUTS = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
BITS = np.arange(64, dtype=U64)


def lowered(flat: np.ndarray) -> np.ndarray:
    return np.where((flat >= 65) & (flat <= 90), flat | 32, flat)


def hashed_words(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    flat = lowered(flat)
    starts, ends, rows = find_words(flat, at)
    return slice_hash(running(flat), starts, ends), rows


def bit_sums(found: np.ndarray) -> np.ndarray:
    """Running sums over shingles of +1 or -1 for each bit."""
    signs = ((mix(found ^ U64(0x5851F42D4C957F2D))[:, None] >> BITS) & U64(1)).astype(np.int32) * 2 - 1
    return np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(signs, axis=0, dtype=np.int32)])


def packed(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(U64) << BITS).sum(axis=1, dtype=U64)


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    x, y = Counter(a.tolist()), Counter(b.tolist())
    shared = sum((x & y).values())
    return shared / (len(a) + len(b) - shared)


class Items:
    """Items by size, with the tables of near block values."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.words, self.found = [], [], []
        self.short: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for item_id, text in items:
            raw = np.frombuffer(text.encode(), np.uint8)
            words, rows = hashed_words(raw, np.array([0, len(raw)]))
            if 0 < len(words) < SIZE:
                self.short[len(words)].append((int(shingles(words, rows, len(words))[0][0]), item_id))
            elif len(words):
                self.ids.append(item_id)
                self.words.append(len(words))
                self.found.append(shingles(words, rows, SIZE)[0])
        self.prints = np.concatenate([packed(bit_sums(f)[-1:]) for f in self.found]) if self.found else np.zeros(0, U64)
        pairs = sorted({(int(h), self.words[i]) for i, f in enumerate(self.found) for h in f})
        self.vocabulary = np.asarray(sorted({h for h, _ in pairs}), dtype=U64)
        self.hashes = {m: np.unique(np.array([h for h, _ in own], dtype=U64)) for m, own in self.short.items()}
        self.sizes = defaultdict(list)
        for h, m in pairs:
            self.sizes[h].append(m)
        self.bitmap = np.zeros(1 << 22, bool)
        self.bitmap[(self.vocabulary >> U64(42)).astype(np.int64)] = True
        self.by_size = {m: np.flatnonzero(np.asarray(self.words) == m) for m in set(self.words)}
        self.near = {m: self._near(own) for m, own in self.by_size.items()}

    def _near(self, own: np.ndarray) -> list[np.ndarray]:
        """Per block, for each value of the block, the items of one size that are near it there."""
        out = []
        for a, b in zip(CUTS[:-1], CUTS[1:], strict=True):
            values = (self.prints[own] >> U64(a)) & U64((1 << (b - a)) - 1)
            away = np.bitwise_count(np.arange(1 << (b - a), dtype=U64)[:, None] ^ values)
            out.append(away <= RADIUS // BLOCKS)
        return out

    def within(self, m: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows and items of size m within the radius, and how far apart."""
        own = self.by_size[m]
        near = np.zeros((len(prints), len(own)), bool)
        for k, (a, b) in enumerate(zip(CUTS[:-1], CUTS[1:], strict=True)):
            near |= self.near[m][k][((prints >> U64(a)) & U64((1 << (b - a)) - 1)).astype(np.int64)]
        w, i = np.nonzero(near)
        away = np.bitwise_count(prints[w] ^ self.prints[own[i]])
        ok = away <= RADIUS
        return w[ok], own[i[ok]], away[ok]


def short_hits(items: Items, words: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, int, int, int, float]]:
    """Row, item, start, end, distance and similarity of the first place of each item of few words in each row."""
    first = np.searchsorted(rows, rows)
    for m, known in sorted(items.hashes.items()):
        found, where = shingles(words, rows, m)
        whole = where + m <= len(rows)
        whole[whole] &= rows[where[whole] + m - 1] == rows[where[whole]]  # a row of fewer words is no such window
        spots = np.flatnonzero(whole & np.isin(found, known))
        seen = set()
        for p, h in zip(where[spots].tolist(), found[spots].tolist(), strict=True):
            r, start = int(rows[p]), int(p - first[p])
            if (r, h) not in seen:
                seen.add((r, h))
                for own, item_id in items.short[m]:
                    if own == h:
                        yield r, item_id, start, start + m, 0, 1.0


def hits(items: Items, found: np.ndarray, n_words: int, similarity: float) -> Iterator[tuple[int, int, int, int, float]]:
    """For one document: item, start, end, distance and similarity of the best window for each item in it."""
    spots = np.flatnonzero(items.bitmap[(found >> U64(42)).astype(np.int64)])
    if not len(spots):
        return
    at = np.minimum(np.searchsorted(items.vocabulary, found[spots]), len(items.vocabulary) - 1)
    spots = spots[items.vocabulary[at] == found[spots]]
    starts: dict[int, set[int]] = defaultdict(set)
    for p in spots.tolist():
        for m in items.sizes[int(found[p])]:
            last = max(0, n_words - m)
            starts[m].update(range(min(last, max(0, p - max(m - SIZE, 0))), min(p, last) + 1))
    best: dict[int, tuple] = {}
    for m, some in sorted(starts.items()):
        size = max(1, min(m, n_words) - SIZE + 1)
        s = np.asarray(sorted(some))
        # windows that lie apart need not share running sums
        runs = np.split(s, np.flatnonzero(np.diff(s) > size) + 1)
        for s in (part for r in runs for part in np.split(r, range(STRETCH, len(r), STRETCH))):
            low, high = int(s[0]), int(s[-1]) + size
            sums = bit_sums(found[low:high])
            prints = packed(sums[s - low + size] - sums[s - low])
            for w, i, away in zip(*(x.tolist() for x in items.within(m, prints)), strict=True):
                start = int(s[w])
                alike = weighted_similarity(found[start : start + size], items.found[i])
                if alike >= similarity:
                    key = (-alike, start)
                    if i not in best or key < best[i][0]:
                        best[i] = (key, start, min(start + m, n_words), away, alike)
    for i, (_, start, end, away, alike) in sorted(best.items()):
        yield items.ids[i], start, end, away, alike


def contamination(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, item_chars: int = ITEM_CHARS) -> DataFrame:
    """One row for each row of documents and item of which it holds a passage: its best window.

    Null and empty texts hold nothing, and items without words are in no document. An item of fewer than five
    words is in each document that has these words in a row. A document shorter than a longer item is one window.
    Of equal windows the first counts. Repeated rows and items give repeated rows. Other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    groups = max(1, -(-chars // item_chars))
    rows = id_and_text(docs)

    def against(group: int) -> DataFrame:
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == group)
        sent = spark.sparkContext.broadcast([tuple(r) for r in own.collect()])
        kept: list[Items] = []

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if not kept:
                kept.append(Items(sent.value))
            known = kept[0]
            for part, flat, at in pieces(batches):
                if not len(known.vocabulary) and not known.short:
                    continue
                words, of = hashed_words(flat, at)
                found, where = shingles(words, of, SIZE)
                ids = part["doc_id"].to_pylist()
                out = [(ids[r], *hit) for r, *hit in short_hits(known, words, of)]
                touched = np.unique(of[where[known.bitmap[(found >> U64(42)).astype(np.int64)]]]) if len(found) else []
                for r in touched:
                    a, b = np.searchsorted(of[where], [r, r + 1])
                    n = int(np.searchsorted(of, r + 1) - np.searchsorted(of, r))
                    out += [(ids[r], *hit) for hit in hits(known, found[a:b], n, similarity)]
                if out:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64())
                    names = [x.split()[0] for x in FOUND.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        return rows.mapInArrow(run, FOUND)

    return reduce(DataFrame.unionByName, [against(g) for g in range(groups)])


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))

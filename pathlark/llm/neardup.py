"""Near duplicates by ProbMinHash.

A document is the weighted set of its five-word shingles (weight: occurrences). Each shingle is a Poisson
process with its weight as rate: arrivals come at exponential gaps drawn from a hash of the shingle, each
at a component drawn likewise; a component keeps its earliest arrival and that shingle's name. A shingle
stops once its next arrival is later than the latest kept one, as nothing later can count. Two documents
agree in a component with their probability Jaccard similarity. Components are banded: documents that
agree in all components of a band are candidates.

In a band's bucket each document is first paired with the most central one, judged by one-bit sketches, and with
its nearest one. These pairs are verified with the exact probability Jaccard similarity; classes are the connected
components of the verified links and of exact copies. That only finds most links at little cost.

Then all pairs of all buckets whose two documents are still of different classes are compared: a bucket's documents
come together in tiles with their shingles, what any two share is counted for the whole tile at once, and that gives
a bound that their similarity never exceeds (see ``crossing``). Only pairs whose bound is below the limit are not
verified. Two documents of one class need not be compared. So the classes are those of all pairs of all buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlark.llm.common import (
    BLOCKS_SQL, U64, block_batch, exchanged, find_words, gathered, id_and_text, mix, partitions_of, pieces, read_table, running, sent,
    shingles, slice_hash,
)
from pathlark.llm.links import components
from pathlark.session import stored

SIZE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 4
#: A similarity is a sum of many terms; one of exactly the limit may come out a little lower.
ROUNDING = 1e-9
#: Documents of a bucket among which a nearest one is looked for at once, when the first pairs are chosen.
NEIGHBOURS = 2048
#: Documents of a bucket, and bytes of their shingles, that come together in a tile; any two tiles of it meet.
TILE, TILE_BYTES = 1024, 16_000_000
#: Shingles counted at once in a tile.
STEP = 4096
RECORD = np.dtype([("key", "<u8"), ("doc", "<i8"), ("text", "<u8"), ("s0", "<u8"), ("s1", "<u8")])


def weighted(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, shingle and count of each distinct shingle of each row, in order of row and shingle."""
    starts, ends, rows = find_words(flat, at)
    found, where = shingles(slice_hash(running(flat), starts, ends), rows, SIZE)
    rows = rows[where]
    order = np.lexsort((found, rows))
    found, rows = found[order], rows[order]
    cut = np.flatnonzero(np.r_[True, (found[1:] != found[:-1]) | (rows[1:] != rows[:-1])]) if len(found) else np.zeros(0, np.int64)
    return rows[cut], found[cut], np.diff(np.r_[cut, len(found)])


def prob_min_hash(rows: np.ndarray, found: np.ndarray, weights: np.ndarray, n: int, m: int) -> np.ndarray:
    """Per row the names of the earliest arrivals in m components; 0 in rows without shingles."""
    first, name = np.full(n * m, np.inf), np.zeros(n * m, U64)
    latest = np.full(n, np.inf)
    at, rate, time, k = rows, weights.astype(float), np.zeros(len(rows)), 0
    while len(at):
        draw = mix(found + U64(0x9E3779B97F4A7C15 * (2 * k + 1) % (1 << 64)))
        time = time - np.log(((draw >> U64(11)).astype(float) + 0.5) / (1 << 53)) / rate
        live = time < latest[at]
        at, found, rate, time, draw = at[live], found[live], rate[live], time[live], draw[live]
        if not len(at):
            break
        cell = at * m + (mix(draw ^ U64(0xD6E8FEB86659FD93)) >> U64(40)).astype(np.int64) % m
        np.minimum.at(first, cell, time)
        won = first[cell] == time
        name[cell[won]] = found[won]
        touched = np.unique(at)
        latest[touched] = first.reshape(n, m)[touched].max(axis=1)
        k += 1
    return name.reshape(n, m)


def _bands(buckets: int, bands: int, rows_per_band: int):
    m = bands * rows_per_band

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for part, flat, at in pieces(batches):
            ids = part["doc_id"].to_numpy(zero_copy_only=False)
            text = slice_hash(running(flat), at[:-1], at[1:])
            rows, found, weights = weighted(flat, at)
            # of copies in one task only the first is needed: exact copies are joined by their text
            copies = np.zeros(part.num_rows, bool)
            for i, t in enumerate(zip(text.tolist(), np.diff(at).tolist(), strict=True)):
                copies[i] = t in seen
                seen.add(t)
            if len(seen) > 1_000_000:
                seen.clear()
            live = np.flatnonzero(~copies & (np.bincount(rows, minlength=part.num_rows) > 0))
            number = np.zeros(part.num_rows, np.int64)
            number[live] = np.arange(len(live))
            own = np.isin(rows, live)
            names = prob_min_hash(number[rows[own]], found[own], weights[own], len(live), m)
            bits = (mix(names + U64(77)) >> U64(9)) & U64(1)
            half = [(bits[:, i : i + 64] << np.arange(min(64, m - i), dtype=U64)).sum(axis=1, dtype=U64) if i < m else np.zeros(len(live), U64) for i in (0, 64)]
            out = np.zeros(len(live) * bands, RECORD)
            keys = np.zeros((len(live), bands), U64)
            for b in range(bands):
                key = np.full(len(live), b + 1, U64)
                for c in names[:, b * rows_per_band : (b + 1) * rows_per_band].T:
                    key = mix(key * U64(31) ^ c)
                keys[:, b] = key
            out["key"] = keys.ravel()
            for name, column in (("doc", ids[live]), ("text", text[live]), ("s0", half[0]), ("s1", half[1])):
                out[name] = np.repeat(column, bands)
            yield block_batch(list(sent(out["key"], out, buckets)))

    return run


def partners(s0: np.ndarray, s1: np.ndarray, order: np.ndarray) -> tuple[int, np.ndarray]:
    """Of a bucket's documents the most central one, and each one's nearest other one, by sketch: the pairs to
    begin with. The others are compared later, where they are of different classes.

    Central is the one nearest to the majority of every bit: of edited copies that is the one they were made
    from. Nearest ones are looked for among ``NEIGHBOURS`` documents next to each other in ``order``.
    """
    n = len(s0)
    bits = np.stack([s0, s1], axis=1)
    votes = np.zeros(128)
    for a in range(0, n, 4096):
        votes += np.unpackbits(np.ascontiguousarray(bits[a : a + 4096]).view(np.uint8), axis=1, bitorder="little").sum(axis=0)
    middle = np.packbits(votes * 2 > n, bitorder="little").view("<u8")
    away = np.bitwise_count(s0 ^ middle[0]).astype(np.int64) + np.bitwise_count(s1 ^ middle[1])
    nearest = np.zeros(n, np.int64)
    for a in range(0, n, NEIGHBOURS):
        own = order[a : a + NEIGHBOURS]
        if len(own) == 1:
            own = order[a - 1 : a + 1]
        apart = np.bitwise_count(s0[own][:, None] ^ s0[own]).astype(np.int16) + np.bitwise_count(s1[own][:, None] ^ s1[own])
        np.fill_diagonal(apart, 999)
        nearest[own] = own[apart.argmin(axis=1)]
    return int(np.argmin(away)), nearest


MET = "kind int, x long, y long"
MET_NAMES = [f.split()[0] for f in MET.split(", ")]
PAIR, MEMBER = range(2)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of documents with different texts to begin with, of each bucket at most two for each, and who is
    in buckets of more than two, where pairs are left: (bucket, document)."""
    for _, all_of in gathered(batches, RECORD):
        x = np.sort(all_of, order=["key", "text", "doc"])
        x = x[np.r_[True, (x["key"][1:] != x["key"][:-1]) | (x["text"][1:] != x["text"][:-1])]]
        cut = np.flatnonzero(np.r_[True, x["key"][1:] != x["key"][:-1], True])
        size = np.diff(cut)
        two = cut[:-1][size == 2]
        left, right = [x["doc"][two]], [x["doc"][two + 1]]
        for k in np.flatnonzero(size > 2):
            own = x[cut[k] : cut[k + 1]]
            central, nearest = partners(own["s0"], own["s1"], np.argsort(mix(own["doc"].astype(U64) ^ own["key"]), kind="stable"))
            left += [own["doc"], own["doc"]]
            right += [np.full(len(own), own["doc"][central]), own["doc"][nearest]]
        left, right = np.concatenate(left), np.concatenate(right)
        pairs = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)], axis=1)[left != right], axis=0)
        more = x[np.repeat(size > 2, size)]
        for kind, columns in ((PAIR, (pairs[:, 0], pairs[:, 1])), (MEMBER, tuple(np.ascontiguousarray(more[c]).view("<i8") for c in ("key", "doc")))):
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), kind, np.int32)), *map(pa.array, columns)], names=MET_NAMES)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, flat, at in pieces(batches):
        rows, found, weights = weighted(flat, at)
        cut = np.searchsorted(rows, np.arange(part.num_rows + 1))
        sets = [found[a:b].tobytes() + weights[a:b].astype("<u4").tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(sets, pa.binary())], names=["doc_id", "bag"])


def probability_jaccard(x: bytes, y: bytes) -> float:
    """Of two weighted sets: shingles as unsigned 64-bit integers in order, then counts as 32-bit ones."""
    a, b = len(x) // 12, len(y) // 12
    if not a or not b:
        return 0.0
    fa, fb = np.frombuffer(x, "<u8", a), np.frombuffer(y, "<u8", b)
    wa, wb = np.frombuffer(x, "<u4", a, 8 * a).astype(float), np.frombuffer(y, "<u4", b, 8 * b).astype(float)
    shared, i, j = np.intersect1d(fa, fb, assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    own, other = wa[i], wb[j]
    ratio = own / other
    order = np.argsort(ratio)
    r, p, q = ratio[order], own[order], other[order]
    # terms of the shared shingles with a ratio at least, or below, each one's; equal ratios give the same either way
    upper = p.sum() - np.r_[0, np.cumsum(p)[:-1]] + (wa.sum() - own.sum())
    lower = np.r_[0, np.cumsum(q)[:-1]] + (wb.sum() - other.sum())
    return float((p / (upper + r * lower)).sum())


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        alike = [probability_jaccard(x, y) for x, y in zip(batch["x"].to_pylist(), batch["y"].to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(alike, pa.float64())], names=["a", "b", "similarity"])


def _verified(bags: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """``a, b, similarity`` of those pairs that are similar enough."""
    both = pairs.hint("merge").join(bags.select(F.col("doc_id").alias("b"), F.col("bag").alias("y")), "b").join(
        bags.select(F.col("doc_id").alias("a"), F.col("bag").alias("x")), "a")
    return both.select("a", "b", "x", "y").mapInArrow(_verify, "a long, b long, similarity double").filter(F.col("similarity") >= similarity - ROUNDING)


def crossing(bags: list[bytes], tile: np.ndarray, root: np.ndarray, across: bool, similarity: float) -> list[tuple[int, int]]:
    """Pairs that are similar enough, as many as connect all classes that such pairs connect: of weighted sets with
    different roots, and in different tiles if ``across``.

    With W the weight of a set, and M of what the other one shares, the similarity is at most
    1 / (Wx / Mx + Wy / My - 1): the term of a shared shingle i is at most 1 / (Wx / xi + (Wy - My) / yi), which is
    concave and homogeneous in (xi, yi), so that the sum of these is at most their value at the sums. For sets
    without repeats it is the similarity itself. Only pairs with a lower bound are left out.
    """
    n = len(bags)
    sizes = np.array([len(x) // 12 for x in bags])
    rows = np.repeat(np.arange(n), sizes)
    found = np.concatenate([np.frombuffer(x, "<u8", k) for x, k in zip(bags, sizes, strict=True)])
    weights = np.concatenate([np.frombuffer(x, "<u4", k, 8 * k) for x, k in zip(bags, sizes, strict=True)]).astype(float)
    total = np.bincount(rows, weights, n)
    kind = np.float32 if total.max() < 1 << 24 else np.float64  # sums of whole numbers stay exact
    order = np.argsort(found, kind="stable")
    found, rows, weights = found[order], rows[order], weights[order]
    name = np.cumsum(np.r_[False, found[1:] != found[:-1]])
    often = np.bincount(name) > 1
    own = often[name]
    name, rows, weights = (np.cumsum(often) - 1)[name[own]], rows[own], weights[own]
    shared = np.zeros((n, n), kind)
    for start in range(0, int(often.sum()), STEP):
        a, b = np.searchsorted(name, (start, start + STEP))
        held = np.zeros((n, int(name[b - 1]) - start + 1), kind)
        held[rows[a:b], name[a:b] - start] = weights[a:b]
        shared += held @ (held > 0).astype(kind).T
    with np.errstate(divide="ignore", invalid="ignore"):
        part = shared / total[:, None].astype(kind)
        near = 1 / (1 / part + 1 / part.T - 1) >= similarity - 1e-4
    near &= root[:, None] != root
    if across:
        near &= tile[:, None] != tile
    top: dict[int, int] = {}

    def find(r: int) -> int:
        while r in top:
            r = top[r]
        return r

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(near, 1))), strict=True):
        x, y = find(int(root[i])), find(int(root[j]))
        if x != y and probability_jaccard(bags[i], bags[j]) >= similarity - ROUNDING:
            top[max(x, y)] = min(x, y)
            out.append((i, j))
    return out


UNIT = ["key", "low", "high"]


def _across(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def links() -> pa.RecordBatch:
            all_of = pa.Table.from_batches(held)
            tile, root, docs = (all_of[c].to_numpy() for c in ("tile", "root", "doc"))
            some = crossing(all_of["bag"].to_pylist(), tile, root, now[1] != now[2], similarity)
            ends = [pa.array([int(docs[pair[side]]) for pair in some], pa.int64()) for side in (0, 1)]
            return pa.RecordBatch.from_arrays(ends, names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            units = np.stack([batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in UNIT], axis=1)
            cut = np.flatnonzero(np.r_[True, (units[1:] != units[:-1]).any(axis=1), True])
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                unit = tuple(units[a].tolist())
                if unit != now and held:
                    yield links()
                    held = []
                now = unit
                held.append(batch.slice(a, b - a))
        if held:
            yield links()

    return run


def _joined_up(bags: DataFrame, members: DataFrame, links: DataFrame, same: DataFrame, found: DataFrame,
               similarity: float, tile: int, parts: int) -> DataFrame:
    """The components once all pairs of different classes in each bucket are compared. ``members``: each document's
    buckets. Buckets with the same documents are compared once. A bucket of more than a tile is dealt to tiles by
    document, and each two of them meet in one place, so no task holds more than two tiles."""
    sizes = bags.groupBy(F.col("doc_id").alias("doc")).agg(F.sum("size").alias("size"))
    rows = members.join(found.withColumnRenamed("node", "doc"), "doc", "left").join(sizes, "doc")
    rows = rows.select("doc", F.coalesce("root", "doc").alias("root"), "size", F.explode("keys").alias("key"))
    rows = stored(rows, "rows")
    groups = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"), F.min("root").alias("low"), F.max("root").alias("high"),
        F.bit_xor(F.xxhash64("doc")).alias("h0"), F.bit_xor(F.xxhash64("doc", F.lit(1))).alias("h1"))
    groups = groups.filter("low != high").groupBy("n", "size", "h0", "h1").agg(F.min("key").alias("key"))
    groups = groups.select("key", F.ceil(F.greatest(F.col("n") / tile, F.col("size") / TILE_BYTES)).cast("int").alias("tiles"))
    placed = rows.join(groups, "key").withColumn("tile", F.pmod(F.xxhash64("doc"), F.col("tiles")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    placed = placed.select("key", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "doc", "root")
    dealt = placed.hint("merge").join(bags.select(F.col("doc_id").alias("doc"), "bag"), "doc").select(*UNIT, "tile", "doc", "root", "bag")
    dealt = dealt.repartition(parts, *UNIT).sortWithinPartitions(*UNIT)
    new = stored(dealt.mapInArrow(_across(similarity), "a long, b long"), "links")
    return found if new.isEmpty() else components(links.union(new).union(same))


def classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, tile: int = TILE) -> DataFrame:
    """``doc_id, class_id, kept`` of each row: the smallest doc_id of its class, and whether it is that one.

    Exact copies are of one class, empty and null texts too. A text without words is alike to its exact
    copies only; one of fewer than five words is one shingle. Rows with equal doc_id are one document, whose
    links are those of all its texts. Rows without doc_id have no class and are kept. Other columns
    are not read.
    """
    spark = docs.sparkSession
    parts = partitions_of(spark)
    all_rows = id_and_text(docs)
    known = all_rows.filter("doc_id is not null")
    prints = stored(known.select("doc_id", F.xxhash64("text").alias("h"), F.expr("unhex(md5(text))").alias("m")), "prints")
    firsts = prints.groupBy("h", "m").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = prints.join(firsts.filter("n > 1"), ["h", "m"]).select("doc_id", "first")
    copies = stored(copies, "copies")

    bands_of = known.mapInArrow(_bands(4 * parts, bands, rows), BLOCKS_SQL)
    met = stored(exchanged(bands_of, parts).mapInArrow(_meet, MET), "met")
    to_first = copies.groupBy(F.col("doc_id").alias("doc")).agg(F.min("first").alias("first"))

    def by_first(found: DataFrame, *names: str) -> DataFrame:
        """With documents replaced by the first copies of their texts."""
        for name in names:
            found = found.join(to_first.withColumnRenamed("doc", name), name, "left").withColumn(name, F.coalesce("first", name)).drop("first")
        return found

    pairs = by_first(met.filter(F.col("kind") == PAIR).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "a", "b")
    pairs = stored(pairs.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    # texts stay where their hash puts them, whatever the number of ids
    bags = known.join(wanted.hint("shuffle_hash"), "doc_id", "left_semi").select("doc_id", "text").mapInArrow(_sets, "doc_id long, bag binary")
    bags = stored(bags.withColumn("size", F.octet_length("bag").cast("long")), "bags")
    links = stored(_verified(bags, pairs, similarity).select("a", "b"), "links")
    same = copies.filter("doc_id != first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    found = components(links.union(same))
    # a text is in as many buckets as there are bands at most
    members = by_first(met.filter(F.col("kind") == MEMBER).select(F.col("y").alias("doc"), F.col("x").alias("key")), "doc")
    members = members.groupBy("doc").agg(F.collect_set("key").alias("keys"))
    found = _joined_up(bags, members, links, same, found, similarity, tile, parts)

    roots = found.withColumnRenamed("node", "doc_id")
    out = all_rows.select("doc_id").join(roots, "doc_id", "left")
    return out.select("doc_id", F.coalesce("root", "doc_id").alias("class_id"), F.coalesce(F.col("root") == F.col("doc_id"), F.lit(True)).alias("kept"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(read_table(spark, sf_dir, "documents"))

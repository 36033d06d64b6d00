"""Near-duplicate lines: a segment-partition edit join.

Lines that are equal, or have at least ``MIN_CHARS`` characters and are connected by edit distances of at most
``EDITS``, are one class, whose first line (by doc_id, then line number) stays. Exact copies of any line that
is not blank are found by 128-bit hashes. The least length is 15 characters for each edit: in shorter lines,
as "Page 12" and "Page 13", so many edits are no copy's noise but another line.

For the join each distinct line is cut into ``EDITS + 1`` segments. Within that distance one segment stays
untouched, so a line as long or longer has it as a substring, near the same place: the index holds
(length, segment number, segment), and each line probes it, for each possible length, with the few
substrings that the number of edits left and right of the segment allows. Pairs that meet must also have
nearly the same characters (a 32-bit parity sketch, in which an edit changes two bits at most). They are
verified by a bit-parallel edit distance in a band of ``2 * EDITS + 1`` diagonals.

A key under which very many lines meet only links each line to one partner first; what that leaves
unconnected is then compared in full by a join on the key. Texts are fetched only for lines in pairs, each
once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlark.llm.blocks import by_bucket, dealt, exchanged, records
from pathlark.llm.common import BLOCKS_SQL, U64, block_batch, code_points, id_and_text, mix, partitions_of, pieces, powers, read_table, running, slice_hash
from pathlark.llm.links import components
from pathlark.session import stored

EDITS = 2
MIN_CHARS = 15 * EDITS
HELD = 1 << 18
#: Comparisons of sketches that a key gets at once; beyond, its lines are linked first. Decides the way only.
DENSE = 1 << 22
#: Characters compared at once when pairs are verified.
LANES = 1 << 21
LINE = np.dtype([("h", "<u8"), ("g", "<u8"), ("doc", "<i8"), ("t", "<i8"), ("line", "<u4"), ("gone", "<u1")])
KEY = np.dtype([("key", "<u8"), ("h", "<u8"), ("sketch", "<u4"), ("probe", "<u1")])
OTHER = 0xC2B2AE3D27D4EB4F


def segment(length: np.ndarray, i: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of segment i of a line: nearly equal ones, the longer ones last."""
    size, more = length // (edits + 1), length % (edits + 1)
    short = edits + 1 - more
    return i * size + np.maximum(i - short, 0), size + (i >= short)


def probes(length: np.ndarray, edits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """(lines, starts, sizes, shorter length, segment) of the substrings to look up.

    A segment may have moved by the edits before it, at most i for segment i, and by those behind it.
    """
    for less in range(edits + 1):
        other = length - less
        for i in range(edits + 1):
            start, size = segment(other, i, edits)
            for move in range(max(-i, less - (edits - i)), min(i, less + edits - i) + 1):
                at = start + move
                ok = np.flatnonzero((at >= 0) & (at + size <= length) & (size > 0))
                yield ok, at[ok], size[ok], other[ok], i


def _key(found: np.ndarray, length: np.ndarray, i: int) -> np.ndarray:
    return mix(found ^ (length.astype(U64) * U64(0x9FB21C651E98DF25) + U64(i + 1)))


def split_lines(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Characters of a piece, and start, end, row and number of each line in it."""
    chars, rows = code_points(flat, at)
    breaks = np.flatnonzero(chars == 10)
    of = np.searchsorted(rows, breaks, side="right") - 1
    starts = np.r_[rows[:-1], breaks + 1]
    row = np.r_[np.arange(len(rows) - 1), of]
    ends = np.r_[rows[1:], breaks]
    # each row opens a line and each break another one; sorted, ends fall to the starts before them
    order = np.lexsort((starts, row))
    starts, row = starts[order], row[order]
    ends = ends[np.lexsort((ends, np.r_[np.arange(len(rows) - 1), of]))]
    first = np.searchsorted(row, np.arange(len(rows) - 1))
    return chars, starts, ends, row, np.arange(len(row)) - first[row]


def _lines(buckets: int, edits: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, keys, n = [], [], 0

        def flushed() -> pa.RecordBatch:
            x = in_order(np.concatenate(held))
            gone = later(x)
            x["gone"][gone] = 1
            own = np.concatenate(keys)
            own = own[np.lexsort((own["probe"], own["h"], own["key"]))]  # copies have the same keys
            own = own[np.r_[True, np.any([own[k][1:] != own[k][:-1] for k in KEY.names], axis=0)]] if len(own) else own
            return block_batch(dealt(x, x["h"], buckets, -buckets) + dealt(own, own["key"], buckets))

        for part, flat, at in pieces(batches):
            chars, start, end, row, number = split_lines(flat, at)
            solid = np.r_[0, np.cumsum((chars != 32) & ((chars < 9) | (chars > 13)))]
            some = solid[end] > solid[start]
            start, end, row, number = start[some], end[some], row[some], number[some]
            if not len(start):
                continue
            sums, other = running(chars), np.zeros(len(chars) + 1, U64)
            np.cumsum((mix(chars.astype(U64) + U64(77)) | U64(1)) * powers(OTHER, len(chars))[:-1], out=other[1:])
            x = np.zeros(len(start), LINE)
            x["h"] = slice_hash(sums, start, end)
            x["g"] = mix((other[end] - other[start]) * powers(pow(OTHER, -1, 1 << 64), len(chars))[start])
            x["doc"], x["t"] = (part[c].to_numpy(zero_copy_only=False)[row] for c in ("doc_id", "t"))
            x["line"] = number
            bits = np.uint32(1) << (mix(chars.astype(U64)) >> U64(59)).astype(np.uint32)
            at_both = np.empty(2 * len(start), np.int64)
            at_both[::2], at_both[1::2] = start, end
            sketch = np.bitwise_xor.reduceat(np.r_[bits, np.uint32(0)], at_both)[::2]
            long = np.flatnonzero(end - start >= min_chars)  # the others are only looked up as a whole
            start, end, h, sketch = start[long], end[long], x["h"][long], sketch[long]
            length, own = end - start, []

            def record(lines, found, lengths, i, probe, h=h, sketch=sketch, own=own):
                k = np.zeros(len(lines), KEY)
                k["key"], k["h"], k["sketch"], k["probe"] = _key(found, lengths, i), h[lines], sketch[lines], probe
                own.append(k)

            every = np.arange(len(start))
            for i in range(edits + 1):
                a, size = segment(length, i, edits)
                record(every, slice_hash(sums, start + a, start + a + size), length, i, 0)
            for lines, a, size, lengths, i in probes(length, edits):
                record(lines, slice_hash(sums, start[lines] + a, start[lines] + a + size), lengths, i, 1)
            held.append(x)
            keys += own
            n += len(x) * 4
            if n >= HELD:
                yield flushed()
                held, keys, n = [], [], 0
        if n:
            yield flushed()

    return run


def in_order(x: np.ndarray) -> np.ndarray:
    """Lines sorted by content and place, without repeats of the same place."""
    x = x[np.lexsort((x["t"], x["line"], x["doc"], x["g"], x["h"]))]
    return x[np.r_[True, np.any([x[k][1:] != x[k][:-1] for k in LINE.names[:-1]], axis=0)]] if len(x) else x


def later(x: np.ndarray) -> np.ndarray:
    """Not the first of its content."""
    return np.r_[False, (x["h"][1:] == x["h"][:-1]) & (x["g"][1:] == x["g"][:-1])] if len(x) else np.zeros(0, bool)


MET = "kind int, h long, other long, key long, sketch int, doc_id long, t long, line int"
MET_SCHEMA = pa.schema([("kind", pa.int32()), ("h", pa.int64()), ("other", pa.int64()), ("key", pa.int64()), ("sketch", pa.int32()),
                        ("doc_id", pa.int64()), ("t", pa.int64()), ("line", pa.int32())])
GONE, FIRST, PAIR, INDEXED, PROBING = range(5)


def _rows(kind: int, n: int, **columns: np.ndarray) -> pa.RecordBatch:
    out = [pa.array(np.full(n, kind, np.int32))]
    for field in list(MET_SCHEMA)[1:]:
        x = columns.get(field.name)
        out.append(pa.nulls(n, field.type) if x is None else pa.array(np.ascontiguousarray(x).view(field.type.to_pandas_dtype())))
    return pa.RecordBatch.from_arrays(out, schema=MET_SCHEMA)


def _meet(edits: int, dense: int):
    def near(index: np.ndarray, probe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = np.nonzero(np.bitwise_count(index["sketch"][:, None] ^ probe["sketch"]) <= 2 * edits)
        ok = index["h"][a] != probe["h"][b]
        return index["h"][a[ok]], probe["h"][b[ok]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, blocks in by_bucket(batches):
            if bucket < 0:
                x = np.concatenate([records(b, LINE) for b in blocks])
                gone = x[x["gone"] == 1]
                x = in_order(x[x["gone"] == 0])
                out = later(x)
                for kind, own in ((GONE, gone), (GONE, x[out]), (FIRST, x[~out])):
                    yield _rows(kind, len(own), h=own["h"], doc_id=own["doc"], t=own["t"], line=own["line"])
                continue
            x = np.concatenate([records(b, KEY) for b in blocks])
            x = x[np.lexsort((x["h"], x["probe"], x["key"]))]
            x = x[np.r_[True, np.any([x[k][1:] != x[k][:-1] for k in KEY.names], axis=0)]]
            cut = np.flatnonzero(np.r_[True, x["key"][1:] != x["key"][:-1], True])
            size, probing = np.diff(cut), np.add.reduceat(x["probe"].astype(np.int64), cut[:-1])
            left, right = [], []
            one = (size == 2) & (probing == 1)  # by far most keys that meet: one line with one other, or with itself
            a = cut[:-1][one]
            ok = (x["h"][a] != x["h"][a + 1]) & (np.bitwise_count(x["sketch"][a] ^ x["sketch"][a + 1]) <= 2 * edits)
            left.append(x["h"][a[ok]])
            right.append(x["h"][a[ok] + 1])
            for k in np.flatnonzero((probing > 0) & (probing < size) & ~one):
                own = x[cut[k] : cut[k + 1]]
                n = len(own) - int(probing[k])
                index, probe = own[:n], own[n:]
                if n * len(probe) <= dense:
                    p, q = near(index, probe)
                    left.append(p)
                    right.append(q)
                    continue
                for kind, part in ((INDEXED, index), (PROBING, probe)):
                    yield _rows(kind, len(part), h=part["h"], key=part["key"], sketch=part["sketch"])
                for part, others in ((probe, index), (index, probe)):  # each with the nearest sketch in order
                    others = others[np.argsort(others["sketch"], kind="stable")]
                    spot = np.minimum(np.searchsorted(others["sketch"], part["sketch"]), len(others) - 1)
                    other = others["h"][spot]
                    fine = (other != part["h"]) & (np.bitwise_count(others["sketch"][spot] ^ part["sketch"]) <= 2 * edits)
                    left.append(part["h"][fine])
                    right.append(other[fine])
            left, right = np.concatenate(left), np.concatenate(right)
            if len(left):
                low, high = np.minimum(left.view("<i8"), right.view("<i8")), np.maximum(left.view("<i8"), right.view("<i8"))
                pairs = np.unique(np.stack([low, high], axis=1), axis=0)
                yield _rows(PAIR, len(pairs), h=pairs[:, 0], other=pairs[:, 1])

    return run


def within(patterns: list[np.ndarray], texts: list[np.ndarray], edits: int) -> np.ndarray:
    """Whether each pair of strings is within the edit distance: bit-parallel columns of a diagonal band.

    All pairs take a column at a time. Bit 63 is the lowest diagonal of the band, where the score stands as long
    as the column meets it; then it moves along the last row.
    """
    n, front = len(patterns), edits + 1  # a common front changes no distance, and makes all longer than the band
    m = np.array([len(p) for p in patterns], np.int64) + front
    k = np.array([len(t) for t in texts], np.int64) + front
    ok = np.abs(m - k) <= edits
    p = np.zeros((n, int(m.max(initial=0)) + 2 * edits + 2), np.uint32)
    t = np.zeros((n, int(k.max(initial=0))), np.uint32)
    for i in range(n):
        p[i, edits : edits + m[i]] = np.r_[np.ones(front, np.uint32), patterns[i] + np.uint32(2)]
        t[i, : k[i]] = np.r_[np.ones(front, np.uint32), texts[i] + np.uint32(2)]
    top = U64(1) << U64(63)
    plus, minus = np.full(n, ~U64(0) << U64(64 - edits - 1)), np.zeros(n, U64)
    score, last_row = np.full(n, edits), np.full(n, U64(62))
    for j in range(t.shape[1]):
        live = j < k
        match = np.zeros(n, U64)
        for d in range(2 * edits + 1):
            column = p[:, j + d] if j + d < p.shape[1] else 0
            match |= (column == t[:, j]).astype(U64) << U64(63 - 2 * edits + d)
        match[~live] = 0
        same = (((match & plus) + plus) ^ plus) | match | minus
        up, down = minus | ~(same | plus), same & plus
        diagonal = j < m - edits
        score += live & diagonal & ((same & top) == 0)
        row = U64(1) << last_row
        score += (live & ~diagonal & ((up & row) != 0)).astype(int) - (live & ~diagonal & ((down & row) != 0)).astype(int)
        last_row = np.where(live & ~diagonal, last_row - U64(1), last_row)
        plus, minus = down | ~((same >> U64(1)) | up), (same >> U64(1)) & up
    return ok & (score <= edits)


def _verify(edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = [[np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in batch[c].to_pylist()] for c in ("x", "y")]
            size = np.array([max(len(a), len(b)) for a, b in zip(*strings, strict=True)])
            order, good = np.argsort(size, kind="stable"), np.zeros(len(size), bool)
            a = 0
            while a < len(order):
                b = a + 1
                while b < len(order) and size[order[b]] * (b + 1 - a) <= LANES:
                    b += 1
                some = order[a:b]
                good[some] = within([strings[0][i] for i in some], [strings[1][i] for i in some], edits)
                a = b
            yield pa.RecordBatch.from_arrays([batch["a"].filter(pa.array(good)), batch["b"].filter(pa.array(good))], names=["a", "b"])

    return run


def near_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, dense: int = DENSE) -> DataFrame:
    """``doc_id, n_lines, removed`` (numbers of the lines to remove, in order) of each row of documents.

    Lines end at ``\\n``; a null or empty text is one empty line. Blank lines stay; lines shorter than
    ``min_chars`` go only as exact copies. Rows with
    equal doc_id and text are one document; with different texts the order is by line, then by a hash of the
    text. Rows without doc_id are compared with nothing. Other columns are not read. Lines are known by a
    64-bit hash between the steps; equal ones by 128 bits.
    """
    spark = docs.sparkSession
    parts = partitions_of(spark)
    buckets = 4 * parts
    every = id_and_text(docs).withColumn("t", F.xxhash64("text"))
    known = every.filter("doc_id is not null")
    sent = known.mapInArrow(_lines(buckets, edits, min_chars), BLOCKS_SQL)
    met = stored(exchanged(sent, parts).mapInArrow(_meet(edits, dense), MET), "lines")
    firsts = met.filter(F.col("kind") == FIRST).select("h", "doc_id", "t", "line")
    one = stored(met.filter(F.col("kind") == PAIR).select(F.col("h").alias("a"), F.col("other").alias("b")).distinct(), "pairs")

    def verified(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("h")).union(pairs.select(F.col("b").alias("h"))).distinct()
        per_text = firsts.join(wanted, "h").groupBy("doc_id", "t").agg(F.collect_list(F.struct("h", "line")).alias("wanted"))
        texts = known.join(per_text.hint("shuffle_hash"), ["doc_id", "t"]).select(F.split("text", "\n").alias("lines"), "wanted")
        texts = texts.select("lines", F.explode("wanted").alias("w")).select(F.col("w.h").alias("h"), F.get("lines", F.col("w.line")).alias("s"))
        texts = stored(texts.dropDuplicates(["h"]), "texts")
        both = pairs.join(texts.select(F.col("h").alias("a"), F.col("s").alias("x")), "a").join(texts.select(F.col("h").alias("b"), F.col("s").alias("y")), "b")
        return stored(both.select("a", "b", "x", "y").mapInArrow(_verify(edits), "a long, b long"), "links")

    links = verified(one)
    roots = components(links)
    crowded = met.filter(F.col("kind").isin(INDEXED, PROBING)).join(roots.withColumnRenamed("node", "h"), "h", "left")
    crowded = stored(crowded.select("kind", "key", "h", "sketch", F.coalesce("root", "h").alias("root")), "crowded")
    if not crowded.isEmpty():
        x, y = crowded.filter(F.col("kind") == INDEXED).alias("x"), crowded.filter(F.col("kind") == PROBING).alias("y")
        more = x.join(y, F.expr(f"x.key = y.key AND x.root != y.root AND bit_count((x.sketch ^ y.sketch) & 4294967295L) <= {2 * edits}"))
        more = more.select(F.least("x.h", "y.h").alias("a"), F.greatest("x.h", "y.h").alias("b")).distinct().join(one, ["a", "b"], "left_anti")
        more = stored(more, "pairs")
        if not more.isEmpty():
            roots = components(links.union(verified(more)))
    classes = firsts.join(roots.withColumnRenamed("node", "h"), "h")
    # the first line of a class stays; the minimum is one row per task and class, the join splits large classes
    place = F.struct("doc_id", "line", "t")
    least = classes.groupBy("root").agg(F.min(place).alias("least"))
    others = classes.join(least, "root").filter(place != F.col("least"))
    gone = met.filter(F.col("kind") == GONE).select("doc_id", "t", "line").union(others.select("doc_id", "t", "line"))
    per_text = gone.groupBy("doc_id", "t").agg(F.array_sort(F.collect_set("line")).alias("removed"))
    shape = every.select("doc_id", "t", F.size(F.split("text", "\n")).alias("n_lines"))
    out = shape.join(per_text, ["doc_id", "t"], "left")
    return out.select("doc_id", "t", "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def without_lines(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents, all columns as they are, with the removed lines cut from their texts."""
    found = found.filter(F.size("removed") > 0).select(F.col("doc_id").alias("_d"), F.col("t").alias("_t"), F.col("removed").alias("_gone")).distinct()
    rows = docs.withColumn("_h", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    rows = rows.join(found.hint("shuffle_hash"), (rows["doc_id"] == found["_d"]) & (rows["_h"] == found["_t"]), "left")
    kept = F.array_join(F.expr("filter(split(text, '\\n'), (x, i) -> NOT array_contains(_gone, i))"), "\n")
    return rows.select(*(F.when(F.col("_gone").isNotNull(), kept).otherwise(F.col(c)).alias(c) if c == "text" else docs[c] for c in docs.columns))


def op2_near_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_lines(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed")

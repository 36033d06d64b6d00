"""Repeated substrings: longest-previous-factor test at a fixed length, over the whole corpus.

A byte goes if some ``length``-byte string that covers it also starts earlier, in a document with a smaller
doc_id or before in the same one. A suffix array of all text would order all its suffixes; here the
suffixes are first dealt out by content, so that all with the same first ``length`` bytes meet:

1.  Each window of ``length`` bytes is named by the least hash of its ``GRAM``-byte grams. Windows next
    to each other mostly share that name, and a run of them is a *segment*. Only segments' hashes travel
    (one per 35 bytes). A segment whose content has an earlier occurrence goes as a whole; one whose name
    no other content has is unique. What is left, some percent, are segments at the edges of repeats: the
    *open* ones.
2.  Of open segments the text travels, again by name. There all windows are sorted (suffix order); the
    nearest smaller positions before and after a window in that order, where the common prefix still
    covers the length, give its previous factor; a window that has one goes.

Names that very many contents share (a sentence in a third of all documents) are told apart by counts and
go to step 2 as 128-bit fingerprints of single windows, dealt by fingerprint, so that no name
gathers in one task. Tasks send each content once, its earliest occurrence; repeats within the task are
decided on the spot.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlark.llm.blocks import by_bucket, dealt, exchanged, planes, records, sliding
from pathlark.llm.common import BLOCKS_SQL, U64, block_batch, id_and_text, mix, partitions_of, pieces, powers, read_table, running, slice_hash
from pathlark.session import stored

LENGTH = 100
GRAM = 32
#: Segments a task holds before it sends them.
HELD = 1 << 20
#: A name with more contents than this is told apart by fingerprints. Decides the way, not the result.
HOT = 20_000
#: Windows sorted at once.
SORTED = 1 << 17
MARK = 128
HOT_BUCKET = -(1 << 31)
SEGMENT = np.dtype([("key", "<u8"), ("seg", "<u8"), ("doc", "<i8"), ("start", "<u4"), ("size", "<u1")])
RANGE = np.dtype([("doc", "<i8"), ("start", "<u4"), ("size", "<u4"), ("key", "<u8"), ("open", "<u1")])
PRINT = np.dtype([("h", "<u8"), ("g", "<u8"), ("doc", "<i8"), ("start", "<u4")])


def segments(flat: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Name, content hash, start, windows of each segment, and whether windows in it may be equal.

    Equal windows of one segment have their least gram at different places, so it occurs twice within a
    window's length; all segments of a document with such a name are marked.
    """
    z = np.zeros(0, np.int64)
    ok = np.diff(at) >= length
    if not ok.any():
        return z.astype(U64), z.astype(U64), z, z, z.astype(bool)
    sums, width = running(flat), length - gram + 1
    i = np.arange(len(flat) - gram + 1)
    grams = slice_hash(sums, i, i + gram)
    least = sliding(grams, width, np.minimum)
    first, last = at[:-1][ok], at[1:][ok] - length + 1
    inside = np.zeros(len(least) + 1, np.int32)
    inside[first] += 1
    np.subtract.at(inside, last, 1)
    inside = np.cumsum(inside[:-1]) > 0
    new = np.r_[True, least[1:] != least[:-1]]
    new[first] = True
    new[last[last < len(least)]] = True
    s = np.flatnonzero(new)
    e = np.r_[s[1:], len(least)]
    s, e = s[inside[s]], e[inside[s]]
    # places of least grams: those that equal the largest name of the windows that hold them
    pad = np.zeros(width - 1, U64)
    held = sliding(np.concatenate([pad, np.where(inside, least, U64(0)), pad]), width, np.maximum)
    spots = np.flatnonzero(held[: len(grams)] == grams)
    near = (np.diff(spots) < width) & (grams[spots[1:]] == grams[spots[:-1]])
    twice = np.zeros(len(s), bool)
    if near.any():
        twice = np.isin(least[s], grams[spots[1:][near]])
    # a name can go on for long only where it repeats; such runs are cut
    if (e - s).max() >= MARK:
        step = np.where(e - s >= MARK, 64, e - s)
        parts = [(k, min(k + w, y)) for x, y, w in zip(s.tolist(), e.tolist(), step.tolist(), strict=True) for k in range(x, y, w)]
        twice = twice[np.searchsorted(s, [a for a, _ in parts], side="right") - 1]
        s, e = np.asarray([a for a, _ in parts]), np.asarray([b for _, b in parts])
    return least[s], slice_hash(sums, s, e + length - 1), s, e - s, twice


def merged(x: np.ndarray) -> np.ndarray:
    """Ranges sorted by document and start, those that touch as one."""
    x = x[np.lexsort((x["start"], x["doc"]))]
    if not len(x):
        return x
    end = x["start"].astype(np.int64) + x["size"]
    cut = np.flatnonzero(np.r_[True, (x["doc"][1:] != x["doc"][:-1]) | (x["start"][1:] != end[:-1])])
    out = x[cut].copy()
    out["size"] = end[np.r_[cut[1:] - 1, len(x) - 1]] - out["start"]
    return out


def ranges(x: np.ndarray, is_open: bool) -> np.ndarray:
    out = np.zeros(len(x), RANGE)
    for name in ("doc", "start", "size"):
        out[name] = x[name]
    if is_open:
        out["key"], out["open"] = x["key"], 1
        return out
    return merged(out)


def in_order(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments sorted by name, content and position; where a name and where a content begins."""
    x = x[np.lexsort((x["start"], x["doc"], x["seg"], x["key"]))]
    if len(x):  # the same place in repeated rows
        x = x[np.r_[True, np.any([x[k][1:] != x[k][:-1] for k in SEGMENT.names], axis=0)]]
    key = np.r_[True, x["key"][1:] != x["key"][:-1]] if len(x) else np.zeros(0, bool)
    return x, key, key | np.r_[True, x["seg"][1:] != x["seg"][:-1]] if len(x) else key


def _send(x: np.ndarray, twice: np.ndarray, buckets: int) -> list[tuple[int, bytes]]:
    """What a task knows of its segments by itself, and the rest for the others.

    A name that has several contents here is open for all tasks, which two marked segments tell; their
    first one's start holds the number of contents.
    """
    tied = np.unique(x["key"][twice])
    x, key, content = in_order(x)
    of = np.cumsum(key) - 1
    contents = np.bincount(of[content]) if len(x) else np.zeros(0, np.int64)
    several = (contents[of] > 1) | np.isin(x["key"], tied)
    marks = x[key & several].copy()
    second = marks.copy()
    marks["start"], marks["size"] = contents[of[key & several]], MARK
    second["seg"] ^= U64(1)
    second["start"], second["size"] = 0, MARK
    alone = np.concatenate([x[content & ~several], marks, second])
    own = np.concatenate([ranges(x[~content], False), ranges(x[content & several], True)])
    return dealt(alone, alone["key"], buckets) + dealt(own, own["doc"], buckets, -buckets)


def _segmented(length: int, gram: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ties, n = [], [], 0
        for part, flat, at in pieces(batches):
            key, seg, start, size, twice = segments(flat, at, length, gram)
            x = np.zeros(len(key), SEGMENT)
            row = np.searchsorted(at, start, side="right") - 1
            x["key"], x["seg"], x["size"] = key, seg, size
            x["doc"], x["start"] = part["doc_id"].to_numpy(zero_copy_only=False)[row], start - at[row]
            held.append(x)
            ties.append(twice)
            n += len(x)
            if n >= HELD:
                yield block_batch(_send(np.concatenate(held), np.concatenate(ties), buckets))
                held, ties, n = [], [], 0
        if n:
            yield block_batch(_send(np.concatenate(held), np.concatenate(ties), buckets))

    return run


def _decided(buckets: int, hot: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, blocks in by_bucket(batches):
            if bucket < 0:
                yield block_batch([(bucket, b) for b in blocks])
                continue
            x, key, content = in_order(np.concatenate([records(b, SEGMENT) for b in blocks]))
            of, mark = np.cumsum(key) - 1, x["size"] == MARK
            several = np.bincount(of[content]) > 1
            total = np.bincount(of[content & ~mark], minlength=len(several)) + np.bincount(of[mark], x["start"][mark], len(several))
            group = np.cumsum(content) - 1
            plain, group = x[~mark], group[~mark]
            first = np.r_[True, group[1:] != group[:-1]] if len(plain) else np.zeros(0, bool)
            own = np.concatenate([ranges(plain[~first], False), ranges(plain[first & several[of[~mark]]], True)])
            out = dealt(own, own["doc"], buckets, -buckets)
            many = x["key"][key][total > hot]
            if len(many):
                out.append((HOT_BUCKET, many.tobytes()))
            if out:
                yield block_batch(out)

    return run


def _per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its ranges to remove and its open ones."""
    for _, blocks in by_bucket(batches):
        x = np.concatenate([records(b, RANGE) for b in blocks])
        x = x[np.argsort(x["doc"], kind="stable")]
        cut = np.flatnonzero(np.r_[True, x["doc"][1:] != x["doc"][:-1], True])
        ids, gone, left = [], [], []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            own = x[a:b]
            ids.append(int(own["doc"][0]))
            gone.append(planes(merged(own[own["open"] == 0])))
            left.append(planes(own[own["open"] == 1]))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(gone, pa.binary()), pa.array(left, pa.binary())], names=["doc_id", "gone", "left"])


def spans_of(gone: np.ndarray, n: int, length: int) -> np.ndarray:
    """Removed runs of bytes as rows of start and end. Ranges beyond the text are cut off."""
    if not len(gone):
        return np.zeros((0, 2), np.int64)
    start = gone["start"].astype(np.int64)
    end = np.minimum(start + gone["size"] + length - 1, n)
    order = np.argsort(start)
    start, end = start[order], end[order]
    start, end = start[start < n], end[start < n]
    reach = np.maximum.accumulate(end) if len(end) else end
    new = np.r_[True, start[1:] > reach[:-1]] if len(start) else np.zeros(0, bool)
    cut = np.flatnonzero(new)
    return np.stack([start[cut], reach[np.r_[cut[1:] - 1, len(start) - 1]]], axis=1) if len(cut) else np.zeros((0, 2), np.int64)


def outcome(flat: np.ndarray, gone: np.ndarray, length: int) -> tuple[list[dict], str]:
    spans, sha, at = spans_of(gone, len(flat), length), hashlib.sha256(), 0
    for a, b in spans:
        sha.update(flat[at:a])
        at = b
    sha.update(flat[at:])
    return [{"start": int(a), "end": int(b)} for a, b in spans], sha.hexdigest()


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
DONE = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept_sha256 string"
STEP = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", SPANS), ("kept_sha256", pa.string()),
                  ("text", pa.binary()), ("gone", pa.binary()), ("bucket", pa.int32()), ("block", pa.binary())])
STEP_SQL = DONE + ", text binary, gone binary, " + BLOCKS_SQL


def _window_prints(flat: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    sums = running(flat)
    other = np.zeros(len(flat) + 1, U64)
    np.cumsum((mix(flat.astype(U64) + U64(911)) | U64(1)) * powers(0xD1342543DE82EF95, len(flat))[:-1], out=other[1:])
    back = powers(pow(0xD1342543DE82EF95, -1, 1 << 64), len(flat))[starts]
    return slice_hash(sums, starts, starts + length), mix((other[starts + length] - other[starts]) * back)


def _opened(length: int, buckets: int, hot_keys):
    """Documents without open segments are done; of the others, the open segments' text goes out by name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = np.frombuffer(hot_keys.value, "<u8")
        for part, flat, at in pieces(batches):
            out, heads, texts, prints = [], [], [], []
            for i, (doc, gone, left) in enumerate(zip(part["doc_id"].to_pylist(), part["gone"].to_pylist(), part["left"].to_pylist(), strict=True)):
                own = flat[at[i] : at[i + 1]]
                todo = records(left or b"", RANGE)
                todo = todo[todo["start"].astype(np.int64) + todo["size"] + length - 1 <= len(own)]
                if not len(todo):
                    spans, sha = outcome(own, records(gone or b"", RANGE), length)
                    out.append((doc, len(own), spans, sha, None, None, None, None))
                    continue
                out.append((doc, len(own), None, None, own.tobytes(), gone, None, None))
                wide = np.isin(todo["key"], hot)
                if wide.any():
                    starts = np.concatenate([np.arange(r["start"], int(r["start"]) + int(r["size"])) for r in todo[wide]])
                    x = np.zeros(len(starts), PRINT)
                    x["h"], x["g"] = _window_prints(own, starts, length)
                    x["doc"], x["start"] = doc, starts
                    prints.append(x)
                todo = todo[~wide]
                heads.append(todo)
                texts += [own[int(s) : int(s) + int(n) + length - 1] for s, n in zip(todo["start"], todo["size"], strict=True)]
            if heads:
                x = np.concatenate(heads)
                where = (mix(x["key"]) % U64(buckets)).astype(np.int64)
                order = np.argsort(where, kind="stable")
                cuts = np.flatnonzero(np.r_[True, where[order][1:] != where[order][:-1], True]) if len(order) else []
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    own = order[a:b]
                    block = struct.pack("<I", len(own)) + planes(x[own]) + b"".join(texts[k].tobytes() for k in own)
                    out.append((None,) * 6 + (int(where[own[0]]), block))
            if prints:
                x = np.concatenate(prints)
                x = x[np.lexsort((x["start"], x["doc"], x["g"], x["h"]))]
                same = np.r_[False, (x["h"][1:] == x["h"][:-1]) & (x["g"][1:] == x["g"][:-1])]
                gone = np.zeros(int(same.sum()), RANGE)
                gone["doc"], gone["start"], gone["size"] = x["doc"][same], x["start"][same], 1
                gone = merged(gone)
                out += [(None,) * 6 + y for y in dealt(gone, gone["doc"], buckets, -buckets)]
                x = x[~same]
                out += [(None,) * 6 + y for y in dealt(x, x["h"], buckets, buckets)]
            for a in range(0, len(out), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[a : a + 2000], strict=True), STEP, strict=True)], schema=STEP)

    return run


def previous_factors(position: np.ndarray, run: np.ndarray) -> np.ndarray:
    """In suffix order, whose ``run`` numbers change where the common prefix is too short: has a suffix one
    with a smaller position before or after it in its run? The running minimum from either side tells
    whether a previous or a next smaller position stands there."""
    n = len(position)
    far = np.int64(n + 1)

    def earlier(p: np.ndarray, r: np.ndarray) -> np.ndarray:
        low = np.minimum.accumulate(p - r * far)
        return np.r_[False, (low[:-1] < (p - r * far)[1:]) & (r[1:] == r[:-1])] if n else np.zeros(0, bool)

    before = earlier(position, run)
    after = earlier(position[::-1], (run[-1] - run)[::-1])[::-1] if n else before
    return before | after


def _ranked(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Numbers in order of document and start, equal where both are."""
    order = np.lexsort((start, doc))
    new = np.r_[0, (np.diff(doc[order]) != 0) | (np.diff(start[order]) != 0)]
    out = np.empty(len(doc), np.int64)
    out[order] = np.cumsum(new)
    return out


def _factored(length: int, buckets: int):
    def gone(doc: np.ndarray, start: np.ndarray) -> list[tuple[int, bytes]]:
        x = np.zeros(len(doc), RANGE)
        x["doc"], x["start"], x["size"] = doc, start, 1
        x = merged(x)
        return dealt(x, x["doc"], buckets, -buckets)

    def sort_windows(heads: np.ndarray, text: np.ndarray, offset: np.ndarray) -> list[tuple[int, bytes]]:
        n = heads["size"].astype(np.int64)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        where = np.repeat(offset, n) + inner
        doc, start = np.repeat(heads["doc"], n), np.repeat(heads["start"].astype(np.int64), n) + inner
        windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, length)[where]).view(f"S{length}").ravel()
        order = np.argsort(windows, kind="stable")
        windows = windows[order]
        run = np.cumsum(np.r_[0, windows[1:] != windows[:-1]])
        late = previous_factors(_ranked(doc, start)[order], run)
        return gone(doc[order][late], start[order][late])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, blocks in by_bucket(batches):
            if bucket < 0:
                yield block_batch([(bucket, b) for b in blocks])
                continue
            if bucket >= buckets:
                x = np.concatenate([records(b, PRINT) for b in blocks])
                order = np.lexsort((x["g"], x["h"]))
                x = x[order]
                groups = np.cumsum(np.r_[0, (x["h"][1:] != x["h"][:-1]) | (x["g"][1:] != x["g"][:-1])])
                late = previous_factors(_ranked(x["doc"], x["start"].astype(np.int64)), groups)
                yield block_batch(gone(x["doc"][late], x["start"][late].astype(np.int64)))
                continue
            heads, texts = [], []
            for b in blocks:
                n, = struct.unpack_from("<I", b)
                heads.append(records(b[4 : 4 + n * RANGE.itemsize], RANGE))
                texts.append(np.frombuffer(b, np.uint8, offset=4 + n * RANGE.itemsize))
            x, text = np.concatenate(heads), np.concatenate(texts)
            size = x["size"].astype(np.int64) + length - 1
            offset = np.cumsum(size) - size
            order = np.argsort(x["key"], kind="stable")
            x, offset, held = x[order], offset[order], np.cumsum(x["size"][order].astype(np.int64))
            key_end = np.flatnonzero(np.r_[x["key"][1:] != x["key"][:-1], True]) + 1
            a = 0
            while a < len(x):  # whole names, about SORTED windows at a time
                before = held[a - 1] if a else 0
                fits = key_end[(key_end > a) & (held[key_end - 1] <= before + SORTED)]
                b = int(fits[-1]) if len(fits) else int(key_end[key_end > a][0])
                out = sort_windows(x[a:b], text, offset[a:b])
                if out:
                    yield block_batch(out)
                a = b

    return run


def _finished(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in (batch.slice(a, 500) for a in range(0, batch.num_rows, 500)):
                rows = []
                for doc, text, gone, more in zip(*(some[c].to_pylist() for c in ("doc_id", "text", "gone", "more")), strict=True):
                    flat = np.frombuffer(text, np.uint8)
                    spans, sha = outcome(flat, np.concatenate([records(gone or b"", RANGE), records(more or b"", RANGE)]), length)
                    rows.append((doc, len(flat), spans, sha))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(STEP)[:4], strict=True)], names=STEP.names[:4])

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, spans`` (removed runs of UTF-8 bytes) and ``kept_sha256`` of each row.

    Null and empty texts have no bytes, texts shorter than ``length`` lose none. Rows with equal doc_id are
    one document: ranges found in either are removed from each, as far as its text reaches; equal
    rows are no copies of each other. Rows without doc_id have no place in the order: they are kept whole
    and matched with nothing. Other columns are not read.
    """
    spark = docs.sparkSession
    parts = partitions_of(spark)
    buckets = 4 * parts
    every = id_and_text(docs)
    known = every.filter("doc_id is not null")
    sent = known.mapInArrow(_segmented(length, gram, buckets), BLOCKS_SQL)
    first = stored(exchanged(sent, parts).mapInArrow(_decided(buckets, hot), BLOCKS_SQL), "ranges")
    # at most (all segments / hot) names
    hot_keys = b"".join(sorted(bytes(r.block) for r in first.filter(F.col("bucket") == HOT_BUCKET).collect()))

    def per_document(blocks: DataFrame) -> DataFrame:
        own = blocks.filter((F.col("bucket") < 0) & (F.col("bucket") > HOT_BUCKET))
        return exchanged(own, parts).mapInArrow(_per_document, "doc_id long, gone binary, left binary")

    joined = every.join(per_document(first).hint("shuffle_hash"), "doc_id", "left")
    step = stored(joined.mapInArrow(_opened(length, buckets, spark.sparkContext.broadcast(hot_keys)), STEP_SQL), "open")
    second = exchanged(step.filter("bucket is not null").select("bucket", "block"), parts).mapInArrow(_factored(length, buckets), BLOCKS_SQL)
    second = per_document(stored(second, "ranges")).select("doc_id", F.col("gone").alias("more"))
    done = step.filter("kept_sha256 is not null").select("doc_id", "n_bytes", "spans", "kept_sha256")
    late = step.filter("text is not null").select("doc_id", "text", "gone").join(second.hint("shuffle_hash"), "doc_id", "left")
    return done.union(late.mapInArrow(_finished(length), DONE))


def op1_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")

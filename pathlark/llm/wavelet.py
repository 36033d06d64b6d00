"""Token ids in wavelet-matrix shards: access, counts and occurrences straight from the compressed form.

A shard holds up to ``SHARD`` tokens of consecutive documents (a longer document is a shard of its own).
Its ids are numbered by rank among the distinct ids of the shard; of these numbers the wavelet matrix
keeps one bit plane per binary digit, highest first, in which the tokens are stably split by that digit
from plane to plane. A running count of ones before each 512 bits gives rank in a bounded look, and
binary search on it gives select.

Layout of a shard, little-endian: magic ``WMX1``; u32 version, planes, distinct ids, documents; u64
tokens; distinct ids as u32; per document its u64 id and u32 token count; per plane the counts before
each 512 bits as u32, then the bits, first bit highest in its byte.

Shards are rows of a Parquet table, since Spark's writers commit files safely to any store when tasks are
repeated; ``part`` and ``no`` give their order.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pathlark.llm.common import id_and_text, partitions_of, read_table
from pathlark.session import fresh_path

TOKENIZER = "word_bpe_49k.json"
END = 2
SHARD = 1 << 18
#: Words whose ids a worker remembers at most; beyond, it starts anew. Results do not depend on it.
REMEMBERED = 300_000
MAGIC, BLOCK = b"WMX1", 512
ASCII_PARTS = re.compile(r"[A-Za-z]+|[0-9]|[^\sA-Za-z0-9]+")


class Shard:
    """Reads one shard."""

    def __init__(self, data: bytes):
        head = struct.unpack_from("<4sIIIIQ", data)
        if head[0] != MAGIC:
            raise ValueError("not a shard of token ids")
        _, _, self.planes, self.distinct, self.documents, self.n = head
        at = struct.calcsize("<4sIIIIQ")

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype=kind, count=count, offset=at)
            at += out.nbytes
            return out

        self.symbols = take("<u4", self.distinct)
        self.doc_ids = take("<i8", self.documents)
        self.lengths = take("<u4", self.documents)
        blocks = self.n // BLOCK + 1
        self.counts, self.bits = [], []
        for _ in range(self.planes):
            self.counts.append(take("<u4", blocks))
            self.bits.append(take("u1", (self.n + 7) // 8))
        self.ones = [int(np.unpackbits(b, count=self.n).sum()) if self.n else 0 for b in self.bits]

    def _rank(self, plane: int, i: int) -> int:
        """Ones before position i."""
        block = i // BLOCK
        first = block * BLOCK
        tail = np.unpackbits(self.bits[plane][first // 8 : (i + 7) // 8])[: i - first]
        return int(self.counts[plane][block]) + int(tail.sum())

    def _select(self, plane: int, bit: int, j: int) -> int:
        """Position of the j-th (from 0) bit of this value."""
        counts = self.counts[plane].astype(np.int64)
        if not bit:
            counts = np.arange(len(counts)) * BLOCK - counts
        block = int(np.searchsorted(counts, j, side="right")) - 1
        first = block * BLOCK
        here = np.unpackbits(self.bits[plane][first // 8 : min(len(self.bits[plane]), first // 8 + BLOCK // 8)])[: self.n - first]
        return first + int(np.flatnonzero(here == bit)[j - int(counts[block])])

    def access(self, i: int) -> int:
        value = 0
        for p in range(self.planes):
            ones = self._rank(p, i)
            bit = int(self.bits[p][i // 8] >> (7 - i % 8)) & 1
            value = value * 2 + bit
            i = self.n - self.ones[p] + ones if bit else i - ones
        return int(self.symbols[value])

    def _range(self, token: int, till: int) -> tuple[int, int, int]:
        """Where the occurrences of a token before ``till`` stand below the last plane, and its number."""
        s = int(np.searchsorted(self.symbols, token))
        if s >= self.distinct or self.symbols[s] != token:
            return 0, 0, -1
        a, b = 0, till
        for p in range(self.planes):
            x, y = self._rank(p, a), self._rank(p, b)
            if s >> (self.planes - 1 - p) & 1:
                a, b = self.n - self.ones[p] + x, self.n - self.ones[p] + y
            else:
                a, b = a - x, b - y
        return a, b, s

    def count(self, token: int, till: int | None = None) -> int:
        """Occurrences before position ``till``, or in all."""
        a, b, _ = self._range(token, self.n if till is None else till)
        return b - a

    def locate(self, token: int, j: int) -> int:
        """Position of the j-th (from 0) occurrence."""
        a, b, s = self._range(token, self.n)
        if not 0 <= j < b - a:
            raise IndexError(j)
        i = a + j
        for p in reversed(range(self.planes)):
            bit = s >> (self.planes - 1 - p) & 1
            i = self._select(p, bit, i - (self.n - self.ones[p]) if bit else i)
        return i

    def tokens(self) -> np.ndarray:
        """All ids in order: the splits undone from the last plane up."""
        now = np.zeros(self.n, np.uint32)
        for p in reversed(range(self.planes)):
            mask = np.unpackbits(self.bits[p], count=self.n).astype(bool)
            zeros, before = self.n - self.ones[p], np.empty_like(now)
            before[np.flatnonzero(~mask)] = now[:zeros]
            before[np.flatnonzero(mask)] = now[zeros:] | np.uint32(1 << (self.planes - 1 - p))
            now = before
        return self.symbols[now] if self.n else now


def build(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """A shard of the ids of some documents, one after the other."""
    n = len(ids)
    present = np.zeros(int(ids.max()) + 1 if n else 0, bool)
    present[ids] = True
    symbols = np.flatnonzero(present)
    number = np.cumsum(present, dtype=np.int64) - 1
    now = number[ids].astype(np.uint16 if len(symbols) <= 1 << 16 else np.uint32) if n else np.zeros(0, np.uint16)
    planes = max(len(symbols) - 1, 0).bit_length()
    out = [struct.pack("<4sIIIIQ", MAGIC, 1, planes, len(symbols), len(doc_ids), n),
           symbols.astype("<u4").tobytes(), doc_ids.astype("<i8").tobytes(), lengths.astype("<u4").tobytes()]
    for p in reversed(range(planes)):
        mask = ((now >> now.dtype.type(p)) & now.dtype.type(1)).astype(bool)
        full = np.zeros((n // BLOCK + 1) * BLOCK, bool)
        full[:n] = mask
        sums = np.cumsum(full.reshape(-1, BLOCK).sum(axis=1, dtype=np.int64))
        out += [np.r_[0, sums[:-1]].astype("<u4").tobytes(), np.packbits(mask).tobytes()]
        now = np.concatenate([np.compress(~mask, now), np.compress(mask, now)])
    return b"".join(out)


class _Signs(dict):
    """How the byte-level pre-tokenizer writes a letter."""

    def __init__(self, whole: Tokenizer):
        super().__init__()
        self.whole = whole

    def __missing__(self, letter: str) -> str:
        self[letter] = self.whole.pre_tokenizer.pre_tokenize_str(letter)[0][0]
        return self[letter]


class _Words(dict):
    """Ids of white-space separated words, by the tokenizers library.

    This tokenizer's pre-tokens are runs of letters, single digits and runs of other signs, none with white
    space, so a text's ids are those of its words, and a plain word's those of its parts. Words with an
    apostrophe or other characters outside ASCII than letters go through the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        #: As the file has it: added tokens in a text become their ids.
        self.default = Tokenizer.from_file(path)
        self.added = [t.content for t in self.default.get_added_tokens_decoder().values()]
        self.signs = _Signs(self.whole)
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:  # words that come often move on from the older half
            self.older = dict(self)
            self.clear()
        ids = self.older.get(word)
        if ids is None:
            ids = self._of(word)
        self[word] = ids
        return ids

    def _of(self, word: str) -> bytes:
        stem = word.rstrip(".,")
        if stem != word and stem[-1:].isalnum():  # a pre-token ends behind the stem
            return self[stem] + self[word[len(stem):]]
        if word.isalpha():
            if not (word.isascii() and word.islower() or latin(word) and word == word.lower()):
                word = self.whole.normalizer.normalize_str(word)
            if word.isalpha():  # one pre-token
                signs = word if word.isascii() else "".join(map(self.signs.__getitem__, word))
                return np.asarray([t.id for t in self.whole.model.tokenize(signs)], dtype="<u4").tobytes()
        elif word.isascii() and "'" not in word:
            # letters, single digits and other signs are pre-tokens of their own
            parts = ASCII_PARTS.findall(word.lower())
            if len(parts) > 1:
                return b"".join(map(self.__getitem__, parts))
        return self._ids(word)

    def with_added(self, text: str) -> bytes:
        return np.asarray(self.default.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _ids(self, text: str) -> bytes:
        return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@cache
def words_of(path: str) -> _Words:
    return _Words(path)


def latin(text: str) -> bool:
    """Only characters up to Latin Extended-B: composed already, and each one's lower case is one character."""
    return text.isascii() or max(text, default="") < "\u0250" and "\u0130" not in text


def word_splits(text: str) -> list[str]:
    """Cut at blanks and line ends only; other white space is left to the tokenizer.

    Latin text is lower-cased first, as the tokenizer does, so that fewer different words come up.
    """
    if latin(text):
        text = text.lower()
    return text.replace("\n", " ").split(" ")


def _to_shards(path: str, end: int, size: int, added: bool):
    tail = np.asarray([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        names = ["part", "no", "shard"]
        ids, docs, lengths, held, no, part = [], [], [], 0, 0, 0

        def flushed() -> pa.RecordBatch:
            data = build(np.frombuffer(b"".join(ids), dtype="<u4"), np.asarray(docs, np.int64), np.asarray(lengths, np.int64))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([no], pa.int32()), pa.array([data], pa.binary())], names=names)

        for some in (batch.slice(a, 128) for batch in batches for a in range(0, batch.num_rows, 128)):
            for part, doc, text in zip(*(c.to_pylist() for c in some.columns), strict=True):
                if added and any(t in text for t in words.added):
                    own = words.with_added(text) + tail
                else:
                    own = b"".join(map(words.__getitem__, word_splits(text))) + tail
                if held and held + len(own) // 4 > size:
                    yield flushed()
                    ids, docs, lengths, held, no = [], [], [], 0, no + 1
                ids.append(own)
                docs.append(doc)
                lengths.append(len(own) // 4)
                held += len(own) // 4
        if docs:
            yield flushed()

    return run


def write_shards(docs: DataFrame, path: str, out: str, end: int = END, size: int = SHARD, added: bool = False) -> None:
    """Tokenise all documents with ``path`` and write shards to ``out`` in ascending doc_id.

    With ``added``, added tokens that a text holds (``<|endoftext|>``) become their ids, as by the library's default;
    without, they are text like any other.

    Null and empty texts hold the end id alone. Rows with equal doc_id stay rows of their own, in the order of
    their texts; rows without a doc_id are left out, since the format numbers documents. An empty table
    gives an empty table of shards.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs).filter("doc_id is not null").repartitionByRange(partitions_of(spark), "doc_id")
    rows = rows.sortWithinPartitions("doc_id", "text").select(F.spark_partition_id().alias("part"), "doc_id", "text")
    rows.mapInArrow(_to_shards(path, end, size, added), "part int, no int, shard binary").write.parquet(out)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "no", "place", "doc_id", "ids"]
    for batch in batches:
        for part, no, data in zip(batch["part"].to_pylist(), batch["no"].to_pylist(), batch["shard"], strict=True):
            shard = Shard(data.as_py())
            ids, n = shard.tokens(), shard.documents
            ends = np.cumsum(shard.lengths)
            yield pa.RecordBatch.from_arrays([
                pa.array([part] * n, pa.int32()), pa.array([no] * n, pa.int32()), pa.array(range(n), pa.int32()),
                pa.array(shard.doc_ids), pa.array([ids[e - k : e].astype("<u4").tobytes() for e, k in zip(ends, shard.lengths, strict=True)], pa.binary()),
            ], names=names)


def read_documents(spark: SparkSession, out: str) -> DataFrame:
    """``part, no, place, doc_id, ids`` of every document in the shards."""
    shards = spark.read.schema("part int, no int, shard binary").parquet(out)
    return shards.mapInArrow(_documents, "part int, no int, place int, doc_id long, ids binary")


def token_index(spark: SparkSession, out: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the shards.

    Starts within a part come from a window over that part's documents; parts are few, one per partition
    that wrote, so their running sum is one small window.
    """
    docs = read_documents(spark, out).select(
        "part", "no", "place", "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    inside = Window.partitionBy("part").orderBy("no", "place").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    lengths = spark.read.schema("part int, no int, shard binary").parquet(out)
    # tokens of a shard: eight bytes at offset 20 of its head, little-endian
    digits = F.regexp_extract_all(F.hex(F.substring("shard", 21, 8)), F.lit("(..)"), F.lit(1))
    size = F.conv(F.array_join(F.reverse(digits), ""), 16, 10).cast("long")
    totals = lengths.groupBy("part").agg(F.sum(size).alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"))
    return docs.join(totals, "part").select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_path(spark, "shards")
    write_shards(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), out, added=True)
    return token_index(spark, out)

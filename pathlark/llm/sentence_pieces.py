"""SentencePiece ids of merge-type models by backtracking, and back to text.

Merging the best pair first, over and over, ends in the one sequence of pieces of which every two neighbours are
compatible: merging them again from their characters gives the same two pieces. So a text is encoded from left
to right. An Aho-Corasick pass gives the longest piece from each position; the longest one that is compatible
with the piece before it is taken, else the next shorter one; where none is left, the position is marked in a
bitfield as failed, and the piece before it is shortened. No position fails twice.

The check needs merges of different ranks. Pieces from the best score that two pieces share downwards are the
tail (runs of blanks in the known models): they are merged afterwards, pair by pair, over the pieces found.

Texts are cut between any two characters that follow each other in no piece of the model, since merges cannot
cross there: between words, mostly. The stretches between the cuts repeat, and their ids are remembered.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from pathlark.llm.common import id_and_text, read_table

MODEL = "piece_bpe_32k.model"
#: Stretches up to this length are remembered. A worker keeps twice as many of them, those met again longest, and
#: as many pairs before it starts anew.
SHORT, REMEMBERED = 48, 250_000


class Merges:
    """Pieces (of normal text) and their scores."""

    def __init__(self, scores: dict[str, float]):
        self.scores = {p: s for p, s in scores.items() if len(p) > 1}
        shared = [s for s, n in Counter(self.scores.values()).items() if n > 1]
        self.tail = {p for p, s in self.scores.items() if shared and s <= max(shared)}
        head = sorted((p for p in self.scores if p not in self.tail), key=lambda p: -self.scores[p])
        self.rank: dict[str, int] = {}
        self.parts: dict[str, tuple[str, str]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        missed = []
        for k, piece in enumerate(head):
            for i in range(len(piece) - 1, 0, -1):
                left, right = piece[:i], piece[i:]
                if (i == 1 or left in self.rank) and (len(right) == 1 or right in self.rank) and self.compatible(left, right):
                    self.rank[piece], self.parts[piece] = k, (left, right)
                    break
            else:
                missed.append(piece)
        # a piece that merging makes although its parts have lower scores breaks the order the check relies on
        self.ordered = all(len(self.plainly(p)) > 1 for p in missed)
        self.shorter = {}
        for piece in self.rank:
            self.shorter[piece] = next((n for n in range(len(piece) - 1, 1, -1) if piece[:n] in self.rank), 1)
        self.longest = ahocorasick.Automaton()
        for piece in self.rank:
            self.longest.add_word(piece, len(piece))
        self.longest.make_automaton()
        chars = sorted({c for p in self.scores for c in p})
        self.number = np.zeros(0x110000, np.uint16)  # 0: in no piece of several characters
        self.number[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.follows = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for p in self.scores:
            own = self.number[[ord(c) for c in p]]
            self.follows[own[:-1], own[1:]] = True
        self.tail_pairs = {p[i : i + 2] for p in self.tail for i in range(len(p) - 1)}

    def cuts(self, text: str) -> list[int]:
        """Where stretches that merge on their own begin and end."""
        own = self.number[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        return [0, *(np.flatnonzero(~self.follows[own[:-1], own[1:]]) + 1).tolist(), len(text)]

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the characters of both gives these two pieces again.

        Undoes the merges next to the boundary, the latest first; a merge across it that comes before the
        undone one would have been made instead. Of equal merges the one further left comes first.
        """
        limit = len(self.scores) + 1
        while True:
            across = self.rank.get(left + right)
            if across is not None and across < limit:
                return False
            p, q = self.rank.get(left, -1), self.rank.get(right, -1)
            if p < 0 and q < 0:
                return True
            if p > q:
                limit, left = p, self.parts[left][1]
            else:
                limit, right = q + 1, self.parts[right][0]

    def fits(self, left: str, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            known = self.pairs[left, right] = self.compatible(left, right)
        return known

    def backtracked(self, text: str) -> list[str]:
        n, shorter, pairs = len(text), self.shorter, self.pairs
        longest = array("H", [1]) * n
        if self.rank:
            for end, size in self.longest.iter(text):  # ends ascend, so the last one from a start is the longest
                longest[end - size + 1] = size
        failed = bytearray(n // 8 + 1)
        out: list[str] = []
        at, last, size = 0, "", longest[0] if n else 0
        while at < n:
            token = text[at : at + size]
            while True:
                end = at + size
                if not failed[end >> 3] & (1 << (end & 7)) and (not out or (self.fits(last, token) if (fit := pairs.get((last, token))) is None else fit)):
                    out.append(token)
                    at, last = end, token
                    size = longest[end] if end < n else 0
                    break
                if size == 1:
                    failed[at >> 3] |= 1 << (at & 7)
                    size = len(out.pop())
                    at -= size
                    last = out[-1] if out else ""
                    break
                size = shorter[token]
                token = token[:size]
        return out

    def plainly(self, symbols) -> list[str]:
        """Merges pair by pair: the best score first, of equal ones the one further left."""
        now, after, before = list(symbols), list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        heap: list[tuple[float, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            score = self.scores.get(now[i] + now[j])
            if score is not None:
                heapq.heappush(heap, (-score, i, j, len(now[i]) + len(now[j])))

        for i in range(len(now) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            if not now[i] or not now[j] or after[i] != j or len(now[i]) + len(now[j]) != size:
                continue
            now[i], now[j], after[i] = now[i] + now[j], "", after[j]
            if after[j] < len(now):
                before[after[j]] = i
                offer(i, after[j])
            if before[i] >= 0:
                offer(before[i], i)
        return [x for x in now if x]

    def pieces(self, text: str) -> list[str]:
        if not self.ordered:
            return self.plainly(text)
        out = self.backtracked(text)
        if any(pair in text for pair in self.tail_pairs) and any(a + b in self.tail for a, b in zip(out, out[1:])):
            out = self.plainly(out)
        return out


class Encoder:
    """Ids as the library gives them, for models of merge type with byte fallback."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        kinds = range(len(self.model))
        self.bytes = [i for i in kinds if self.model.is_byte(i)]
        if len(self.bytes) != 256 or any(self.model.is_unused(i) for i in kinds):
            raise ValueError("needs a model with byte fallback and without unused pieces")
        other = set(self.bytes) | {i for i in kinds if self.model.is_control(i) or self.model.is_unknown(i)}
        self.ids = {self.model.id_to_piece(i): i for i in kinds if i not in other}
        self.merges = Merges({p: self.model.get_score(i) for p, i in self.ids.items()})
        self.known: dict[str, tuple[int, ...]] = {}
        self.before: dict[str, tuple[int, ...]] = {}

    def stretch(self, text: str) -> tuple[int, ...]:
        found = self.before.get(text)
        if found is None:
            out: list[int] = []
            for piece in self.merges.pieces(text):
                own = self.ids.get(piece)
                if own is None:  # one character that is no piece
                    out += [self.bytes[b] for b in piece.encode()]
                else:
                    out.append(own)
            found = tuple(out)
        if len(text) <= SHORT:
            if len(self.known) >= REMEMBERED:
                self.known, self.before = {}, self.known
            self.known[text] = found
        return found

    def encode(self, text: str) -> list[int]:
        plain = self.model.normalize(text)
        out: list[int] = []
        if plain:
            cuts = self.merges.cuts(plain)
            for a, b in zip(cuts, cuts[1:]):
                own = plain[a:b]
                found = self.known.get(own)
                out += self.stretch(own) if found is None else found
        return out

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _texts(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        for a in range(0, batch.num_rows, size):
            some = batch.slice(a, size)
            yield some, some["text"].to_pylist()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit integers), one row for each row of documents.

    Equal to the library's ids without begin and end. Null and empty texts have none. Rows with equal or null
    ids stay rows of their own. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(path)
        for some, texts in _texts(batches):
            ids = [np.asarray(of.encode(x), dtype="<u4").tobytes() for x in texts]
            yield pa.RecordBatch.from_arrays([some["doc_id"], pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids binary")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and the ``text`` the ids stand for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(path)
        for batch in batches:
            back = [of.decode(np.frombuffer(x, "<u4").tolist()) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(back, pa.string())], names=["doc_id", "ids", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Number and digest of each text's ids, and the digest of the text they decode to, in one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(path)
        decimal = [str(i) for i in range(len(of.model))].__getitem__
        for some, texts in _texts(batches):
            counts, ids, back = [], [], []
            for text in texts:
                found = of.encode(text)
                counts.append(len(found))
                ids.append(hashlib.sha256(",".join(map(decimal, found)).encode()).hexdigest())
                back.append(hashlib.sha256(of.decode(found).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([some["doc_id"], pa.array(counts, pa.int64()), pa.array(ids), pa.array(back)],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))

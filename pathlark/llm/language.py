"""Language of documents: script ranges, per-word scores, and Viterbi over the words.

A word is a run of letters. Its script (by the range of its first letter) leaves the learned languages
that are written in it; each of those scores the word by the log probabilities of its letters between
their neighbours (trigrams with word edges, hashed into a table of fixed size). A Viterbi pass over the
words, paying ``PENALTY`` per change of language, labels spans; the language with most letters is the
document's, and its share of the letters the score.

Learning counts trigrams per language in the tasks and adds them up in Spark. It reads at most about
``FIT_ROWS`` labelled documents, chosen by a hash of doc_id; the table has ``1 << BINS`` rows and a column
for each language, whatever the size of the corpus, so that it can be sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlark.llm.common import U64, code_points, id_and_text, mix, pieces, read_table

BINS = 18
FIT_ROWS = 50_000
PENALTY = 14.0
SMOOTHING = 0.5
#: A language is written in a script that has this share of its words.
SCRIPT_SHARE = 0.02
# First code points of the scripts that are told apart, in Unicode's order.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB50, "arabic"), (0xFE70, "arabic"), (0xFF00, "other"), (0x20000, "han"),
]
NAMES = sorted({name for _, name in SCRIPTS})


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its lower case, or 0 if it is no letter; and its script."""
    lower = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            small = c.lower()
            lower[i] = ord(small) if len(small) == 1 else i
    script = np.zeros(0x110000, np.uint8)
    for first, name in SCRIPTS:
        script[first:] = NAMES.index(name)
    return lower, script


class Words:
    """Words of a piece of text, and the hashed trigram around each of their letters."""

    def __init__(self, flat: np.ndarray, at: np.ndarray, bins: int):
        chars, self.at = code_points(flat, at)
        lower, script = _tables()
        c = lower[chars]
        letter = c > 0
        first = letter.copy()
        first[1:] &= ~letter[:-1]
        edge = self.at[1:-1][self.at[1:-1] < len(c)]
        first[edge] = letter[edge]
        self.letters = np.flatnonzero(letter)
        is_first = first[self.letters]
        self.opens = np.flatnonzero(is_first)  # of each word, among the letters
        self.starts = self.letters[self.opens]
        self.sizes = np.diff(np.r_[self.opens, len(self.letters)])
        self.ends = self.starts + self.sizes
        self.rows = np.searchsorted(self.at, self.starts, side="right") - 1
        self.scripts = script[chars[self.starts]]
        own = c[self.letters].astype(U64)
        before = np.r_[U64(0), own[:-1]] if len(own) else own
        before[is_first] = 0
        after = np.r_[own[1:], U64(0)] if len(own) else own.copy()
        after[np.r_[self.opens[1:] - 1, len(own) - 1] if len(own) else []] = 0
        self.bins = (mix((before << U64(42)) | (own << U64(21)) | after) >> U64(64 - bins)).astype(np.int64)


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS, bins: int = BINS) -> dict:
    """Languages, their trigram table, and the scripts each is written in.

    Learns from rows with text, lang and doc_id that are not held out. Without any, no language is known.
    """
    seen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    seen = seen.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out())
    n = seen.select("doc_id").count()
    if n > fit_rows:
        share = int(fit_rows / n * (1 << 30))
        seen = seen.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for part, flat, at in pieces(batches):
            words = Words(flat, at, bins)
            langs = np.asarray(part["lang"].to_pylist(), dtype=object)
            of = langs[words.rows]
            by_letter = np.repeat(np.arange(len(of)), words.sizes)
            for lang in set(of):
                counts = total.setdefault(lang, np.zeros((1 << bins) + len(NAMES), np.int64))
                own = of == lang
                counts[: 1 << bins] += np.bincount(words.bins[own[by_letter]], minlength=1 << bins)
                counts[1 << bins :] += np.bincount(words.scripts[own], minlength=len(NAMES))
        for lang, counts in total.items():
            cells = np.flatnonzero(counts)
            for a in range(0, len(cells), 10_000):
                some = cells[a : a + 10_000]
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(some), "cell": pa.array(some, pa.int32()), "n": pa.array(counts[some])})

    counts = seen.select("text", "lang").mapInArrow(counted, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    table = counts.toArrow()
    langs = sorted(set(table["lang"].to_pylist()))
    dense = np.zeros((len(langs), (1 << bins) + len(NAMES)))
    if langs:
        which = np.asarray([langs.index(x) for x in table["lang"].to_pylist()])
        dense[which, table["cell"].to_numpy()] = table["n"].to_numpy()
    grams, scripts = dense[:, : 1 << bins], dense[:, 1 << bins :]
    scores = np.log(grams + SMOOTHING) - np.log(grams.sum(axis=1, keepdims=True) + SMOOTHING * (1 << bins))
    written = scripts >= SCRIPT_SHARE * scripts.sum(axis=1, keepdims=True)
    return {"langs": langs, "bins": bins, "scores": np.ascontiguousarray(scores.T, dtype=np.float32), "written": written & (scripts > 0)}


def best_paths(scores: np.ndarray, opens: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """Viterbi: for each document the labels with the largest sum of scores less penalties for changes.

    All documents take a step at a time, longest first, so that those still running stand in front.
    """
    k = scores.shape[1]
    order = np.argsort(-sizes, kind="stable")
    opens, sizes = opens[order], sizes[order]
    longest = int(sizes[0])
    running = np.searchsorted(-sizes, -np.arange(longest), side="left")  # with more than i words
    back = np.zeros(scores.shape, np.int16)
    now, stay = scores[opens].astype(np.float64), np.arange(k)
    for i in range(1, longest):
        live = running[i]
        at, here = opens[:live] + i, now[:live]
        top = here.argmax(axis=1)
        moved = here[np.arange(live), top][:, None] - penalty
        move = moved > here
        back[at] = np.where(move, top[:, None], stay)
        now[:live] = np.where(move, moved, here) + scores[at]
    out = np.zeros(len(scores), np.int32)
    label = now.argmax(axis=1)
    for i in range(longest - 1, 0, -1):
        live = running[i]
        at = opens[:live] + i
        out[at] = label[:live]
        label[:live] = back[at, label[:live]]
    out[opens] = label
    return out


def labels(scores: np.ndarray, opens: np.ndarray, penalty: float) -> np.ndarray:
    """A label for each word; ``opens``: the first word of each document.

    Most documents are in one language. If no stretch of words gains more than half a penalty by any other
    language than the document's best, no path with changes can be better: it has at least as many
    changes as stretches, or one fewer if it has no word of the best language, and then two stretches or
    more. Only the others take the Viterbi pass.
    """
    n = len(scores)
    sums = np.add.reduceat(scores, opens, axis=0)
    best = np.argmax(sums, axis=1)
    sizes = np.diff(np.r_[opens, n])
    out = np.repeat(best, sizes).astype(np.int32)
    gain = scores - scores[np.arange(n), out][:, None]
    run = np.cumsum(gain, axis=0, dtype=np.float64)
    before = run - gain
    # lowest sum so far within the document: documents are pushed apart, later ones lower
    span = float(np.abs(run).max(initial=0.0)) * 2 + 1
    shift = np.repeat(np.arange(len(opens)) * span, sizes)[:, None]
    low = np.minimum.accumulate(before - shift, axis=0) + shift
    most = np.maximum.reduceat((run - low).max(axis=1), opens)
    mixed = np.flatnonzero(most > penalty / 2)
    if len(mixed):
        words = np.isin(np.repeat(np.arange(len(opens)), sizes), mixed)
        own = sizes[mixed]
        out[words] = best_paths(scores[words], np.cumsum(own) - own, own, penalty)
    return out


def predictions(flat: np.ndarray, at: np.ndarray, m: dict, penalty: float, with_spans: bool = True) -> tuple[np.ndarray, np.ndarray, list[list[dict]]]:
    """Language, score and, if wanted, spans of each text of a piece."""
    langs, n = m["langs"], len(at) - 1
    words = Words(flat, at, m["bins"])
    pred, score = np.full(n, "und", dtype=object), np.zeros(n)
    spans: list[list[dict]] = [[] for _ in range(n)]
    if not langs or not len(words.starts):
        return pred, score, spans
    scores = np.add.reduceat(m["scores"][words.bins], words.opens, axis=0)
    allowed = m["written"][:, words.scripts].T
    known = allowed.any(axis=1)
    worst = scores.min(axis=1, keepdims=True) - 50
    scores = np.where(allowed, scores, worst)
    scores[~known] = 0
    scores -= scores.max(axis=1, keepdims=True)
    opens = np.flatnonzero(np.r_[True, words.rows[1:] != words.rows[:-1]])
    label = labels(scores, opens, penalty)
    own = words.rows[opens]
    size, letters = np.zeros((n, len(langs))), np.zeros(n)
    np.add.at(size, (words.rows, label), words.sizes * known)
    np.add.at(letters, words.rows, words.sizes)
    top = size.argmax(axis=1)
    pred[own] = np.asarray(langs, dtype=object)[top[own]]
    score[own] = size[own, top[own]] / letters[own]
    if not with_spans:
        return pred, score, spans
    cut = np.flatnonzero(np.r_[True, (words.rows[1:] != words.rows[:-1]) | (label[1:] != label[:-1])])
    last = np.r_[cut[1:] - 1, len(label) - 1]
    base = words.at[words.rows[cut]]
    for r, s, e, k in zip(words.rows[cut].tolist(), (words.starts[cut] - base).tolist(), (words.ends[last] - base).tolist(), label[cut].tolist(), strict=True):
        spans[r].append({"start": s, "end": e, "lang": langs[k]})
    return pred, score, spans


def predict(docs: DataFrame, model: dict, penalty: float = PENALTY) -> DataFrame:
    """``doc_id, lang_pred, score, spans`` of each row; spans hold character start, end and lang.

    Null texts and those without a letter are ``und`` with score 0 and no span. Words in a script that
    no learned language is written in score nothing; a text of such words only has the first learned language
    and score 0. Without a learned language all is ``und``. Spans of one language that touch are one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, flat, at in pieces(batches):
            pred, score, spans = predictions(flat, at, sent.value, penalty)
            yield pa.RecordBatch.from_arrays([
                part["doc_id"], pa.array(pred, pa.string()), pa.array(score),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))),
            ], names=["doc_id", "lang_pred", "score", "spans"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")


def accepted(docs: DataFrame, model: dict, least: float = 0.5, penalty: float = PENALTY) -> DataFrame:
    """The rows, with all their columns, whose language is known with at least this score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, flat, at in pieces(batches):
            pred, score, _ = predictions(flat, at, sent.value, penalty, with_spans=False)
            yield part.filter(pa.array((pred != "und") & (score >= least)))

    return docs.mapInArrow(run, docs.schema)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = predict(docs, fit(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))

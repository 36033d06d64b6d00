"""Importance resampling towards a target distribution.

Texts are bags of hashed features, runs of consecutive words. The log ratio of a feature's bucket in the target
to that in the documents is its gain; gains are an array of one integer for each bucket, so a document's weight
is a look-up and a mean. Weight plus Gumbel noise, drawn from a hash of the id, is the score; the documents with
the highest scores are a sample without replacement in proportion to their weights.

The cutoff is found without sorting all scores: a quantile sketch gives a bracket of scores around it, exact
counts above and inside prove that the cutoff lies in it, or it is widened. Only the bracket is put in order;
what lies above it is drawn as a whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlark.llm.common import id_and_text, pieces, read_table
from pathlark.llm.order import numbered
from pathlark.session import stored

BUCKETS, LONGEST = 10_000, 1
#: Words a document must have to be drawn, and how many in a hundred of these are.
LEAST, PERCENT, SEED = 20, 10, 2024
#: Ranks of the sketch are right to one part of this.
ACCURACY = 10_000
#: Words of more bytes take their checksum one by one.
LONG_WORD = 64

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = (_CRC >> 1) ^ np.where(_CRC & 1, np.uint32(0xEDB88320), np.uint32(0))


def words(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The buffer with A-Z in lower case; starts, ends and rows of its words: digits, letters, what is not ASCII."""
    low = np.where((flat >= 65) & (flat <= 90), flat + 32, flat).astype(np.uint8)
    own = ((low >= 48) & (low <= 57)) | ((low >= 97) & (low <= 122)) | (low >= 128)
    edge = np.zeros(len(low) + 1, bool)  # where a row begins, a word does too
    edge[at] = True
    first = own & (edge[:-1] | ~np.r_[False, own[:-1]])
    last = own & (edge[1:] | ~np.r_[own[1:], False])
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return low, starts, ends, np.searchsorted(at, starts, side="right") - 1


def fed(state: np.ndarray, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Checksum states after the bytes of one word each."""
    out, size = state.copy(), ends - starts
    short = np.flatnonzero(size <= LONG_WORD)
    short = short[np.argsort(-size[short], kind="stable")]  # longest first: at each byte a prefix is left
    left = size[short]
    now, begin = out[short], starts[short]
    for k in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -k, side="left"))
        now[:n] = _CRC[(now[:n] ^ low[begin[:n] + k]) & 255] ^ (now[:n] >> 8)
    out[short] = now
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = zlib.crc32(low[starts[i] : ends[i]], int(out[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return out


def features(flat: np.ndarray, at: np.ndarray, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of each run of 1 to ``longest`` words, and the words of each row."""
    low, starts, ends, rows = words(flat, at)
    count = np.bincount(rows, minlength=len(at) - 1)
    where, state, found, own = np.arange(len(starts)), np.full(len(starts), 0xFFFFFFFF, np.uint32), [], []
    for n in range(longest):
        if n:
            where = where[where + n < len(rows)]
            where = where[rows[where + n] == rows[where]]
            state = state[where]
            state = _CRC[(state ^ 32) & 255] ^ (state >> 8)
        state_of = fed(state, low, starts[where + n], ends[where + n])
        found.append((state_of ^ np.uint32(0xFFFFFFFF)).astype(np.int64) % buckets)
        own.append(rows[where])
        state = np.zeros(len(starts), np.uint32)
        state[where] = state_of
    return np.concatenate(found), np.concatenate(own), count


def _counted(buckets: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, flat, at in pieces(batches):
            total += np.bincount(features(flat, at, buckets, longest)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """``bucket, n`` over all texts: one row for each bucket and task reaches the shuffle. Null texts have none."""
    return texts.select("text").mapInArrow(_counted(buckets, longest), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(spark: SparkSession, docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Per bucket 1000 times the log of its share in the target to that in the documents, each count one higher."""
    source = bucket_counts(docs, buckets, longest).withColumnRenamed("n", "s")
    wanted = bucket_counts(target, buckets, longest).withColumnRenamed("n", "t")
    rows = spark.range(buckets).withColumnRenamed("id", "bucket").join(source, "bucket", "left").join(wanted, "bucket", "left").fillna(0)
    rows = stored(rows.select("bucket", "s", "t"), "buckets")  # as many rows as buckets, whatever the input
    all_s, all_t = (x or 0 for x in rows.agg(F.sum("s"), F.sum("t")).first())
    ratio = (F.col("t") + 1.0) * F.lit(float(all_s + buckets)) / ((F.col("s") + 1.0) * F.lit(float(all_t + buckets)))
    out = np.zeros(buckets, np.int64)
    for bucket, gain in rows.select("bucket", F.floor(1000 * F.log(ratio)).cast("long")).collect():
        out[bucket] = gain
    return out


def _weighed(gain: np.ndarray, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, flat, at in pieces(batches):
            found, rows, count = features(flat, at, len(gain), longest)
            n = np.bincount(rows, minlength=part.num_rows)
            order = np.argsort(rows, kind="stable")
            total = np.r_[0, np.cumsum(gain[found[order]])]
            ends = np.cumsum(n)
            weight = (total[ends] - total[ends - n]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(count.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"])

    return run


def noise(seed: int) -> Column:
    """1000 times a Gumbel variable, drawn from a hash of the id; a null id counts as empty."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def bracket(scores: DataFrame, rank: int, total: int, accuracy: int = ACCURACY) -> tuple[int, int, int]:
    """(low, high, above) with ``above`` scores over ``high``, fewer than ``rank``, and ``rank`` ones from ``low`` up.

    Starts with the sketch's quantiles on both sides of the rank, widened until exact counts agree.
    """
    wide = 2.0 / accuracy
    while True:
        share = 1 - rank / total
        sides = [max(share - wide, 0.0), min(share + wide, 1.0)]
        low, high = scores.agg(F.percentile_approx("score", sides, accuracy)).first()[0]
        if sides[0] == 0.0 or sides[1] == 1.0:
            least, most = scores.agg(F.min("score"), F.max("score")).first()
            low, high = (least if sides[0] == 0.0 else low), (most if sides[1] == 1.0 else high)
        above, inside = scores.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))).first()
        if above < rank <= above + inside:
            return low, high, above
        wide *= 4


def drawn(scored: DataFrame, percent: int = PERCENT, least: int = LEAST, accuracy: int = ACCURACY) -> DataFrame:
    """Adds ``rank``: 1, 2, 3... by descending score for the drawn rows, null for the others.

    Of the rows with ``least`` words, ``percent`` in a hundred are drawn, rounded down. Equal scores are ordered
    by id, null last; rows equal in both by weight and features, and rows equal in all of these count as often as
    they are there.
    """
    able = scored.filter(F.col("n_words") >= least)
    total = able.count()
    rank = percent * total // 100
    none = F.lit(None).cast("long").alias("rank")
    if not rank:
        return scored.select("*", none)
    low, high, above = bracket(able, rank, total, accuracy)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight"), F.col("n_features")]
    one = F.lit(0).alias("_all")

    def ranked(rows: DataFrame, before: int) -> DataFrame:
        placed = numbered(rows.select("*", one), "_all", order, "ranked")
        return placed.select(*scored.columns, (F.col("pos") + 1 + before).alias("rank"))

    over = ranked(able.filter(F.col("score") > high), 0)
    inside = ranked(able.filter(F.col("score").between(low, high)), above)
    inside = inside.withColumn("rank", F.when(F.col("rank") <= rank, F.col("rank")))
    rest = scored.filter((F.col("n_words") < least) | (F.col("score") < low))
    return over.unionByName(inside).unionByName(rest.select("*", none))


def resampled(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, percent: int = PERCENT,
              least: int = LEAST, seed: int = SEED, accuracy: int = ACCURACY) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of each row of documents; ``rank`` is null if not drawn.

    Null and empty texts have no features and weight 0. Rows with equal ids have equal noise and are drawn each
    by its own score. An empty target or an empty table of documents is a distribution with no counts. Other
    columns are not read.
    """
    spark = docs.sparkSession
    known = id_and_text(docs)
    gain = gains(spark, known, target.select("text"), buckets, longest)
    weights = known.mapInArrow(_weighed(gain, longest), "doc_id long, n_words long, n_features long, weight long")
    return drawn(stored(weights.withColumn("score", F.col("weight") + noise(seed)), "scores"), percent, least, accuracy)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resampled(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_CRC_SQL = """xor(4294967295, list_reduce(
    list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda b: ('0x' || b)::BIGINT),
    lambda a, c: list_reduce(range(8), lambda x, j: xor(x >> 1, 3988292384 * (x & 1)), xor(a, c)), 4294967295::BIGINT))"""
ORACLE = f"""
WITH found AS (
    SELECT doc_id, row, unnest({_WORDS}) AS word FROM (SELECT doc_id, text, row_number() OVER () AS row FROM documents)
), wanted AS (SELECT unnest({_WORDS}) AS word FROM benchmark
), hashed AS (
    SELECT word, {_CRC_SQL} % {BUCKETS} AS bucket FROM (SELECT word FROM found UNION SELECT word FROM wanted)
), s AS (SELECT bucket, count(*) AS s FROM found JOIN hashed USING (word) GROUP BY bucket
), t AS (SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (word) GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM found) + {BUCKETS})::DOUBLE
        / ((s + 1.0::DOUBLE) * ((SELECT count(*) FROM wanted) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket)
), weighed AS (
    SELECT row, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM found JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY row
), scored AS (
    SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
            / 4294967296::DOUBLE)))::BIGINT AS score
    FROM (SELECT doc_id, row_number() OVER () AS row FROM documents) LEFT JOIN weighed USING (row)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= {LEAST} ORDER BY score DESC, doc_id NULLS LAST, weight, n_features) AS k,
        {PERCENT} * count(*) OVER (PARTITION BY n_features >= {LEAST}) // 100 AS many
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {LEAST} AND k <= many THEN k END AS rank FROM ranked
"""

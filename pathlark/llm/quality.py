"""Quality rules by distribution divergence, in DataFrame expressions only.

Base counts (words, symbols, repeated lines, words in repeated five-word windows) come from array
expressions within a row. The method then compares two histograms of a document, character classes and
common words, with those of each language's documents, by Jensen-Shannon distance (base 2, 0 to 1). A document
is rejected if it is far from *every* language in either histogram, and only where it is long enough to
tell (``MIN_WORDS`` words). Words off a language's list are one bin of both word histograms, so a long text
without any common word is as far from a language as can be (about 0.33 for lists that a fifth of the words are on).

References are sums over all documents with a lang that has a list of common words here, so there are at
most as many as lists; they enter the plan as literals. The counts per document are stored once and read
for both the references and the verdicts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlark.llm.common import read_table
from pathlark.session import stored

MIN_WORDS = 50
MAX_CLASS_DISTANCE = 0.30
#: Between the farthest labelled good text of the test tables (0.313) and texts without common words (0.331).
MAX_WORD_DISTANCE = 0.32
WINDOW = 5
CLASSES = ["upper", "lower", "digit", "space", "mark", "other"]
# Frequent words of each language, in alphabetical order.
COMMON = {
    "de": "auf das dem den der des die ein eine für im in ist mit nicht sich und von zu".split(),
    "en": "a and as at by for from in is it of on or that the this to was with".split(),
    "es": "con de del el en es la las lo los no para por que se su un una y".split(),
    "fr": "dans de des du elle en est et il la le les ne pas pour que qui un une".split(),
}
WORDS = sorted({w for own in COMMON.values() for w in own})


def features(docs: DataFrame) -> DataFrame:
    """Counts of each row: base counts, character classes, and the common words with their counts."""
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select(
        "doc_id", "lang", F.length("text").alias("chars"),
        F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("words"),
        F.expr(r"filter(split(text, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')").alias("lines"),
    )
    rows = rows.select(
        "doc_id", "lang", "chars", "words", F.array_join("words", "").alias("joined"), F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
        F.array_sort(F.filter(F.transform("words", F.lower), lambda w: w.isin(WORDS))).alias("common"),
    )
    window = ", ".join(f"get(h, i + {k})" for k in range(1, WINDOW))
    rows = rows.select(
        "doc_id", "lang", "n_words", "n_dup_lines", "common",
        F.length("joined").cast("long").alias("word_chars"),
        (F.length("joined") - F.length(F.translate("joined", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("joined", r"[^\p{Lu}]+", "")).alias("upper"),
        F.length(F.regexp_replace("joined", r"\P{L}+", "")).alias("letters"),
        F.length(F.regexp_replace("joined", r"[^0-9]+", "")).alias("digit"),
        F.length(F.regexp_replace("joined", r"""[^.,;:!?'"()-]+""", "")).alias("mark"),
        (F.col("chars") - F.length("joined")).alias("space"),
        F.expr(f"slice(transform(h, (x, i) -> xxhash64(x, {window})), 1, greatest(size(h) - {WINDOW - 1}, 0))").alias("g"),
        F.array_distinct("common").alias("kinds"),
    )
    # windows in order of their hash, each with its place; one that equals a neighbour is repeated
    rows = rows.withColumn("s", F.when(
        F.size(F.array_distinct("g")) < F.size("g"), F.array_sort(F.transform("g", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    rows = rows.withColumn("p", F.expr(
        "array_sort(transform(filter(transform(s, (z, j) -> struct(z.i as i, z.x = get(s, j + 1).x OR (j > 0 AND z.x = get(s, j - 1).x) as twice)),"
        " z -> z.twice), z -> z.i))"))
    rows = rows.withColumn("first", F.transform("kinds", lambda w: F.array_position("common", w)))
    return rows.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(F.expr(
            f"aggregate(zip_with(slice(p, 2, size(p)), slice(p, 1, size(p) - 1), (b, a) -> least(b - a, {WINDOW})), 0L, (n, d) -> n + d) + {WINDOW}L"),
            F.lit(0).cast("long")).alias("n_repeat_words"),
        F.array(*(F.col(c).cast("double") for c in ("upper",)), (F.col("letters") - F.col("upper")).cast("double"), F.col("digit").cast("double"),
                F.col("space").cast("double"), F.col("mark").cast("double"),
                (F.col("word_chars") - F.col("letters") - F.col("digit") - F.col("mark")).cast("double")).alias("classes"),
        F.zip_with("kinds", F.expr("zip_with(first, concat(slice(first, 2, size(first)), array(size(common) + 1L)), (a, b) -> b - a)"),
                   lambda w, n: F.struct(w.alias("word"), n.cast("double").alias("n"))).alias("common"),
    )


def references(rows: DataFrame) -> dict[str, tuple[list[float], dict[str, float]]]:
    """Per language with documents: shares of the character classes, and of its common words among all words."""
    known = rows.filter(F.col("lang").isin(list(COMMON)))
    sums = known.groupBy("lang").agg(F.sum("n_words").alias("n_words"), *(F.sum(F.col("classes")[i]).alias(c) for i, c in enumerate(CLASSES)))
    words = known.select("lang", F.explode("common").alias("c")).groupBy("lang", "c.word").agg(F.sum("c.n").alias("n"))
    out: dict[str, tuple[list[float], dict[str, float]]] = {}
    total = {}
    for r in sums.collect():  # at most a row per list
        total[r["lang"]] = r["n_words"]
        counts = [r[c] for c in CLASSES]
        if sum(counts):
            out[r["lang"]] = ([c / sum(counts) for c in counts], {})
    for r in words.orderBy("lang", "word").collect():  # at most a row per word of the lists and language
        if r["lang"] in out and r["word"] in COMMON[r["lang"]]:
            out[r["lang"]][1][r["word"]] = r["n"] / total[r["lang"]]
    return dict(sorted(out.items()))


def _half(x: Column, y: Column) -> Column:
    """Half of x * log2(x / middle)."""
    return F.when(x > 0, x * F.log2(x * 2 / (x + y)) / 2).otherwise(F.lit(0.0))


def class_distance(classes: Column, reference: list[float]) -> Column:
    total = F.aggregate(classes, F.lit(0.0), lambda n, x: n + x)
    parts = F.lit(0.0)
    for i, q in enumerate(reference):
        p = classes[i] / total
        parts = parts + _half(p, F.lit(q)) + _half(F.lit(q), p)
    return F.when(total > 0, F.sqrt(F.greatest(parts, F.lit(0.0))))


def with_word_distances(rows: DataFrame, known: dict[str, tuple[list[float], dict[str, float]]]) -> tuple[DataFrame, list[Column]]:
    """Per reference the distance over its list's words and a bin for all others; null without words.

    A word that the document lacks adds half its share of the reference. The document's words of a list are
    a column of their own, so that they are worked out once for a document and not once for each of its words.
    """
    lists = [(f"_own_{k}", words) for k, (_, words) in known.items() if words]
    rows = rows.select("*", *(F.filter("common", lambda c: c["word"].isin(list(w))).alias(own) for own, w in lists))
    out = []
    for own, words in lists:
        listed = sum(words.values())
        shares = F.create_map(*(F.lit(x) for pair in sorted(words.items()) for x in pair))
        pairs = F.transform(own, lambda c: F.struct((c["n"] / F.col("n_words")).alias("p"), F.element_at(shares, c["word"]).alias("q")))
        start = F.struct(F.lit(listed / 2).alias("s"), F.lit(0.0).alias("p"))
        sums = F.aggregate(pairs, start, lambda a, c: F.struct(
            (a["s"] + _half(c["p"], c["q"]) + _half(c["q"], c["p"]) - c["q"] / 2).alias("s"), (a["p"] + c["p"]).alias("p")))
        other, rest = F.greatest(F.lit(0.0), 1 - F.col(f"{own}_sums")["p"]), F.lit(max(0.0, 1 - listed))
        rows = rows.withColumn(f"{own}_sums", sums)
        parts = F.col(f"{own}_sums")["s"] + _half(other, rest) + _half(rest, other)
        out.append(F.when(F.col("n_words") > 0, F.sqrt(F.greatest(parts, F.lit(0.0)))))
    return rows, out


def judge(docs: DataFrame) -> DataFrame:
    """Base counts of each row, ``base_failed``, both least distances, and ``kept``.

    Null texts have no words. Without any reference, or below the guards, the base rules alone decide. Repeated
    rows and null ids are judged like any others. Other columns than doc_id, text and lang are not read.
    """
    rows = stored(features(docs), "features")
    known = references(rows)
    nothing = F.lit(None).cast("double")
    by_class = [class_distance(F.col("classes"), c) for c, _ in known.values()]
    rows, by_word = with_word_distances(rows, known)
    rows = rows.withColumn("class_distance", F.least(*by_class, F.lit(2.0)) if by_class else nothing)
    rows = rows.withColumn("word_distance", F.least(*by_word, F.lit(2.0)) if by_word else nothing)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    far = (F.col("n_words") >= MIN_WORDS) & (
        F.coalesce(F.col("class_distance") > MAX_CLASS_DISTANCE, F.lit(False))
        | F.coalesce(F.col("word_distance") > MAX_WORD_DISTANCE, F.lit(False)))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~far).alias("kept"),
        "class_distance", "word_distance")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def _list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


ORACLE = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w, generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS i FROM t),
g AS (SELECT r, i, concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS g, lead(w, 4) OVER o AS last
  FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g WHERE last IS NOT NULL) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM t)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
words AS (SELECT r, count(*) AS n, sum(length(w)) AS chars, sum(length(regexp_replace(w, '[^#*$%&|<>]', '', 'g'))) AS symbols,
  sum(length(regexp_replace(w, '[^\p{{Lu}}]', '', 'g'))) AS upper, sum(length(regexp_replace(w, '[^\p{{L}}]', '', 'g'))) AS letters,
  sum(length(regexp_replace(w, '[^0-9]', '', 'g'))) AS digit, sum(length(regexp_replace(w, '[^.,;:!?''"()-]', '', 'g'))) AS mark FROM w GROUP BY r),
classes AS (SELECT t.r, lang, unnest({CLASSES}) AS c, unnest([coalesce(upper, 0), coalesce(letters - upper, 0), coalesce(digit, 0), length(text) - coalesce(chars, 0),
  coalesce(mark, 0), coalesce(chars - letters - digit - mark, 0)])::DOUBLE AS n FROM t LEFT JOIN words USING (r)),
listed AS ({" UNION ALL ".join(f"SELECT '{k}' AS l, unnest([{_list(v)}]) AS w" for k, v in COMMON.items())}),
common AS (SELECT w.r, t.lang, lower(w.w) AS w, count(*)::DOUBLE AS n FROM w JOIN t USING (r) WHERE lower(w.w) IN (SELECT w FROM listed) GROUP BY 1, 2, 3),
class_ref AS (SELECT lang AS l, c, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS q FROM classes WHERE lang IN ({_list(list(COMMON))}) GROUP BY lang, c),
word_total AS (SELECT lang AS l, sum(words.n) AS t FROM t JOIN words USING (r) WHERE lang IN ({_list(list(COMMON))}) GROUP BY lang),
word_ref AS (SELECT l, w, sum(n) / max(word_total.t) AS q FROM common JOIN listed USING (w) JOIN word_total USING (l) WHERE l = lang GROUP BY l, w),
lists AS (SELECT l, sum(q) AS listed, greatest(0, 1 - sum(q)) AS rest FROM word_ref GROUP BY l),
class_share AS (SELECT r, c, n / sum(n) OVER (PARTITION BY r) AS p FROM classes QUALIFY sum(n) OVER (PARTITION BY r) > 0),
class_js AS (SELECT r, l, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) / 2 ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) / 2 ELSE 0 END))) AS d
  FROM class_share JOIN class_ref USING (c) GROUP BY r, l),
word_share AS (SELECT common.r, l, q, common.n / words.n AS p FROM common JOIN word_ref USING (w) JOIN words ON words.r = common.r),
word_sums AS (SELECT r, l, sum(p) AS p, sum(p * log2(2 * p / (p + q)) / 2 + q * log2(2 * q / (p + q)) / 2 - q / 2) AS s FROM word_share GROUP BY r, l),
word_other AS (SELECT words.r, l, listed / 2 + coalesce(s, 0) AS s, greatest(0, 1 - coalesce(p, 0)) AS p, rest AS q
  FROM words CROSS JOIN lists LEFT JOIN word_sums USING (r, l)),
word_js AS (SELECT r, l, sqrt(greatest(0, s + CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) / 2 ELSE 0 END
  + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) / 2 ELSE 0 END)) AS d FROM word_other),
far AS (SELECT t.r, coalesce((SELECT min(d) FROM class_js c WHERE c.r = t.r) > {MAX_CLASS_DISTANCE}, false) AS by_class,
  coalesce((SELECT min(d) FROM word_js j WHERE j.r = t.r) > {MAX_WORD_DISTANCE}, false) AS by_word FROM t),
f AS (SELECT r, doc_id, coalesce(words.n, 0) AS n_words, coalesce(chars, 0) AS word_chars, coalesce(symbols, 0) AS n_symbols,
  coalesce(lines.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM t LEFT JOIN words USING (r) LEFT JOIN lines USING (r) LEFT JOIN covered USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT (n_words >= {MIN_WORDS} AND (by_class OR by_word)) AS kept
FROM f JOIN far USING (r)
"""

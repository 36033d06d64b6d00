"""Small documents with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from pyspark.sql import functions as F

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards quietly boil some green tea near old stone bridges".split()


def prose(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 13
    for i in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + ("" if (x >> 5) % 9 else "."))
        if (x >> 4) % 23 == 0:
            out.append("\n")
    return " ".join(out)


ODD = [None, "", " ", "\n\n", "a", "Ünïcode çà — 日本語 🙂 é x　y", "x" * 5000, "'ll we're I'd\r\n\t\t  \v end  ", "1234567 89 \x00 \x1f z"]


def frame(spark, texts, **extra):
    """Documents of these texts, with columns that clash with names operators use."""
    rows = [(i, t, None if i % 3 else "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("row", "bucket", "block", "key", "start", "part", "ids", "words"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs

"""Documents that are hard to handle, and names that operators might use themselves."""

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = (
    "digest row_no score kind label start end found before after fp size taken target bucket "
    "hash origin _id _label times batch held_out quality toxic"
).split()

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from here today", "en", "a", 10),
    (2, "THE quick brown fox jumps over the lazy dog and runs far away from here today", "en", "a", 10),
    (3, None, "en", None, None),
    (4, "", "de", "b", 0),
    (5, " \t\n\r\x0b\x0c", "de", "b", 6),
    (6, "wort " * 5000, "de", "a", 25000),
    (7, "x" * 50000, "fr", "c", 50000),
    (8, "1234 5678 !!! ***", None, "a", 17),
    (8, "1234 5678 !!! ***", None, "a", 17),
    (8, "same id, another text", "en", "a", 21),
    (None, "no id here at all", "en", "a", 17),
    (None, None, None, None, None),
    (9, "mail ann@example.com or +1 (555) 123-4567 now", "en", "d", 40),
    (10, "una frase del español con ñ y 日本語 🙂", "es", "d", 30),
    (-5, "The quick brown fox jumps over the lazy dog and runs far away from here today", "en", "a", 10),
]


def documents(spark, rows=ROWS, clashing=True):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return docs.select("*", *[F.lit("other").alias(c) for c in CLASHING]) if clashing else docs

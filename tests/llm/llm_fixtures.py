"""Frames that the tests of the text operators share."""

from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASHES = ("copy", "h", "hot", "rank", "fp", "key", "part", "place", "count", "text_sha256", "component_id", "block", "pos", "word", "line")


def odd_documents(spark):
    """Nulls, empty and long texts, ties, repeated rows and ids, extra columns with names the operators use."""
    long = " ".join(f"w{k % 5000} the" for k in range(60_000))
    rows = [
        (1, "the same words again and again\nsecond line here\nthird line", "en"), (2, "the same words again and again\nsecond line here\nthird line", "en"),
        (3, None, "en"), (4, "", None), (5, "   \t\n ", "en"), (6, "12 345 !!", "en"), (7, long, "en"), (8, long, None),
        (9, "a", "de"), (9, "a", "de"), (10, "zehn worte in dieser zeile stehen hier ganz ruhig beisammen jetzt", "de"),
        (10, "ten words in this line stand here quite calmly together now", "en"), (None, "no id", "en"), (None, "no id", "en"),
        (None, None, None), (11, "été à la plage  \U0001f600 naïve", "fr"),
    ]
    df = spark.createDataFrame([(i, t, l, "src", len(t or "")) for i, t, l in rows], COLUMNS)
    return df.withColumns({c: F.lit("x") for c in CLASHES})


def no_documents(spark):
    return spark.createDataFrame([], COLUMNS)


def texts_of(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], COLUMNS)

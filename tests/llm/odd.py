"""A documents table with nulls, ties, repeated rows and odd texts."""

from pyspark.sql import SparkSession

LONG = "alpha beta gamma delta epsilon zeta eta theta. " * 4000
ODD_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and then it runs away from all the other dogs in the wood again.", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (4, " \t\n\x0b\x0c\r ", "en", "b", 7),
    (None, "a text without an id", "en", None, 20),
    (5, LONG, "en", "a", len(LONG)),
    (6, "same row", "de", "c", 8), (6, "same row", "de", "c", 8), (6, "same row", "de", "c", 8),
    (7, "same row", "de", "c", 8),
    (8, "ÄÖÜ é 漢字 🙂  nbsp em\x1fsep İ ŉ é", "xx", "ä", 30),
    (9, "line\nline\nline\n\n\nline two", "en", "a", 22),
    (10, "a b c d e f g h " * 3 + "x y z", "en", "a", 50),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_docs(spark: SparkSession, extra: bool = True):
    """The rows above; with further columns whose names could clash."""
    df = spark.createDataFrame(ODD_ROWS, SCHEMA)
    return df.selectExpr("*", "doc_id as k", "text as h", "n_chars as size2", "'x' as word", "array(1) as values") if extra else df


def empty_docs(spark: SparkSession):
    return spark.createDataFrame([], SCHEMA)


def saved(df, folder, name="documents"):
    """The table written as a folder of part files below ``folder``; returns ``folder``."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder

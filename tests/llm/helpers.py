"""Small tables for the operators' tests."""

import zlib

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, score string, `key` int"

LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(30_000))

ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a", 1, None, None, 1),
    (2, None, "en", "a", None, "x", "y", 2),
    (3, "", None, "b", 0, None, None, None),
    (4, " \t\r\n ", "de", None, 5, None, None, 4),
    (5, LONG, "en", "b", 9, None, None, 5),
    (6, "Größe ÄÖÜ naïve 中文 　 Ünïcode", "de", "c", 3, None, None, 6),
    (6, "Größe ÄÖÜ naïve 中文 　 Ünïcode", "de", "c", 3, None, None, 6),      # a repeated row
    (None, "no id here but words enough to count them all as usual", None, None, 1, None, None, None),
    (7, "one", "en", "a", 1, None, None, 7),
    (8, "a a a a a a a a a a a a\na a a\na a a", "en", "c", 1, None, None, 8),
    (9, "#### $$$$ ||| <> %%% &&& *** words", "fr", "c", 1, None, None, 9),
    (10, "<|endoftext|> released under the MIT License. Licensed under CC BY-NC 4.0!", "en", "d", 1, None, None, 10),
]


def odd(spark: SparkSession) -> DataFrame:
    """Nulls, blanks, a long text, a repeated row, extra columns named like the operators' own."""
    return spark.createDataFrame(ODD, SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def crc(doc_id, n: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def words(text: str | None) -> list[bytes]:
    """`[^\\x20\\x09-\\x0D]+` after ASCII lower case."""
    return (text or "").encode().lower().split()


def documents(spark: SparkSession, sf: str = "/root/testdata/sf0.001") -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")

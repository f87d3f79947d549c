"""Inputs and plain versions that the tests compare with."""

import re
import zlib

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Extra columns carry names the operators use inside; all must be ignored.
DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
    + [T.StructField(n, T.StringType()) for n in ("uid", "hash", "length", "part", "q", "score", "place")]
)
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
ODD_TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, PASSAGE), (6, PASSAGE.upper() + "!"), (6, PASSAGE), (None, "no id here"), (None, None),
    (7, "x" * 5000 + " Ünïcödé ßß 日本語 'll <|endoftext|> a  b"), (8, ("again and again we say so. " * 40)), (9, "De De De De De De De De De De De De"),
    (10, "line one\nline one\n\n  \nline two\nline one"), (11, "Licensed under CC BY-NC 4.0.\n" + PASSAGE), (12, "a b c " * 3000 + PASSAGE), (8, ("again and again we say so. " * 40)),
    (-5, "under the MIT License and the apache license, version 2.0"), (13, "!!! ??? ### $$$"), (14, "́combining é \x1c control \u0085 next"),
]


def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows and ids, clashing names."""
    rows = [(i, t, "en" if t and len(t) % 2 else None, "u", "h", "l", "p", "q", "s", "a") for i, t in ODD_TEXTS]
    return spark.createDataFrame(rows, DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def some_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def crc_of_ids(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))

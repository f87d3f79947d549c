"""What the operators share: staged tables, row numbers, bounded look-ups."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of one Arrow batch handed to a Python task, whatever the length of the texts.
BATCH_BYTES = 8 << 20
# A table is broadcast up to this many rows of at most ROW_BYTES; beyond, it is joined by shuffle.
BROADCAST_ROWS = 100_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the cluster's own, or, on a local master only, a new one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        found = spark.sparkContext.getCheckpointDir()
        if not found and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = found.rsplit("/", 1)[0] if found else f"file://{tempfile.mkdtemp(prefix='llm-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """The rows of ``df``, written once (with the writer's ``options``) and read back.

    Later plans read the files: lineage ends here, executors may be lost, and values
    that depend on how rows were dealt out (row numbers, task numbers) stay fixed.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.options(**{"compression": "zstd"} | (options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def python_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of Python tasks by bytes: texts may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def numbered(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """``uid`` and the given columns: one number per row, so that equal or null ids stay apart.

    Numbers hold only within one evaluation; stage the rows before using them twice.
    """
    return docs.select(F.monotonically_increasing_id().alias("uid"), *columns)


def held(docs: DataFrame) -> DataFrame:
    """The documents staged under fixed row numbers: uid, doc_id, text, and the other columns as ``rest``."""
    rest = F.struct(F.lit(0).alias("_"), *[F.col(c) for c in docs.columns if c != "text"]).alias("rest")
    return staged(numbered(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text", rest), "documents")


def without(rows: DataFrame, gone: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``held`` whose uid is not in ``gone``, with the columns the documents came with."""
    kept = rows.join(small(staged(gone.select("uid"), "gone")), "uid", "left_anti")
    return kept.select(*[F.col("text") if c == "text" else F.col("rest")[c].alias(c) for c in columns])


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to have at most ``rows`` rows; else as it is."""
    counted = df.limit(rows + 1).count()
    return F.broadcast(df) if counted <= rows else df


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def key_filter(hashes: DataFrame, bits: int = 24) -> Broadcast:
    """A Bloom filter of a column ``hash`` (64 bits) as at most 2**bits bits, whatever the number of rows.

    Two positions per value.  It only spares rows a shuffle: a join that decides must follow.
    """
    spark = hashes.sparkSession
    size = 1 << bits
    low = F.col("hash").bitwiseAND(F.lit(size - 1))
    high = F.shiftrightunsigned("hash", 32).bitwiseAND(F.lit(size - 1))
    places = hashes.select(F.explode(F.array(low, high)).alias("place")).distinct()
    maps = (
        places.groupBy((F.col("place") / 32768).cast("int").alias("map"))
        .agg(F.bitmap_construct_agg((F.col("place") % 32768).cast("bigint")).alias("bits"))
        .collect()
    )
    buffer = bytearray(size // 8)
    for row in maps:
        buffer[row["map"] * 4096 : row["map"] * 4096 + 4096] = row["bits"]
    return spark.sparkContext.broadcast(bytes(buffer))

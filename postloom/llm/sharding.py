"""Shuffled sharding by a Feistel permutation of global row numbers.

Rows get their number in one fixed order; a keyed permutation of 0..n-1 sends row i to place
p, and p gives shard (p mod shards) and slot (p div shards).  So the shuffle is
reproducible, needs no sort by a random key, and place, shard and slot of any row number
can be computed alone.  Shard counts differ by one at most, slots have no gap.

The network works on a x b cells, the smallest near-square that holds n: one half moves
modulo a, then the other modulo b.  At most sqrt(n) + 1 cells lie beyond n; a row that
lands there walks on until it is inside.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.shared import numbered, small, staged

SHARDS = 8
ROUNDS = 6
SEED = 20240117
# No walk is longer up to 4096 rows (fewer cells lie outside); above, the chance is below 1e-100.
WALK = 64


def cells(n: int) -> tuple[int, int]:
    """a and b with a * b >= n."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def _noise(half: Column, seed: int, number: int) -> Column:
    """32 bits of a keyed hash."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.lit(number), half).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def _turned(left: Column, right: Column, number: int, n: int, seed: int) -> tuple[Column, Column]:
    a, b = cells(n)
    if number % 2:
        return left, (right + _noise(left, seed, number)) % b
    return (left + _noise(right, seed, number)) % a, right


def _pass(cell: Column, n: int, seed: int) -> Column:
    """One pass as one expression; a lambda names each round's halves, so none is copied."""
    a, _ = cells(n)
    halves = F.struct((cell % a).alias("l"), F.call_function("div", cell, F.lit(a)).alias("r"))

    def turn(number: int) -> Callable[[Column], Column]:
        def turned(c: Column) -> Column:
            left, right = _turned(c["l"], c["r"], number, n, seed)
            return F.struct(left.alias("l"), right.alias("r"))

        return turned

    for number in range(ROUNDS):
        halves = F.transform(F.array(halves), turn(number))[0]
    return halves["l"] + halves["r"] * a


def permuted(rows: DataFrame, row: str, place: str, n: int, seed: int = SEED) -> DataFrame:
    """Adds ``place``: the place of row number ``row`` in the shuffle of ``n`` rows."""
    a, _ = cells(n)
    out = rows.withColumns({"_l": F.col(row) % a, "_r": F.call_function("div", F.col(row), F.lit(a))})
    for number in range(ROUNDS):
        left, right = _turned(F.col("_l"), F.col("_r"), number, n, seed)
        out = out.withColumn("_r", right) if number % 2 else out.withColumn("_l", left)
    out = out.withColumn("_x", F.col("_l") + F.col("_r") * a)
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.col("_x"), lambda x, _: F.when(x < n, x).otherwise(_pass(x, n, seed)))
    inside = F.when(F.col("_x") < n, F.col("_x")).otherwise(walk)
    return out.withColumn(place, inside).drop("_l", "_r", "_x")


def row_numbers(rows: DataFrame, keys: list[Column]) -> DataFrame:
    """Adds ``row``: numbers from 0 in the order of ``keys``, without a one-task sort.

    Rows are range-sorted and staged with their task and place in it; only a count per task
    is summed up.
    """
    in_order = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = staged(in_order.withColumns({"part": F.spark_partition_id(), "at": at}), "rows")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    return placed.join(small(offsets), "part").withColumn("row", F.col("before") + F.col("at")).drop("part", "at", "before")


def shuffled_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Shard and slot of every document.

    Needs doc_id and text; other columns are ignored.  Null text counts one byte and has the
    checksum of no bytes.  Rows are numbered by doc_id (nulls first), checksum and size; rows
    equal in these are alike in the result, whichever comes first.  An empty table: no rows.
    Columns: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law is "rows").
    """
    text = F.coalesce("text", F.lit(""))
    rows = numbered(
        docs, F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    counted = row_numbers(rows, [F.col("doc_id").asc_nulls_first(), F.col("text_crc32").asc(), F.col("size").asc(), F.col("uid").asc()])
    n = counted.count()
    placed = permuted(counted, "row", "place", n, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("place") % shards).cast("int").alias("shard"), F.call_function("div", F.col("place"), F.lit(shards)).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

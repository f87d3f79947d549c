"""Per-group work that stays balanced when one group holds much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.session import work_folder


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows of every group.

    The optimizer cuts ``row_number() <= n`` to n rows per group and task before the shuffle
    (``spark.sql.optimizer.windowGroupLimitThreshold`` says up to which n).
    """
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(whole)).filter(F.col("_rn") <= n).drop("_rn")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared folder and read back, for what several plans read."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows of a scan that one task works on in order, on average.
BLOCK_ROWS = 1 << 20
_SAMPLED = 32  # rows looked at for each cut point


def blocks_of(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rows: int | None = None) -> Column | None:
    """The block of each row: a number that never decreases along the keys and ``order`` (ascending); None if no group needs cutting.

    With no group of more than ``rows`` rows, the groups are the tasks.  Cut points come from the data,
    so a block has about ``rows`` rows wherever they lie: a key that holds much of the table, or one
    hour of it, gets as many blocks as it needs.  Two jobs over the narrow columns count the rows of
    each group and sample ``_SAMPLED`` of them per cut point; rows of equal order are never parted.
    Each row finds its block by two short searches, of the leading cut points and of one run of them.
    """
    place = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *[c.alias(f"o{i}") for i, c in enumerate(order)])
    narrow = df.select(place.alias("place"))
    n, largest = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.sum("_n"), F.max("_n")).first()
    if (largest or 0) <= (rows or BLOCK_ROWS):
        return None
    blocks = -(-n // (rows or BLOCK_ROWS))
    fraction = min(1.0, 1.2 * blocks * _SAMPLED / n)
    seen = narrow.sample(fraction, 7).orderBy("place").collect()
    fields = narrow.schema["place"].dataType.fields
    # Distinct, in the order Spark sorts them.
    chosen = list(dict.fromkeys(seen[i * len(seen) // blocks]["place"] for i in range(1, blocks))) if seen else []
    if not chosen:
        return None
    literal = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(c, fields)]) for c in chosen]
    width = max(1, round(len(literal) ** 0.5))
    runs = [literal[i : i + width] for i in range(0, len(literal), width)]
    up_to = lambda cuts: F.size(F.filter(cuts, lambda c: c <= place))
    leading = up_to(F.array(*[r[0] for r in runs]))
    # The run whose first cut point is the last one up to the row; none before the first.
    within = up_to(F.get(F.array(*[F.array(*r) for r in runs]), leading - 1))
    return F.when(leading == 0, 0).otherwise((leading - 1) * width + within)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    block: Column | None,
    *,
    sums: dict[str, Column] | None = None,
    maxes: dict[str, Column] | None = None,
    before: bool = False,
) -> DataFrame:
    """Running sums and maxima per group, or over the whole table without keys: a parallel prefix scan.

    The order is cut into blocks of about equal size (``block`` of ``blocks_of``).  Block totals are
    summed up over the blocks first, a small table; then every block continues from its total on its
    own task.  One window per group would send a hot group to one task; without blocks there
    is nothing to carry.  Rows with blocks are written once, since totals and blocks both read them:
    a scan over scans would else work out the lower ones again for each.  ``before`` leaves out the
    current row.
    """
    sums, maxes = sums or {}, maxes or {}
    until = -1 if before else Window.currentRow
    if block is None:
        frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, until)
        done = {name: F.coalesce(F.sum(value).over(frame), F.lit(0)) for name, value in sums.items()}
        done |= {name: F.max(value).over(frame) for name, value in maxes.items()}
        return df.withColumns(done)
    data = df.withColumn("_block", block)
    data = written(data.withColumns({f"_v_{name}": value for name, value in {**sums, **maxes}.items()}), "blocks")
    totals = data.groupBy(*keys, "_block").agg(
        *[F.sum(f"_v_{name}").alias(f"_t_{name}") for name in sums],
        *[F.max(f"_v_{name}").alias(f"_t_{name}") for name in maxes],
    )
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_block").alias("_k_block"),
        *[F.sum(f"_t_{name}").over(earlier).alias(f"_c_{name}") for name in sums],
        *[F.max(f"_t_{name}").over(earlier).alias(f"_c_{name}") for name in maxes],
    )
    same = F.col("_block") == F.col("_k_block")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    frame = (
        Window.partitionBy(*keys, "_block")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, until)
    )
    out = data.join(carried, same, "left")
    done = {
        name: F.coalesce(F.col(f"_c_{name}"), F.lit(0)) + F.coalesce(F.sum(f"_v_{name}").over(frame), F.lit(0))
        for name in sums
    }
    done |= {
        name: F.greatest(F.col(f"_c_{name}"), F.max(f"_v_{name}").over(frame)) for name in maxes
    }
    return out.withColumns(done).select(*df.columns, *done)

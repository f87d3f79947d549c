"""Tables bucketed by key: joins and aggregates on the key read bucket by bucket, without an exchange.

For upkeep that meets two whole tables on one key (stale rows, orphan marks): both are kept
with the same key and number of buckets, so each task joins a bucket of one with the same
bucket of the other.  Merging single batches is what ``keyed`` tables are for.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from postloom.session import work_folder


def bucketed(df: DataFrame, name: str, *, key: str, buckets: int) -> DataFrame:
    """``df`` written as a table bucketed and sorted by ``key``, and read back.

    The table is in the session's catalog under a name of its own; its files are in the shared folder.
    One shuffle deals the rows to their buckets, so a bucket is one file; a hot key is one bucket's, as
    in any bucketed table (these keys are ids, one row each).
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", work_folder(spark, name)).saveAsTable(table)
    return spark.table(table)

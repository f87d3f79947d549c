"""A keyed table in plain files: bucket folders behind one pointer.

    <path>/data/<version>/bucket=<b>/part-*.parquet
    <path>/versions/<n>.json      key, buckets, schema, the folder of each bucket that has rows,
                                  and the last batch of each stream that was merged

The highest whole version is the table.  A merge writes the touched buckets into a new folder
and then the next version file, which names them and the untouched ones: readers see all of a
merge or nothing, and a bucket that lost its last row is simply not named.  A version is
written under another name first and renamed without overwriting, so it is there whole or
not at all, and of two merges at once one is refused (as far as the file system's rename is
atomic).  A version file that was cut short by other means is passed over.  A merge under a
stream's batch number leaves that number in its version: the same batch is not merged twice.
Where the catalog's tables support row-level merges, ``DataFrame.mergeInto`` does the same.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.sources.tables import merge_changes


@dataclass
class Version:
    number: int
    key: str
    buckets: int
    schema: T.StructType
    folders: dict[int, str]
    batches: dict[str, int] = field(default_factory=dict)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _names(spark: SparkSession, path: str) -> list[str]:
    system, folder = _path(spark, path)
    return [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = [n.removesuffix(".json") for n in _names(spark, f"{path}/versions") if n.endswith(".json")]
    return sorted((int(n) for n in names if n.isdigit()), reverse=True)


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest whole version, or none where no table is."""
    for number in _numbers(spark, path):
        lines = spark.read.text(f"{path}/versions/{number}.json", wholetext=True).head(1)
        try:
            held = json.loads(lines[0][0]) if lines else None
        except json.JSONDecodeError:
            held = None
        if held is not None:
            folders = {int(b): f for b, f in held["folders"].items()}
            return Version(number, held["key"], held["buckets"], T.StructType.fromJson(held["schema"]), folders, held.get("batches", {}))
    return None


def _commit(spark: SparkSession, path: str, version: Version) -> None:
    held = {"key": version.key, "buckets": version.buckets, "schema": version.schema.jsonValue(), "folders": version.folders, "batches": version.batches}
    hadoop = spark._jvm.org.apache.hadoop.fs
    system, draft = _path(spark, f"{path}/versions/.{uuid.uuid4().hex}")
    out = system.create(draft, False)
    out.write(bytearray(json.dumps(held).encode()))
    out.close()
    place = system.makeQualified(hadoop.Path(f"{path}/versions/{version.number}.json"))
    draft = system.makeQualified(draft)
    # A rename that refuses an existing name.
    options = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = getattr(hadoop.Options.Rename, "NONE")
    hadoop.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, place, options)


def merged(spark: SparkSession, path: str, batch: tuple[str, int]) -> bool:
    """Has this batch of a stream, or a later one, been merged."""
    stream, number = batch
    return _there(spark, path).batches.get(stream, -1) >= number


def _nullable(schema: T.StructType) -> T.StructType:
    """What files hold is always nullable."""
    text = schema.json()
    for flag in ("nullable", "containsNull", "valueContainsNull"):
        text = text.replace(f'"{flag}":false', f'"{flag}":true')
    return T.StructType.fromJson(json.loads(text))


def _written(df: DataFrame, path: str, key: str, buckets: int) -> dict[int, str]:
    """Writes rows by bucket into a new folder; the folder of each bucket that got rows.

    Rebalanced by bucket: Spark splits large buckets over several files and tasks, and gathers
    small ones, by their measured size.
    """
    name = uuid.uuid4().hex
    bucketed = df.withColumn("bucket", bucket_of(key, buckets))
    bucketed.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(f"{path}/data/{name}")
    found = [n for n in _names(df.sparkSession, f"{path}/data/{name}") if n.startswith("bucket=")]
    return {int(n.removeprefix("bucket=")): f"data/{name}/{n}" for n in found}


def _checked(df: DataFrame, key: str) -> DataFrame:
    """A row without a key would never be met again: refused."""
    missing = F.raise_error(F.lit(f"null {key} in a keyed table")).cast(df.schema[key].dataType)
    return df.withColumn(key, F.when(F.col(key).isNull(), missing).otherwise(F.col(key)))


def create_table(df: DataFrame, path: str, *, key: str = "job_id", buckets: int) -> None:
    """A new table of rows with distinct keys.

    Choose ``buckets`` so that one is about what a merge may rewrite for one row.
    """
    folders = _written(_checked(df, key), path, key, buckets)
    _commit(df.sparkSession, path, Version(0, key, buckets, _nullable(df.schema), folders))


def _read(spark: SparkSession, path: str, version: Version, only: list[int] | None = None) -> DataFrame:
    folders = [f"{path}/{f}" for b, f in version.folders.items() if only is None or b in set(only)]
    if not folders:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*folders)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The whole table, empty ones included."""
    return _read(spark, path, _there(spark, path))


def _there(spark: SparkSession, path: str) -> Version:
    version = current(spark, path)
    if version is None:
        raise FileNotFoundError(f"no keyed table at {path}")
    return version


def rows_of(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """The table's rows whose key occurs in ``keys``; only their buckets are read."""
    version = _there(spark, path)
    asked = keys.select(version.key).distinct()
    return _read(spark, path, version, _touched(version, asked)).join(asked, version.key, "left_semi")


def _touched(version: Version, keys: DataFrame) -> list[int]:
    """At most ``buckets`` small numbers."""
    return [r.b for r in keys.select(bucket_of(version.key, version.buckets).alias("b")).distinct().collect()]


def upsert_into(path: str, changes: DataFrame, *, delete: DataFrame | None = None, batch: tuple[str, int] | None = None) -> None:
    """Merge rows of distinct keys, after the deletes, into a keyed table; only touched buckets are rewritten.

    Columns the changes lack keep their stored values (null in new rows); columns the table
    lacks are added to it.  Null keys are refused.  ``batch`` is a stream's name and batch number:
    a batch that was merged before is left out.
    """
    spark = changes.sparkSession
    version = _there(spark, path)
    batches = version.batches
    if batch is not None:
        if batches.get(batch[0], -1) >= batch[1]:
            return
        batches = {**batches, batch[0]: batch[1]}
    keys = _checked(changes, version.key).select(version.key)
    if delete is not None:
        keys = keys.unionByName(delete.select(version.key))
    touched = _touched(version, keys.filter(F.col(version.key).isNotNull()) if delete is not None else keys)
    if not touched and batch is None:
        return
    number = _numbers(spark, path)[0] + 1
    if not touched:
        _commit(spark, path, Version(number, version.key, version.buckets, version.schema, version.folders, batches))
        return
    stored = _read(spark, path, version, touched)
    rows = merge_changes(stored, _checked(changes, version.key), version.key, delete)
    fresh = _written(rows, path, version.key, version.buckets)
    kept = {b: f for b, f in version.folders.items() if b not in set(touched)}
    _commit(spark, path, Version(number, version.key, version.buckets, _nullable(rows.schema), {**kept, **fresh}, batches))

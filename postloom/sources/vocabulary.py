"""The skill vocabulary: a role-by-skill grid, flattened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions.text import strip


def read_grid(spark: SparkSession, path: str, columns: int) -> DataFrame:
    """A CSV grid with a header; every cell is text."""
    schema = ", ".join(f"c{i} string" for i in range(columns))
    return spark.read.schema(schema).option("header", True).csv(path)


def skill_vocabulary(grid: DataFrame, row_order: Column) -> DataFrame:
    """(skill, ord): text cells row by row, trimmed, first spelling of each kept.

    The first column of a grid of several columns holds role names and is left out.
    """
    cells = grid.columns[1:] if len(grid.columns) > 1 else grid.columns
    words = [c for c in cells if dict(grid.dtypes)[c] == "string"]
    flat = grid.select(
        row_order.alias("_row"), F.posexplode(F.array(*[strip(F.col(c)) for c in words])).alias("_col", "skill")
    ).filter(F.col("skill") != "")
    place = F.struct("_row", "_col")
    return (
        flat.groupBy(F.lower("skill").alias("_key"))
        .agg(F.min_by("skill", place).alias("skill"), F.min(place).alias("ord"))
        .select("skill", F.col("ord._row").alias("row"), F.col("ord._col").alias("col"))
    )

"""Keep large expressions from being copied into every place that uses them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def staged(
    df: DataFrame, columns: dict[str, Column], keep: Callable[[Column], Column] | None = None
) -> DataFrame:
    """``withColumns`` whose expressions stay where they are.

    A filter or projection above a plain projection takes a copy of what it refers
    to; above a generator it does not.  ``keep`` filters on the new struct of columns.
    """
    row = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(row if keep is None else F.filter(row, keep)))

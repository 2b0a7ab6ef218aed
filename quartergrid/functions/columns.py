"""Column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that are evaluated once per row.

    A filter on an ordinary computed column is pushed below it, and evaluates
    the whole expression again wherever the filter names it. Generated columns
    stop that; what the expressions are made of can still be filtered below.
    """
    row = F.struct(*(c.alias(name) for name, c in columns.items()))
    return df.select("*", F.inline(F.array(row)))

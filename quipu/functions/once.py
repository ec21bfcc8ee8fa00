"""Columns that are computed once per row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_columns_once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Like withColumns for new columns whose expressions are costly.

    A filter on a plain computed column is pushed below its projection as a copy
    of the whole expression; parsing the same JSON again for every predicate is
    slow and makes generated code too large. Columns that come out of a
    generator are read instead of copied.
    """
    fields = F.struct(*[value.alias(name) for name, value in columns.items()])
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in columns]
    return rows.select(*kept, F.inline(F.array(fields)))

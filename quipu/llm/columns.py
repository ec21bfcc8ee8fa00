"""Callers' columns beside an operator's own."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kept_apart(docs: DataFrame, used: list[str], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """operator on the used columns, the caller's other ones carried through under names that clash with nothing.

    Afterwards they have their own names again; where the operator has an output of that name, the caller's column is called
    <name>_before.
    """
    others = [c for c in docs.columns if c not in used]
    inner = {c: f"__caller_{k}" for k, c in enumerate(others)}
    found = operator(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c in used], *[F.col(f"`{c}`").alias(n) for c, n in inner.items()]))
    taken = {c for c in found.columns if c not in inner.values()}
    back = {n: f"{c}_before" if c in taken else c for c, n in inner.items()}
    return found.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in found.columns])

"""Keeps an operator's own column names apart from those of the table that it gets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_aside(docs: DataFrame, used: list[str], added: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """docs with every column but the used ones under a name that no operator uses, and a function that gives the names
    back. Columns named like added ones are left out, for they are replaced."""
    names = {c: f"aside__{i}" for i, c in enumerate(docs.columns) if c not in used and c not in added}
    inner = docs.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in docs.columns if c in used or c in names])

    def back(out: DataFrame) -> DataFrame:
        have = set(out.columns)
        return out.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns if (c in used or c in names) and names.get(c, c) in have], *[c for c in added if c in have])

    return inner, back


def need_whole_ids(docs: DataFrame, id_col: str) -> None:
    """Raises TypeError if the ids are no whole numbers: their order decides what stays, and text has another order."""
    kind = docs.schema[id_col].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long", "void"):
        raise TypeError(f"{id_col} must be a column of whole numbers, not of type {kind}")

"""Top-k selection and the rows it selects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmart.operators.dedup import SortKey


def top_k_keys(df: DataFrame, keys: list[str], where: Column, order: list[SortKey],
               k: int) -> DataFrame:
    """Keys of the first ``k`` rows matching ``where`` by ``order``.

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its own k best rows, so at most (tasks * k) rows meet in the last step.
    Give a unique tie-break in ``order`` for a deterministic answer.
    """
    return df.where(where).orderBy(*[o.to_column() for o in order]).limit(k).select(*keys)


def semi_join(df: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    """``key IN (subquery)``: the planner broadcasts the keys where their size allows it."""
    return df.join(keys_df, on=keys, how="left_semi")

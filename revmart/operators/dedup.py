"""Latest version per key of an append-only log.

The order is a list of :class:`SortKey`, highest priority first, exactly as
``ORDER BY`` in ``row_number() OVER (PARTITION BY keys ORDER BY ...)``; the
first row of each key wins. The null order is always explicit: engines
differ on the default (``DESC`` puts NULLs first in PostgreSQL, last in
Spark).

Two physical forms give the same rows:

* ``window``: ``row_number`` + ``= 1``. Catalyst adds a partial
  WindowGroupLimit before the shuffle, so each map task sends at most one
  row per key: a hot key is collapsed before it reaches its reducer.
* ``aggregate``: ``groupBy(keys).agg(max_by(row, ordering struct))``;
  partial aggregation does the same collapse map-side (all keys must be
  descending).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


@dataclass(frozen=True)
class SortKey:
    column: str
    descending: bool = True
    nulls_first: bool = False

    def to_column(self) -> Column:
        c = F.col(self.column)
        if self.descending:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()


def latest_version(df: DataFrame, keys: list[str], order: list[SortKey],
                   method: str = "window") -> DataFrame:
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*[k.to_column() for k in order])
        return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)
    if method == "aggregate":
        if not all(k.descending for k in order):
            raise ValueError("aggregate form needs descending sort keys")
        return _latest_by_aggregate(df, keys, order)
    raise ValueError(f"unknown method {method!r}")


def order_value(order: list[SortKey], prefix: str = "") -> Column:
    """A struct that is greater for the row that ``order`` (all descending) puts first.

    Struct comparison is ascending with NULL lowest, so for each key a
    boolean flag puts the NULLs on the wanted side, then the value follows.
    ``prefix`` is that of the columns' names.
    """
    fields = []
    for i, key in enumerate(order):
        value = F.col(prefix + key.column)
        fields.append((value.isNull() if key.nulls_first else value.isNotNull()).alias(f"n{i}"))
        fields.append(value.alias(f"v{i}"))
    return F.struct(*fields)


def latest_by_aggregate(df: DataFrame, keys: list[str], order: list[SortKey],
                        *more: Column) -> DataFrame:
    """The aggregate form on its own: also valid as a streaming aggregation, where
    the state store keeps each key's current winner (and ``more`` aggregates of its rows)."""
    if not all(k.descending for k in order):
        raise ValueError("aggregate form needs descending sort keys")
    return _latest_by_aggregate(df, keys, order, *more)


def _latest_by_aggregate(df: DataFrame, keys: list[str], order: list[SortKey],
                         *more: Column) -> DataFrame:
    """``max_by`` over a struct encoding the order."""
    payload = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    out = df.groupBy(*keys).agg(F.max_by(payload, order_value(order)).alias("__row"), *more)
    kept = [c for c in out.columns if c not in keys and c != "__row"]
    return out.select(*keys, "__row.*", *kept).select(*df.columns, *kept)

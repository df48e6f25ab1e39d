"""Keyed upsert and insert-if-absent as DataFrame algebra (anti join + union)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from revmart.operators.dedup import SortKey, latest_version


def keyed_upsert(existing: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """delete+insert: drop every existing row whose key is in ``delta``, add ``delta``.

    ``delta`` must be unique by key. The anti join shuffles ``existing`` on
    the keys only when AQE cannot broadcast the (usually small) delta keys.
    """
    kept = existing.join(delta.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(delta.select(*existing.columns))


def rows_to_insert(existing: DataFrame, incoming: DataFrame, keys: list[str],
                   order: list[SortKey]) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO NOTHING``: the new rows only.

    Incoming duplicates of one key are resolved first (the first row by
    ``order`` wins, standing in for arrival order), then keys already in
    ``existing`` are dropped.
    """
    first = latest_version(incoming, keys, order)
    return first.join(existing.select(*keys), on=keys, how="left_anti").select(*existing.columns)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: list[str],
                     order: list[SortKey]) -> DataFrame:
    """The whole table after the insert (existing rows are never changed)."""
    return existing.unionByName(rows_to_insert(existing, incoming, keys, order))

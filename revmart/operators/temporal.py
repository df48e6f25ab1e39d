"""Point-in-time lookup of SCD2 history with a current-row fallback.

For each fact row: the value of the history row of the same key whose
half-open interval ``[valid_from, valid_to)`` (NULL ``valid_to`` = open)
contains the fact timestamp; if there is none, *or its value is NULL*, the
value of the key's open row; else NULL. With several covering rows (an
overlap, which the data-quality checks flag) the latest ``valid_from`` wins.

The history is collapsed to one row per key, holding its versions as
``array<struct<valid_from, valid_to, value...>>`` and the open row's values,
so one equi left join serves cover and fallback, keeps every fact row and
adds at most one history row to it, overlapping or not. The covering element
is picked with ``filter`` on the array.

The planner and AQE decide by bytes whether the history is broadcast; else
the join shuffles on the keys and AQE splits a hot key's partition on the
fact side. With ``salt_buckets=S`` the shuffle is salted explicitly: fact
rows get a deterministic salt (``xxhash64`` of the row mod S) and each
collapsed history row is replicated S times, so a key holding a third of the
fact rows is spread over S tasks whatever AQE decides. ``broadcast=True``
is for callers that know the history's size.

A key's array holds the changes of one dimension key (at most one per
snapshot run); it does not grow with the facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_lookup(facts: DataFrame, history: DataFrame, on: dict[str, str], ts_col: str,
                    values: dict[str, str], valid_from: str = "valid_from",
                    valid_to: str = "valid_to", broadcast: bool = False,
                    salt_buckets: int | None = None) -> DataFrame:
    """Add ``values`` (history column -> output name) to ``facts``.

    ``on`` maps fact key columns to history key columns.
    """
    hkeys = list(on.values())
    collapsed = collapse_versions(history, hkeys, list(values), valid_from, valid_to)
    aliased = collapsed.select(*[F.col(h).alias(f"__k{i}") for i, h in enumerate(hkeys)],
                               "__versions", "__current")
    eq = [F.col(f) == F.col(f"__k{i}") for i, f in enumerate(on.keys())]
    cond = eq[0]
    for c in eq[1:]:
        cond = cond & c
    salted = bool(salt_buckets) and not broadcast
    if salted:
        facts = facts.withColumn(
            "__salt", F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(salt_buckets)))
        aliased = aliased.withColumn(
            "__dsalt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt_buckets - 1).cast("long"))))
        cond = cond & (F.col("__salt") == F.col("__dsalt"))
    joined = facts.join(F.broadcast(aliased) if broadcast else aliased, cond, "left")
    if salted:
        joined = joined.drop("__salt", "__dsalt")
    ts = F.col(ts_col)
    covering = F.filter("__versions",
                        lambda v: (ts >= v["f"]) & (v["t"].isNull() | (ts < v["t"])))
    joined = joined.withColumn("__cover", F.try_element_at(covering, F.lit(-1)))
    for v, name in values.items():
        joined = joined.withColumn(name, F.coalesce(F.col("__cover")[v], F.col("__current")[v]))
    return joined.drop(*[f"__k{i}" for i in range(len(hkeys))], "__versions", "__current", "__cover")


def collapse_versions(history: DataFrame, keys: list[str], values: list[str],
                      valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """One row per key: versions sorted by ``valid_from`` plus the open row's values."""
    version = F.struct(F.col(valid_from).alias("f"), F.col(valid_to).alias("t"),
                       *[F.col(v).alias(v) for v in values])
    current = F.struct(*[F.col(v).alias(v) for v in values])
    # max_by skips NULL orderings: only open rows compete, latest first.
    open_from = F.when(F.col(valid_to).isNull(), F.col(valid_from))
    return history.groupBy(*keys).agg(
        F.array_sort(F.collect_list(version)).alias("__versions"),
        F.max_by(current, open_from).alias("__current"))

"""Point-in-time lookup by an as-of merge, for histories of any size.

The same rows as ``operators/temporal.interval_lookup``: for each fact row
the value of the version valid at its time, where that is missing or NULL
the value of the key's open version. There the versions of a key are an
array that is joined to every fact row; here facts and versions are put
together, sorted once per key, and the last version carried forward, so
nothing grows with a key's number of versions and nothing is broadcast.

A key that has more than ``hot_share`` of all fact rows (and more than
``hot_rows``) is split at quantiles of its times into up to ``splits`` ranges
that are sorted apart. There are at most 1 / ``hot_share`` such keys, so their
bounds are broadcast and the facts move once, split already. A version goes
to the ranges that it overlaps, the open version to all. Facts with a NULL
key match nothing and are dealt apart. ``facts`` is evaluated once beside the
search for hot keys, which reads ``times`` (same keys and times) where given.

The versions of a key must not overlap (``quality.scd2_checks`` reports
those that do); the job fails where they do, instead of choosing one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hot_bounds(facts: DataFrame, keys: list[str], ts_col: str, hot_rows: int, hot_share: float,
               splits: int) -> DataFrame:
    """(keys, __bounds): the inner bounds of the hot keys' time ranges; at most 1 / ``hot_share`` rows."""
    counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = facts.agg(F.count(F.lit(1))).scalar()
    hot = counts.where(F.col("__n") > F.greatest(F.lit(hot_rows), hot_share * total)).drop("__n")
    shares = [i / splits for i in range(1, splits)]
    return (facts.select(*keys, ts_col).join(F.broadcast(hot), on=keys, how="left_semi")
            .groupBy(*keys).agg(F.array_distinct(F.percentile_approx(ts_col, shares, 20 * splits)).alias("__bounds")))


def _below(bounds: Column, ts: Column, strictly: bool = False) -> Column:
    """How many bounds lie at or before ``ts`` (strictly: before); 0 where either is NULL."""
    n = F.size(F.filter(bounds, lambda b: (b < ts) if strictly else (b <= ts)))
    return F.coalesce(F.when(n >= 0, n), F.lit(0))


def asof_lookup(facts: DataFrame, history: DataFrame, on: dict[str, str], ts_col: str, values: dict[str, str],
                valid_from: str = "valid_from", valid_to: str = "valid_to", hot_rows: int = 1_000_000,
                hot_share: float = 0.001, splits: int = 100, times: DataFrame | None = None) -> DataFrame:
    """Add ``values`` (history column -> output name) to ``facts``; ``on`` maps fact keys to history keys."""
    names = [f"__k{i}" for i in range(len(on))]
    matched = F.lit(True)
    for k in on:
        matched = matched & F.col(k).isNotNull()
    kept = [c for c in facts.columns if c not in values.values()]
    keyed = [*[F.col(k).alias(n) for k, n in zip(on, names)], F.col(ts_col).alias("__t")]
    rows = facts.select(*keyed, matched.alias("__matched"), F.struct(*kept).alias("__row"))
    counted = (facts if times is None else times).where(matched).select(*keyed)
    bounds = F.broadcast(hot_bounds(counted, names, "__t", hot_rows, hot_share, splits))

    version = F.struct(F.col(valid_to).alias("t"), *[F.col(v).alias(v) for v in values])
    versions = (history.where(F.col(valid_from).isNotNull())
                .select(*[F.col(k).alias(n) for k, n in zip(on.values(), names)], F.col(valid_from).alias("__f"),
                        version.alias("__v"))
                .join(bounds, on=names, how="left"))
    first = _below(F.col("__bounds"), F.col("__f"))
    all_parts = F.coalesce(F.when(F.size("__bounds") >= 0, F.size("__bounds")), F.lit(0))
    is_open = F.col("__v.t").isNull()
    first = F.when(is_open, F.lit(0)).otherwise(first)
    last = F.when(is_open, all_parts).otherwise(_below(F.col("__bounds"), F.col("__v.t"), strictly=True))
    no_version = F.lit(None).cast(versions.schema["__v"].dataType)
    no_row = F.lit(None).cast(rows.schema["__row"].dataType)

    def event(part, kind, t, row, carried):
        return [*names, part.alias("__part"), F.lit(kind).alias("__kind"), t.alias("__t"), row.alias("__row"),
                carried.alias("__v")]

    # Of equal times the versions come first. Parts below 0 hold the facts with a NULL key.
    apart = (F.lit(-1) - F.pmod(F.xxhash64("__row"), F.lit(1_000_000))).cast("int")
    part = F.when(F.col("__matched"), _below(F.col("__bounds"), F.col("__t"))).otherwise(apart)
    facts_in = rows.join(bounds, on=names, how="left").select(
        *event(part, 2, F.col("__t"), F.col("__row"), no_version))
    versions_in = versions.select(*event(
        F.explode(F.sequence(first, F.greatest(first, last))), 1, F.col("__f"), no_row, F.col("__v")))
    key = Window.partitionBy(*names, "__part").orderBy(F.col("__t").asc_nulls_first(), "__kind")
    before = key.rowsBetween(Window.unboundedPreceding, -1)
    whole = key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    merged = facts_in.unionByName(versions_in).select(
        "__kind", "__t", "__row", "__v",
        F.last("__v", ignorenulls=True).over(key.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("__cover"),
        F.last(F.when(F.col("__v.t").isNull(), F.col("__v")), ignorenulls=True).over(whole).alias("__current"),
        F.last("__v", ignorenulls=True).over(before).alias("__previous"))
    overlap = ((F.col("__kind") == 1) & F.col("__previous").isNotNull()
               & (F.col("__previous.t").isNull() | (F.col("__previous.t") > F.col("__t"))))
    message = F.lit(f"history has overlapping versions of one {list(on.values())}")
    found = merged.where(F.when(overlap, F.raise_error(message).cast("boolean")).otherwise(F.col("__kind") == 2))
    covered = F.col("__cover.t").isNull() | (F.col("__t") < F.col("__cover.t"))
    return found.select("__row.*", *[
        F.coalesce(F.when(covered, F.col("__cover")[v]), F.col("__current")[v]).alias(name) for v, name in values.items()])

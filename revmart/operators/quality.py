"""Data-quality rules as aggregation jobs.

Each rule yields one row ``(table_name, column_name, rule, failures,
failing_rows)``. ``failures`` counts what a declarative test's query
returns: rows for ``not_null``/``range``/``max_length``, distinct offending
values for ``unique`` and ``accepted_values``. NULLs never fail
``unique`` or ``accepted_values``. All column rules of a table run in one
aggregation pass; ``unique`` is one ``groupBy(key)`` (partial aggregation
before the shuffle, so a hot key costs one row per map task).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RESULT_DDL = ("table_name string, column_name string, rule string, failures bigint, "
              "failing_rows bigint")


@dataclass(frozen=True)
class Rule:
    column: str
    rule: str  # not_null | accepted_values | max_length | range
    values: tuple = field(default_factory=tuple)
    max_length: int | None = None
    low: float | None = None
    high: float | None = None


def _result(table: str, column: str, rule: str, failures, failing_rows):
    return F.struct(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                    F.lit(rule).alias("rule"), failures.cast("bigint").alias("failures"),
                    failing_rows.cast("bigint").alias("failing_rows"))


def _accepted_checks(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """Accepted-values rules: only offending values are grouped, once per rule and value."""
    offending = F.array(*[F.when(F.col(r.column).isNotNull() & ~F.col(r.column).isin(*r.values),
                                 F.struct(F.lit(i).alias("rule"), F.col(r.column).cast("string").alias("value")))
                          for i, r in enumerate(rules)])
    found = (df.select(F.explode(F.filter(offending, lambda x: x.isNotNull())).alias("o"))
             .groupBy("o.rule", "o.value").count())
    counted = found.agg(*[a for i in range(len(rules)) for a in (
        F.count_if(F.col("rule") == i).alias(f"f{i}"),
        F.coalesce(F.sum(F.when(F.col("rule") == i, F.col("count"))), F.lit(0)).alias(f"r{i}"))])
    return counted.select(F.inline(F.array(*[
        _result(table, r.column, r.rule, F.col(f"f{i}"), F.col(f"r{i}")) for i, r in enumerate(rules)])))


def column_checks(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """All column rules of one table in a single aggregation pass (accepted values in one of their own)."""
    accepted = [r for r in rules if r.rule == "accepted_values"]
    if accepted:
        rest = [r for r in rules if r.rule != "accepted_values"]
        out = _accepted_checks(df, table, accepted)
        return out.unionByName(column_checks(df, table, rest)) if rest else out
    aggs = []
    for i, r in enumerate(rules):
        c = F.col(r.column)
        if r.rule == "not_null":
            bad = c.isNull()
            aggs += [F.count_if(bad).alias(f"f{i}"), F.count_if(bad).alias(f"r{i}")]
        elif r.rule == "max_length":
            bad = F.length(c) > r.max_length
            aggs += [F.count_if(bad).alias(f"f{i}"), F.count_if(bad).alias(f"r{i}")]
        elif r.rule == "range":
            bad = c.isNotNull() & ~c.between(r.low, r.high)
            aggs += [F.count_if(bad).alias(f"f{i}"), F.count_if(bad).alias(f"r{i}")]
        else:
            raise ValueError(f"unknown rule {r.rule!r}")
    counted = df.agg(*aggs)
    rows = [_result(table, r.column, r.rule, F.col(f"f{i}"), F.col(f"r{i}"))
            for i, r in enumerate(rules)]
    return counted.select(F.inline(F.array(*rows)))


def unique_check(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Key values (all parts non-NULL) that occur more than once."""
    not_null = None
    for k in keys:
        c = F.col(k).isNotNull()
        not_null = c if not_null is None else not_null & c
    dup = df.where(not_null).groupBy(*keys).count().where(F.col("count") > 1)
    counted = dup.agg(F.count(F.lit(1)).alias("f"), F.coalesce(F.sum("count"), F.lit(0)).alias("r"))
    return counted.select(F.inline(F.array(
        _result(table, ",".join(keys), "unique", F.col("f"), F.col("r")))))


def scd2_checks(history: DataFrame, table: str, keys: list[str], valid_from: str = "valid_from",
                valid_to: str = "valid_to") -> DataFrame:
    """Overlapping intervals and keys with more than one open row.

    An interval overlaps when the key's next version starts before it ends
    (an open interval ends never). Histories are dimension-sized; the window
    is partitioned by key.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(valid_from), F.col(valid_to).asc_nulls_last())
    nxt = F.lead(valid_from).over(w)
    flagged = history.select(*keys, F.col(valid_to).isNull().alias("__open"),
                             (nxt.isNotNull() & (F.col(valid_to).isNull() | (F.col(valid_to) > nxt))
                              ).alias("__overlap"))
    per_key = flagged.groupBy(*keys).agg(F.count_if("__open").alias("open_rows"),
                                         F.count_if("__overlap").alias("overlaps"))
    counted = per_key.agg(
        F.coalesce(F.count_if(F.col("overlaps") > 0), F.lit(0)).alias("kf"),
        F.coalesce(F.sum("overlaps"), F.lit(0)).alias("kr"),
        F.coalesce(F.count_if(F.col("open_rows") > 1), F.lit(0)).alias("of"),
        F.coalesce(F.sum(F.when(F.col("open_rows") > 1, F.col("open_rows"))), F.lit(0)).alias("orr"))
    col = ",".join(keys)
    return counted.select(F.inline(F.array(
        _result(table, col, "scd2_no_overlap", F.col("kf"), F.col("kr")),
        _result(table, col, "scd2_single_open_row", F.col("of"), F.col("orr")))))


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out

"""SCD Type 2 history, check strategy.

One step compares the open history rows with an incoming full snapshot by
key (null-safe on the check columns):

(a) new key              -> new row ``[run_ts, NULL)``
(b) a check column moved -> open row closed at ``run_ts`` + new row
(c) all equal            -> open row untouched
(d) key not in snapshot  -> open row stays open (hard deletes ignored)
(e) closed rows never change.

``history_from_snapshots`` builds the same history set-based from a table
of all snapshots (``lag`` to find changes, ``lead`` to close intervals); the
tests check that replaying ``scd2_step`` equals it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revmart.functions.columns import null_safe_differs


def guard_unique(df: DataFrame, keys: list[str], what: str = "input") -> DataFrame:
    """``df`` unchanged, but the job fails if a key occurs twice.

    Checked inside the same job (``raise_error``), partitioned by the keys:
    a later join on the same keys reuses that partitioning, so the guard
    costs no extra shuffle and no extra action.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    msg = F.lit(f"{what} is not unique on {keys}")
    guarded = df.withColumn("__n", n).where(F.when(F.col("__n") > 1, F.raise_error(msg)).isNull())
    return guarded.drop("__n")


def scd2_step(history: DataFrame, incoming: DataFrame, keys: list[str], check_cols: list[str],
              run_ts: Column, valid_from: str = "valid_from", valid_to: str = "valid_to",
              check_unique: bool = True) -> DataFrame:
    """Apply one snapshot to ``history``; returns the whole new history.

    ``incoming`` must hold ``keys``, ``check_cols`` and any other columns of
    the history (all but the validity columns); it must be unique by key.
    History is read once: a full outer join on the keys whose residual
    condition admits only the open row, so closed rows pass through as
    unmatched left rows and each key emits its old row, its new row or both.
    """
    if check_unique:
        incoming = guard_unique(incoming, keys, "scd2 incoming snapshot")
    data_cols = [c for c in history.columns if c not in (valid_from, valid_to)]
    o = history.select(*[F.col(c).alias(f"o_{c}") for c in data_cols],
                       F.col(valid_from).alias("o__from"), F.col(valid_to).alias("o__to"),
                       F.lit(True).alias("o__present"))
    i = incoming.select(*[F.col(c).alias(f"i_{c}") for c in data_cols],
                        F.lit(True).alias("i__present"))
    cond = F.col("o__to").isNull()
    for k in keys:
        cond = (F.col(f"o_{k}") == F.col(f"i_{k}")) & cond
    j = o.join(i, cond, "full_outer")

    in_old = F.col("o__present").isNotNull()
    in_new = F.col("i__present").isNotNull()
    changed = in_old & in_new & null_safe_differs(
        [F.col(f"o_{c}") for c in check_cols], [F.col(f"i_{c}") for c in check_cols])

    old_row = F.when(in_old, F.struct(
        *[F.col(f"o_{c}").alias(c) for c in data_cols],
        F.col("o__from").alias(valid_from),
        F.when(changed, run_ts).otherwise(F.col("o__to")).alias(valid_to)))
    new_row = F.when((in_new & ~in_old) | changed, F.struct(
        *[F.col(f"i_{c}").alias(c) for c in data_cols],
        run_ts.alias(valid_from),
        F.lit(None).cast(history.schema[valid_to].dataType).alias(valid_to)))
    stepped = j.select(F.inline(F.filter(F.array(old_row, new_row), lambda r: r.isNotNull())))
    return stepped.select(*history.columns)


def history_from_snapshots(snapshots: DataFrame, keys: list[str], check_cols: list[str],
                           run_col: str = "run_ts", valid_from: str = "valid_from",
                           valid_to: str = "valid_to") -> DataFrame:
    """Set-based history from all snapshots at once (one row per key and run).

    A version starts at a key's first appearance and wherever a check
    column differs from the key's previous appearance; absent runs are
    skipped, which is rule (d).
    """
    data_cols = [c for c in snapshots.columns if c != run_col]
    w = Window.partitionBy(*keys).orderBy(run_col)
    prev = [F.lag(c).over(w) for c in check_cols]
    first = F.lag(F.lit(1)).over(w).isNull()
    starts = snapshots.withColumn(
        "__start", first | null_safe_differs(prev, [F.col(c) for c in check_cols])
    ).where("__start")
    return starts.select(
        *data_cols,
        F.col(run_col).alias(valid_from),
        F.lead(run_col).over(w).alias(valid_to))


def current_rows(history: DataFrame, valid_to: str = "valid_to") -> DataFrame:
    return history.where(F.col(valid_to).isNull()).drop(valid_to)

"""Calendar periods and period snapshots.

Periods are parameters (a handful of quarters or weeks): their table is
broadcast after a check of its size.  No data row is joined to
every later period: each row is assigned to exactly one period (the first
whose end is on or after its date), reduced per (key, period), and only the
reduced rows are carried forward -- by a window over the small
``keys x periods`` grid, or by repeating a period's leaders over the periods
they stay latest in.  That is the set-based form of "latest row with
date <= period end" and of "count of rows up to period end".
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .joins import broadcast_if_small
from .latest import nth_per_key

PERIOD_COLS = ["period_id", "start_date", "end_date"]
MAX_PERIODS = 10_000   # more periods than this are taken for a mistake in the range


def quarter_periods(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Quarters from the one holding ``first`` to the one holding ``last`` (ISO dates).

    Columns match the periods file: year, quarter, yearquarter, start_date,
    end_date, zero, plus a dense ``period_id`` in time order.
    """
    f = _dt.date.fromisoformat(first)
    lst = _dt.date.fromisoformat(last)
    q0 = f.year * 4 + (f.month - 1) // 3
    q1 = lst.year * 4 + (lst.month - 1) // 3
    n = q1 - q0 + 1
    if n <= 0 or n > MAX_PERIODS:
        raise ValueError(f"quarter range gives {n} periods")
    y0, m0 = q0 // 4, (q0 % 4) * 3 + 1
    base = F.make_date(F.lit(y0), F.lit(m0), F.lit(1))
    return (spark.range(n).select(
        F.col("id").cast("int").alias("period_id"),
        F.add_months(base, (F.col("id") * 3).cast("int")).alias("start_date"))
        .withColumn("end_date", F.date_sub(F.add_months("start_date", 3), 1))
        .withColumn("year", F.year("start_date"))
        .withColumn("quarter", F.quarter("start_date"))
        .withColumn("yearquarter", F.concat(F.col("year").cast("string"), F.lit("Q"), F.col("quarter").cast("string")))
        .withColumn("zero", F.lit(0))
        .coalesce(1))


def week_periods(spark: SparkSession, first_monday: str, n: int) -> DataFrame:
    """``n`` consecutive 7-day periods starting at ``first_monday``."""
    if n <= 0 or n > MAX_PERIODS:
        raise ValueError(f"{n} periods")
    start = _dt.date.fromisoformat(first_monday)
    return (spark.range(n).select(
        F.col("id").cast("int").alias("period_id"),
        F.date_add(F.lit(start), (F.col("id") * 7).cast("int")).alias("start_date"))
        .withColumn("end_date", F.date_add("start_date", 6))
        .coalesce(1))


def cross_params(df: DataFrame, params: DataFrame) -> DataFrame:
    """Every row with every parameter row.  ``params`` is a parameter table
    (periods, settings); it is broadcast if its size is checked to be small, so
    the large side is never shuffled for it."""
    return df.crossJoin(broadcast_if_small(params))


def _bounds(periods: DataFrame) -> DataFrame:
    w = Window.orderBy("end_date")
    return periods.withColumn("__prev_end", F.lag("end_date").over(w))


def assign_period(df: DataFrame, date_col: str, periods: DataFrame, keep_cols: Sequence[str] | None = None) -> DataFrame:
    """Tag each row with the first period whose ``end_date`` is on or after its date
    (rows after the last period end are dropped; rows before the first period
    belong to it).  An equi-join on the day: the calendar holds one row for
    each day of the periods, and earlier dates count as the first period's end.
    """
    first_end = periods.select(F.min("end_date")).scalar()
    days = F.sequence(F.coalesce(F.date_add("__prev_end", 1), F.col("end_date")), F.col("end_date"))
    calendar = _bounds(periods).select("period_id", F.explode(days).alias("__day"))
    tagged = df.withColumn("__on", F.when(F.col(date_col).isNotNull(), F.greatest(F.to_date(F.col(date_col)), first_end)))
    return tagged.join(calendar, F.col("__on") == F.col("__day"), "inner").drop("__on", "__day")


def _grid(keys_df: DataFrame, periods: DataFrame) -> DataFrame:
    return keys_df.crossJoin(broadcast_if_small(periods))


def counts_up_to_period(df: DataFrame, keys: Sequence[str], date_col: str, periods: DataFrame,
                        cohort: DataFrame | None = None, out: str = "n_rows") -> DataFrame:
    """For each key x period, the number of rows with ``date <= end_date``.

    Rows are counted once in their own period and the counts are summed forward
    over periods (a running sum on the keys x periods grid), instead of joining
    each row to every later period.  ``cohort`` (a keys table) adds keys with
    zero rows.
    """
    per = assign_period(df, date_col, periods).groupBy(*keys, "period_id").agg(F.count(F.lit(1)).alias("__n"))
    key_tab = cohort.select(*keys).distinct() if cohort is not None else per.select(*keys).distinct()
    g = _grid(key_tab, periods).join(per, [*keys, "period_id"], "left")
    w = Window.partitionBy(*keys).orderBy("end_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return g.withColumn(out, F.coalesce(F.sum("__n").over(w), F.lit(0)).cast("long")).drop("__n")


def snapshot_latest_per_period(df: DataFrame, keys: Sequence[str], date_col: str, periods: DataFrame) -> DataFrame:
    """For each key x period, every row at the key's latest date on or before
    the period end (ties kept).  Periods before a key's first row give nothing.

    Rows are tagged with their own period and the latest date per (key, period)
    is aggregated: at most one row per key and period, over which a window finds
    the next period that has rows.  The rows at that date then join it on (key,
    period, date) -- a join that adaptive execution splits if a hot key's rows
    are tied -- and stand for every period until the next.  Output: the row's
    columns plus the period columns.
    """
    tagged = assign_period(df, date_col, periods).withColumn("__d", F.to_date(F.col(date_col)))
    last_pid = periods.select(F.max("period_id")).scalar()
    after = Window.partitionBy(*keys).orderBy("period_id")
    latest = (tagged.groupBy(*keys, "period_id").agg(F.max("__d").alias("__x"))
              .withColumn("__until", F.coalesce(F.lead("period_id").over(after) - 1, last_pid))
              .select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("period_id").alias("__p"), "__x", "__until"))
    same = (tagged["period_id"] == F.col("__p")) & (tagged["__d"] == F.col("__x"))
    for i, k in enumerate(keys):
        same = same & tagged[k].eqNullSafe(F.col(f"__k{i}"))
    spans = tagged.join(latest, same).withColumn("__pid", F.explode(F.sequence(F.col("period_id"), F.col("__until"))))
    period_cols = [c for c in periods.columns if c != "period_id"]
    row_cols = [c for c in df.columns if c not in keys and c not in period_cols]
    p = broadcast_if_small(periods.withColumnRenamed("period_id", "__pid"))
    out = spans.join(p, "__pid")
    return out.select(*keys, *row_cols, F.col("__pid").alias("period_id"), *period_cols)


def snapshot_with_blanks(cohort: DataFrame, df: DataFrame, keys: Sequence[str], date_col: str, tiebreak: str,
                         periods: DataFrame, value_cols: Sequence[str]) -> DataFrame:
    """Every cohort key x period with the single latest row on or before the
    period end (tie on date -> smallest ``tiebreak``), or nulls when none.
    """
    tagged = assign_period(df, date_col, periods).withColumn("__d", F.to_date(F.col(date_col)))
    best = nth_per_key(tagged, [*keys, "period_id"], [F.col("__d").desc(), F.col(tiebreak).asc()], 1)
    best = best.select(*keys, "period_id",
                       F.struct(*[F.col(c) for c in [date_col, tiebreak, *value_cols]]).alias("__row"))
    g = _grid(cohort.select(*keys).distinct(), periods).join(best, [*keys, "period_id"], "left")
    w = Window.partitionBy(*keys).orderBy("end_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    g = g.withColumn("__row", F.last("__row", ignorenulls=True).over(w))
    cols = [c for c in g.columns if c != "__row"]
    return g.select(*cols, *[F.col("__row")[c].alias(c) for c in [date_col, tiebreak, *value_cols]])

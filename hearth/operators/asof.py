"""As-of lookups (J11, J12, J13) and the "first after the last other" rule.

The source jobs answer these with correlated ``ORDER BY ... LIMIT 1``
subqueries run once per row.  Here an as-of join is one union of both sides
plus one window -- never a join that pairs every left row with every right row
of its group.

Skew: a plain per-group window would put a hot group (say one patient with a
third of all rows) into a single task.  With ``bucket`` the window is
partitioned by ``(group, bucket(time))`` instead; a left row whose match lies
in a later (forward) or earlier (backward) bucket takes it from a small
per-(group, bucket) table of bucket extremes, carried across buckets with a
window over that small table.  Both sides are shuffled once, on the same
``(group, bucket)`` key, so the final join back needs no second exchange of
the left side.

``bucket="adaptive"`` takes the bounds from the data: groups of both sides
together are counted, and only a group of more than ``piece_rows`` rows (or a
``PIECES``-th of all rows) is cut, at quantiles of its own times, into as many
pieces as it has that many rows.  So a hot group is cut however its rows lie in
time, other groups stay whole, and the table of bounds has at most ``PIECES``
groups and about twice as many bounds, whatever the size of the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


_T, _K, _TB, _P, _B, _IN, _NEXT = "__t", "__k", "__tb", "__p", "__b", "__in", "__next"

BUCKETS: dict[str, Callable[[Column], Column]] = {
    "day": lambda c: F.to_date(c),
    "month": lambda c: F.date_trunc("month", c),
    "year": lambda c: F.date_trunc("year", c),
}


PIECES = 10_000        # at most about this many rows in the table of bounds
CUTS = 1_024           # at most this many pieces of one group (a square number)


def _adaptive_bounds(times: DataFrame, by: list[str], piece_rows: int) -> DataFrame:
    """One row for each group to be cut: ``by`` and its sorted bounds ``__bounds``."""
    counts = times.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.select(F.sum("__n")).scalar()
    heavy = counts.withColumn("__piece", F.greatest(F.lit(float(piece_rows)), total / F.lit(float(PIECES)))) \
        .where(F.col("__n") > F.col("__piece"))
    shares = [F.lit(i / CUTS) for i in range(1, CUTS)]
    cut = times.join(F.broadcast(heavy), by).groupBy(*by).agg(     # fewer than PIECES groups are that large
        F.percentile_approx(_T, F.array(*shares), 10 * CUTS).alias("__q"), F.first("__n").alias("__n"), F.first("__piece").alias("__piece"))
    pieces = F.least(F.lit(CUTS), F.ceil(F.col("__n") / F.col("__piece"))).cast("int")
    every = F.transform(F.sequence(F.lit(1), pieces - 1), lambda i: F.element_at("__q", F.floor(i * CUTS / pieces).cast("int")))
    return cut.select(*by, F.array_sort(F.array_distinct(every)).alias("__bounds"))


def _piece(time: Column) -> Column:
    """How many bounds lie before ``time`` (null for no time), looked up in two steps of about the root of their number."""
    bounds, step = F.col("__bounds"), int(CUTS ** 0.5)
    heads = F.filter(bounds, lambda b, i: (i % step == 0) & (b < time))
    start = F.greatest(F.size(heads) - 1, F.lit(0)) * step
    inside = F.filter(F.slice(bounds, start + 1, F.lit(step)), lambda b: b < time)
    return F.when(time.isNotNull(), F.when(bounds.isNull(), F.lit(0)).otherwise(start + F.size(inside)))


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str,
              right_cols: Sequence[str], direction: str = "forward", inclusive: bool = True,
              tiebreak: str | None = None, bucket: str | Callable[[Column], Column] | None = None,
              prefix: str = "", piece_rows: int = 1_000_000) -> DataFrame:
    """Attach one right row to every left row of the same ``by`` group.

    ``forward``: the first right row with ``right_time >= left_time`` (``>`` when
    not inclusive), ties on time -> smallest ``tiebreak``.
    ``backward``: the last right row with ``right_time <= left_time`` (``<``),
    ties -> largest ``tiebreak``.
    Left rows with a null time or no match get nulls; every left row is kept
    exactly once.  ``right_cols`` are appended as ``prefix + name``.
    """
    if direction not in ("forward", "backward"):
        raise ValueError("direction must be 'forward' or 'backward'")
    by = list(by)
    fwd = direction == "forward"
    adaptive = bucket == "adaptive"
    bucket_fn = None if adaptive else BUCKETS[bucket] if isinstance(bucket, str) else bucket
    tb = F.col(tiebreak) if tiebreak else F.lit(0)
    right_kind = 0 if inclusive else 2   # at equal times: inclusive -> right rows first

    payload = F.struct(*[F.col(c).alias(c) for c in right_cols])
    r = (right.where(F.col(right_time).isNotNull() & _all_not_null(by))
         .select(*by, F.col(right_time).alias(_T), F.lit(right_kind).alias(_K), tb.alias(_TB),
                 payload.alias(_P)))
    lf = left.withColumn(_T, F.col(left_time)).withColumn(_K, F.lit(1))
    part = list(by)
    if adaptive:
        times = lf.where(F.col(_T).isNotNull() & _all_not_null(by)).select(*by, _T).unionByName(r.select(*by, _T))
        bounds = F.broadcast(_adaptive_bounds(times, by, piece_rows))
        r = r.join(bounds, by, "left").withColumn(_B, _piece(F.col(_T))).withColumn("__cut", F.col("__bounds").isNotNull()).drop("__bounds")
        lf = lf.join(bounds, by, "left").withColumn(_B, _piece(F.col(_T))).withColumn("__cut", F.col("__bounds").isNotNull()).drop("__bounds")
        part = by + [_B]
    elif bucket_fn is not None:
        r = r.withColumn(_B, bucket_fn(F.col(_T)))
        lf = lf.withColumn(_B, bucket_fn(F.col(_T)))
        part = by + [_B]

    both = lf.unionByName(r, allowMissingColumns=True)
    order = ([F.col(_T).desc(), F.col(_K).asc(), F.col(_TB).desc()] if fwd
             else [F.col(_T).asc(), F.col(_K).asc(), F.col(_TB).asc()])
    w = Window.partitionBy(*[F.col(c) for c in part]).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    matched = (both.withColumn(_IN, F.last(F.col(_P), ignorenulls=True).over(w))
               .where(F.col(_K) == 1)
               .withColumn(_IN, F.when(F.col(_T).isNull(), F.lit(None)).otherwise(F.col(_IN))))

    if adaptive or bucket_fn is not None:
        # one row per (group, bucket): the bucket's first (forward) / last (backward) right row;
        # a group that is not cut has no other bucket to look into
        cut = F.col("__cut") if adaptive else F.lit(True)
        ext = F.min_by if fwd else F.max_by
        per_bucket = r.where(cut).groupBy(*by, _B).agg(ext(F.col(_P), F.struct(F.col(_T), F.col(_TB))).alias("__edge"))
        left_buckets = lf.where(F.col(_B).isNotNull() & cut).select(*by, _B).distinct()
        grid = left_buckets.join(per_bucket, by + [_B], "full")
        wb = Window.partitionBy(*[F.col(c) for c in by]).orderBy(
            F.col(_B).desc() if fwd else F.col(_B).asc()).rowsBetween(Window.unboundedPreceding, -1)
        carry = grid.withColumn(_NEXT, F.last(F.col("__edge"), ignorenulls=True).over(wb)).select(*by, _B, _NEXT)
        matched = (matched.join(carry, by + [_B], "left")
                   .withColumn(_IN, F.coalesce(F.col(_IN), F.col(_NEXT))).drop(_NEXT, _B))

    out_cols = [F.col(c) for c in left.columns] + [F.col(_IN)[c].alias(prefix + c) for c in right_cols]
    return matched.select(*out_cols)


def _all_not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def first_after_last_other(df: DataFrame, keys: Sequence[str], date_col: str, status_col: str, status: str,
                           as_of=None, strict: bool = False, out: str = "first_date") -> DataFrame:
    """Per key, the first date with ``status`` on or after (after, if ``strict``)
    the last date with any other status; all dates capped at ``as_of``.
    Keys without another status take their first ``status`` date.

    Two partial aggregates and one join on the key -- no per-row subquery.
    """
    d = F.col(date_col)
    rows = df.where(d.isNotNull())
    if as_of is not None:
        rows = rows.where(d <= (as_of if isinstance(as_of, Column) else F.lit(as_of)))
    is_target = F.col(status_col) == F.lit(status)
    last_other = (rows.where(~is_target | F.col(status_col).isNull())
                  .groupBy(*keys).agg(F.max(d).alias("__last_other")))
    targets = rows.where(is_target).select(*keys, d.alias("__d"))
    j = targets.join(last_other, list(keys), "left")
    cond = (F.col("__last_other").isNull() |
            ((F.col("__d") > F.col("__last_other")) if strict else (F.col("__d") >= F.col("__last_other"))))
    return j.where(cond).groupBy(*keys).agg(F.min("__d").alias(out))

"""Best-row-per-key family.

Every "pick one row per key" is a ``row_number``/``rank`` filter over a window
partitioned by the key.  Spark plans such a filter as a *partial*
``WindowGroupLimit`` before the shuffle and a final one after it, so a key
holding a third of all rows sends at most ``n`` rows per map task across the
network -- the hot key never lands whole in one task.  Aggregate-shaped picks
(``min_by``/``max_by``) get the same property from partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import as_col

_RN = "__rn"


def _keys(keys) -> list[Column]:
    if isinstance(keys, (str, Column)):
        keys = [keys]
    return [as_col(k) for k in keys]


def _order(order) -> list[Column]:
    if isinstance(order, (str, Column)):
        order = [order]
    return [as_col(o) for o in order]


def nth_per_key(df: DataFrame, keys, order, n: int = 1, rank_col: str | None = None) -> DataFrame:
    """The ``n``-th row (1-based) per key under ``order`` (``row_number``; ties broken by ``order``)."""
    w = Window.partitionBy(*_keys(keys)).orderBy(*_order(order))
    out = df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == n)
    return out.withColumnRenamed(_RN, rank_col) if rank_col else out.drop(_RN)


def best_per_key(df: DataFrame, keys, order) -> DataFrame:
    """A2/A3: one row per key, the first under a preference ``order``.

    ``order`` must end in a unique column so the choice is deterministic.
    """
    return nth_per_key(df, keys, order, 1)


def top_n_per_key(df: DataFrame, keys, order, n: int, rank_col: str = "rank") -> DataFrame:
    """O2: the first ``n`` rows per key with their 1-based position."""
    w = Window.partitionBy(*_keys(keys)).orderBy(*_order(order))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def any_per_key(df: DataFrame, keys, id_col) -> DataFrame:
    """A1: ``select * ... group by key`` made deterministic: the row with the smallest id."""
    return best_per_key(df, keys, [as_col(id_col).asc()])


def nth_latest(df: DataFrame, keys, date_col, n: int = 0, tiebreak=None, as_of=None, since=None,
               inclusive: bool = True) -> DataFrame:
    """``ORDER BY date DESC LIMIT 1 OFFSET n`` per key, optionally only rows
    with ``since <= date <= as_of`` (``< as_of`` when ``inclusive`` is False).

    Ties on date are broken by ``tiebreak`` descending (the newest id wins).
    """
    d = as_col(date_col)
    rows = df.where(d.isNotNull())
    if as_of is not None:
        bound = as_of if isinstance(as_of, Column) else F.lit(as_of)
        rows = rows.where(d <= bound if inclusive else d < bound)
    if since is not None:
        lo = since if isinstance(since, Column) else F.lit(since)
        rows = rows.where(d >= lo)
    order = [d.desc()] + ([as_col(tiebreak).desc()] if tiebreak is not None else [])
    return nth_per_key(rows, keys, order, n + 1)


def latest_per_key(df: DataFrame, keys, date_col, tiebreak=None, as_of=None, inclusive: bool = True) -> DataFrame:
    """The latest row per key (ties -> largest ``tiebreak``)."""
    return nth_latest(df, keys, date_col, 0, tiebreak, as_of=as_of, inclusive=inclusive)


def earliest_per_key(df: DataFrame, keys, date_col, tiebreak=None, as_of=None) -> DataFrame:
    """The earliest row per key, optionally up to ``as_of`` (ties -> smallest ``tiebreak``)."""
    d = as_col(date_col)
    rows = df.where(d.isNotNull())
    if as_of is not None:
        rows = rows.where(d <= (as_of if isinstance(as_of, Column) else F.lit(as_of)))
    order = [d.asc()] + ([as_col(tiebreak).asc()] if tiebreak is not None else [])
    return best_per_key(rows, keys, order)


def ties_at_extreme(df: DataFrame, keys, col, largest: bool = True) -> DataFrame:
    """Every row whose ``col`` equals the per-key max (or min) -- ties kept.

    Two steps: the extreme per key by partial aggregation, then a semi-join on
    (key, extreme).  No window gathers a key: if a hot key's rows are all tied,
    adaptive execution splits the join's partition (a measured small table of
    extremes is broadcast and no row is shuffled).  Null keys are a group.
    """
    c, names = as_col(col), [f"__k{i}" for i in range(len(_keys(keys)))]
    ext = df.where(c.isNotNull()).groupBy(*[k.alias(n) for k, n in zip(_keys(keys), names)]).agg((F.max if largest else F.min)(c).alias("__x"))
    same = c == F.col("__x")
    for k, n in zip(_keys(keys), names):
        same = same & k.eqNullSafe(F.col(n))
    return df.join(ext, same, "left_semi")


def latest_vs_previous(df: DataFrame, keys, date_col, value_col, tiebreak=None,
                       last_name: str = "last_value", prev_name: str = "previous_value",
                       last_date: str | None = "last_date", prev_date: str | None = "previous_date") -> DataFrame:
    """One row per key with the newest and second-newest value (and dates)."""
    d = as_col(date_col)
    order = [d.desc()] + ([as_col(tiebreak).desc()] if tiebreak is not None else [])
    top2 = top_n_per_key(df.where(d.isNotNull()), keys, order, 2, _RN)
    key_cols = _keys(keys)
    aggs = [F.max(F.when(F.col(_RN) == 1, as_col(value_col))).alias(last_name),
            F.max(F.when(F.col(_RN) == 2, as_col(value_col))).alias(prev_name)]
    if last_date:
        aggs.append(F.max(F.when(F.col(_RN) == 1, d)).alias(last_date))
    if prev_date:
        aggs.append(F.max(F.when(F.col(_RN) == 2, d)).alias(prev_date))
    return top2.groupBy(*key_cols).agg(*aggs)


def value_at_latest(df: DataFrame, keys, date_col, tiebreak, value_cols: Sequence[str],
                    prefix: str = "") -> DataFrame:
    """Attributes of the row at the latest ``(date, tiebreak)`` per key, via
    ``max_by`` -- an aggregate, so it combines map-side before the shuffle."""
    d = as_col(date_col)
    ordering = F.struct(d, as_col(tiebreak))
    aggs = [F.max_by(as_col(v), ordering).alias(prefix + v) for v in value_cols]
    return df.where(d.isNotNull()).groupBy(*_keys(keys)).agg(F.max(d).alias(prefix + "date"), *aggs)


def value_at_earliest(df: DataFrame, keys, date_col, tiebreak, value_cols: Sequence[str],
                      prefix: str = "") -> DataFrame:
    """Attributes of the row at the earliest ``(date, tiebreak)`` per key (``min_by``)."""
    d = as_col(date_col)
    ordering = F.struct(d, as_col(tiebreak))
    aggs = [F.min_by(as_col(v), ordering).alias(prefix + v) for v in value_cols]
    return df.where(d.isNotNull()).groupBy(*_keys(keys)).agg(F.min(d).alias(prefix + "date"), *aggs)


def current_state_at(states: DataFrame, keys, start_col, end_col, as_of, order_extra=()) -> DataFrame:
    """The state open at ``as_of`` (``start <= as_of`` and end null or after it),
    latest start first, then ``order_extra`` (e.g. enrollment desc, completion asc)."""
    s, e = as_col(start_col), as_col(end_col)
    t = as_of if isinstance(as_of, Column) else F.lit(as_of)
    open_at = states.where((s <= t) & (e.isNull() | (e > t)))
    return best_per_key(open_at, keys, [s.desc(), *list(order_extra)])


def picks_per_key(df: DataFrame, keys, date_col, tiebreak, picks: dict) -> DataFrame:
    """Several "latest (or earliest) row satisfying a condition" lookups from one
    table in ONE grouped aggregate.

    ``picks`` maps a pick name to ``(condition, {out_name: value}, "max"|"min")``;
    each pick is ``max_by``/``min_by`` of a struct of its values ordered by
    ``(date, tiebreak)`` of the rows meeting its condition (other rows have a
    null ordering and are ignored).  One shuffle with map-side combine replaces
    one window-and-join per lookup.
    """
    d, tb = as_col(date_col), as_col(tiebreak)
    aggs = []
    for name, spec in picks.items():
        cond, values = spec[0], spec[1]
        how = spec[2] if len(spec) > 2 else "max"
        st = F.struct(*[as_col(v).alias(a) for a, v in values.items()])
        order = F.when(cond & d.isNotNull(), F.struct(d, tb))
        aggs.append((F.max_by if how == "max" else F.min_by)(st, order).alias(name))
    g = df.groupBy(*_keys(keys)).agg(*aggs)
    key_names = [k if isinstance(k, str) else None for k in (keys if isinstance(keys, (list, tuple)) else [keys])]
    return g.select(*[F.col(k) for k in key_names],
                    *[F.col(n)[a].alias(a) for n, spec in picks.items() for a in spec[1]])

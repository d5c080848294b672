"""Surrogate keys.

A global ``row_number() over (order by k)`` moves every row into one
partition.  ``dense_key`` gives the same numbering without that: a value's
bucket is a function of the value alone that grows with it (a thousand
neighbouring numbers, a month, a text's first characters), each bucket counts
its distinct keys, a running sum over that count table (one row per bucket)
gives each bucket's offset, and a key's number is offset + its row number
inside the bucket.  Counts and rows are computed from the same values, so the
numbering does not depend on partitioning, sampling or the reuse of a shuffle.

``number_rows`` gives the same numbering to tables of data size (visits, lab
tests): offsets in levels, so that every window is over a bounded part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _bucket(df: DataFrame, name: str) -> Column:
    """A function of the column that is the same or larger for every larger value (null for null)."""
    c, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.shiftright(c.cast("long"), 10)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.year(c) * 12 + F.month(c)
    if isinstance(kind, T.StringType):
        return F.substring(c, 1, 3)
    if isinstance(kind, T.DecimalType):
        return F.floor(c / 1000)
    return c                             # floating point, boolean, binary: the value


def dense_key(df: DataFrame, order_cols: Sequence[str], key_col: str = "id", start: int = 1) -> DataFrame:
    """Distinct ``order_cols`` numbered ``start, start+1, ...`` in ascending
    order (nulls first, like ``ORDER BY``).  Buckets come from the first column;
    one bucket is sorted in one task and all bucket counts in one, so this is
    for dimensions; tables of data size use ``number_rows``."""
    d = df.select(*order_cols).distinct().withColumn("__b", _bucket(df, order_cols[0]))
    counts = d.groupBy("__b").agg(F.count(F.lit(1)).alias("__cnt"))
    before = Window.orderBy(F.col("__b").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("__b").alias("__ob"), F.coalesce(F.sum("__cnt").over(before), F.lit(0)).alias("__off"))
    within = Window.partitionBy("__b").orderBy(*[F.col(c).asc_nulls_first() for c in order_cols])
    out = d.withColumn("__pos", F.row_number().over(within)).join(offsets, F.col("__b").eqNullSafe(F.col("__ob")))
    return out.select(*order_cols, (F.col("__off") + F.col("__pos") + F.lit(start - 1)).cast("long").alias(key_col))


def number_rows(df: DataFrame, order_cols: Sequence[str], key_col: str = "id", start: int = 1) -> DataFrame:
    """``dense_key`` for tables of data size whose first column is an id.

    Prefix sums in levels: 262,144 neighbouring ids (``__top``), of these one id
    and one bucket of the second column (such as a month), and the rows in it.
    Each level's counts are summed within the level above; only the counts of the
    top level -- one row per 262,144 ids -- are ordered together.  An id with a
    large share of the rows is spread over the buckets of the second column."""
    first, second = order_cols[0], order_cols[1] if len(order_cols) > 1 else None
    if not isinstance(df.schema[first].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"number_rows orders by an id first, {first} is {df.schema[first].dataType.simpleString()}")
    d = df.select(*order_cols).distinct().withColumn("__top", F.shiftright(F.col(first).cast("long"), 18)) \
        .withColumn("__b", _bucket(df, second) if second else F.lit(0))

    def before(within: list[str], order: list[str]) -> Column:
        w = Window.partitionBy(*within).orderBy(*[F.col(x).asc_nulls_first() for x in order]).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("__n").over(w), F.lit(0))

    groups = d.groupBy("__top", first, "__b").agg(F.count(F.lit(1)).alias("__n"))
    tops = groups.groupBy("__top").agg(F.sum("__n").alias("__n")).select(F.col("__top").alias("__t"), before([], ["__top"]).alias("__above"))
    offsets = groups.withColumn("__in", before(["__top"], [first, "__b"])).join(tops, F.col("__top").eqNullSafe(F.col("__t"))) \
        .select(F.col(first).alias("__f"), F.col("__b").alias("__fb"), (F.col("__in") + F.col("__above")).alias("__off"))
    within = Window.partitionBy(first, "__b").orderBy(*[F.col(x).asc_nulls_first() for x in order_cols])
    numbered = d.withColumn("__pos", F.row_number().over(within))
    rows = numbered.join(offsets, numbered[first].eqNullSafe(F.col("__f")) & numbered["__b"].eqNullSafe(F.col("__fb")))
    return rows.select(*order_cols, (F.col("__off") + F.col("__pos") + F.lit(start - 1)).cast("long").alias(key_col))


def attach_key(df: DataFrame, keyed: DataFrame, on: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Join a surrogate key table back on its natural key (null matches null)."""
    r = keyed.select(*[F.col(c).alias(f"__k_{c}") for c in on], *[c for c in keyed.columns if c not in on])
    cond = None
    for c in on:
        e = df[c].eqNullSafe(r[f"__k_{c}"]) if null_safe else df[c] == r[f"__k_{c}"]
        cond = e if cond is None else cond & e
    return df.join(r, cond, "left").drop(*[f"__k_{c}" for c in on])

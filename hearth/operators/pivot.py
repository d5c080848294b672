"""Entity-attribute-value pivots and per-group flags.

The source jobs build a form table with one scan and one merge join per
column (up to 66 scans for one table).  Here a form is compiled from a list
of ``PivotColumn`` specs into ONE ``groupBy(keys).agg(...)`` over the joined
observations -- one scan, one shuffle with map-side partial aggregation (a hot
patient is combined before the shuffle), then one left join from the spine.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import as_col, ci_eq, ci_in, fold


@dataclass(frozen=True)
class PivotColumn:
    """One output column of a pivot.

    ``concept``: the attribute name matched case-insensitively (a tuple means any of them).
    ``value``: the value column to take (or a Column expression).
    ``answer``: when set, only observations whose ``answer_col`` equals it count.
    ``agg``: first | last | min | max | exists | flag | count | concat_distinct | concat | all_present
    ``cast``: output Spark type name.
    """
    name: str
    concept: str | tuple | None
    value: str | Column | None = "value"
    answer: str | None = None
    agg: str = "first"
    cast: str | None = None
    sep: str = ", "
    n_required: int | None = None
    group: str | None = None      # concept of the parent observation group (J16), matched case-insensitively
    require: str | None = None    # name of a boolean column that must also be true (e.g. the encounter-type test)


def _match(spec: PivotColumn, concept_col: str, answer_col: str | None,
           group_col: str = "group_concept") -> Column:
    cond = F.lit(True)
    if spec.group is not None:
        cond = cond & ci_eq(group_col, spec.group)
    if spec.require is not None:
        cond = cond & F.coalesce(F.col(spec.require), F.lit(False))
    if spec.concept is not None:
        cond = cond & (ci_in(concept_col, spec.concept) if isinstance(spec.concept, tuple)
                       else ci_eq(concept_col, spec.concept))
    if spec.answer is not None:
        target = answer_col or (spec.value if isinstance(spec.value, str) else "value_coded")
        cond = cond & ci_eq(target, spec.answer)
    return cond


def pivot_aggregates(columns: Sequence[PivotColumn], concept_col: str = "concept", id_col: str = "obs_id",
                     answer_col: str | None = None) -> list[Column]:
    """Compile pivot specs into aggregate expressions for one ``agg`` call."""
    out = []
    for s in columns:
        cond = _match(s, concept_col, answer_col)
        v = as_col(s.value) if s.value is not None else F.lit(True)
        picked = F.when(cond, v)
        if s.agg == "first":
            e = F.min_by(picked, F.when(cond, as_col(id_col)))
        elif s.agg == "last":
            e = F.max_by(picked, F.when(cond, as_col(id_col)))
        elif s.agg == "min":
            e = F.min(picked)
        elif s.agg == "max":
            e = F.max(picked)
        elif s.agg == "exists":
            e = F.coalesce(F.max(cond), F.lit(False))
        elif s.agg == "flag":                      # true when present, null when absent
            e = F.max(F.when(cond, F.lit(True)))
        elif s.agg == "count":
            e = F.count(picked)
        elif s.agg == "concat_distinct":
            e = F.array_join(F.array_sort(F.collect_set(picked)), s.sep)
            e = F.when(F.length(e) > 0, e)
        elif s.agg == "concat":
            e = F.array_join(F.sort_array(F.collect_list(picked)), s.sep)
            e = F.when(F.length(e) > 0, e)
        elif s.agg == "all_present":
            if not isinstance(s.concept, tuple):
                raise ValueError("all_present needs a tuple of concepts")
            n = s.n_required or len(s.concept)
            e = F.count_distinct(F.when(cond, fold(concept_col))) == F.lit(n)
        else:
            raise ValueError(f"unknown pivot agg {s.agg}")
        if s.cast:
            if s.cast in ("int", "integer", "long", "bigint", "smallint") and s.agg in ("first", "last", "min", "max"):
                e = F.round(e)   # integer targets round half away from zero, never truncate
            e = e.cast(s.cast)
        out.append(e.alias(s.name))
    return out


def form_pivot(obs: DataFrame, keys: Sequence, columns: Sequence[PivotColumn], concept_col: str = "concept",
               id_col: str = "obs_id", answer_col: str | None = None, spine: DataFrame | None = None,
               null_safe: Sequence[str] = ()) -> DataFrame:
    """EAV rows -> one row per key with one column per spec.

    Only observations whose concept is named by some spec are scanned into the
    aggregate (a pushed-down ``IN`` filter).  With ``spine`` the result is the
    spine left-joined to the pivot (keys in ``null_safe`` match null to null).
    """
    concepts = set()
    anything = False
    for s in columns:
        if s.concept is None:
            anything = True
        elif isinstance(s.concept, tuple):
            concepts.update(c.strip().lower() for c in s.concept)
        else:
            concepts.add(s.concept.strip().lower())
    if anything or not concepts:
        rows = obs
    else:
        names = sorted({c for s in columns if s.concept is not None
                        for c in (s.concept if isinstance(s.concept, tuple) else (s.concept,))})
        rows = obs.where(ci_in(concept_col, names))
    key_cols = [as_col(k) for k in keys]
    piv = rows.groupBy(*key_cols).agg(*pivot_aggregates(columns, concept_col, id_col, answer_col))
    if spine is None:
        return piv
    names = [k if isinstance(k, str) else None for k in keys]
    if any(n is None for n in names):
        raise ValueError("spine joins need key names")
    return left_join_keys(spine, piv, names, null_safe)


def left_join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: Sequence[str] = ()) -> DataFrame:
    """Left join on named keys; keys listed in ``null_safe`` match null to null."""
    if not null_safe:
        return left.join(right, list(keys), "left")
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"]) if k in null_safe else (left[k] == r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left").drop(*[f"__r_{k}" for k in keys])


def pivot_attributes(df: DataFrame, keys: Sequence[str], name_col: str, value_col: str, names: Sequence[str],
                     order: Sequence[Column], rename: dict | None = None) -> DataFrame:
    """A3+A4: newest value per (key, attribute name), then one column per configured name.

    ``groupBy(...).pivot(name, names)`` with the names given up front, so Spark
    runs no extra job to discover them.
    """
    from .latest import best_per_key
    wanted = df.where(F.col(name_col).isin(list(names)))
    newest = best_per_key(wanted, [*keys, name_col], list(order))
    piv = newest.groupBy(*keys).pivot(name_col, list(names)).agg(F.first(value_col))
    if rename:
        for a, b in rename.items():
            piv = piv.withColumnRenamed(a, b)
    return piv


def conditional_max(keys: Sequence[str], df: DataFrame, cases: dict[str, tuple[Column, Column]]) -> DataFrame:
    """``max(case when cond then value end)`` per key, one column per case."""
    return df.groupBy(*keys).agg(*[F.max(F.when(c, v)).alias(n) for n, (c, v) in cases.items()])


def conditional_sums(df: DataFrame, keys: Sequence[str], cases: dict[str, Column],
                     all_keys: DataFrame | None = None) -> DataFrame:
    """``sum(case when cond then 1 else 0 end)`` per key; ``all_keys`` keeps empty groups with 0."""
    agg = df.groupBy(*keys).agg(*[F.sum(F.when(c, 1).otherwise(0)).cast("long").alias(n) for n, c in cases.items()])
    if all_keys is None:
        return agg
    out = all_keys.select(*keys).distinct().join(agg, list(keys), "left")
    for n in cases:
        out = out.withColumn(n, F.coalesce(F.col(n), F.lit(0)).cast("long"))
    return out


def flags_from_set(df: DataFrame, keys: Sequence[str], col: str, values: dict[str, str]) -> DataFrame:
    """One boolean per listed value: did the group contain it (exact, case-folded)."""
    return df.groupBy(*keys).agg(*[F.coalesce(F.max(ci_eq(col, v)), F.lit(False)).alias(n)
                                   for n, v in values.items()])


CELL_CHARS = 16_000_000    # longest text of a group


def concat_group(df: DataFrame, keys: Sequence[str], col: str, out: str, sep: str = ",",
                 distinct: bool = False, most_chars: int = CELL_CHARS) -> DataFrame:
    """Concatenated values per group in a fixed (sorted) order.

    Values are first counted per (key, value) -- a partial aggregate, so a hot
    key is combined map-side.  The length of each group's text follows from the
    counts: a group whose text would exceed ``most_chars`` is an error, raised
    before any of its values are gathered.  The text is then built in two
    ordered steps: values that begin alike within a group, then these pieces, so
    that no task sorts more than one piece and the pieces of a group.
    """
    value, n = F.col(col), F.lit(1) if distinct else F.col("__n")
    names = [f"__k{i}" for i in range(len(keys))]
    counted = df.where(value.isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("__n"))
    totals = counted.groupBy(*[F.col(k).alias(x) for k, x in zip(keys, names)]) \
        .agg(F.sum((F.length(value.cast("string")) + len(sep)) * n).alias("__chars"))
    same = None
    for k, x in zip(keys, names):
        e = F.col(k).eqNullSafe(F.col(x))
        same = e if same is None else same & e
    fits = F.when(F.col("__chars") > most_chars, F.raise_error(F.concat(
        F.lit(f"{out}: the text of a group has "), F.col("__chars").cast("string"), F.lit(f" characters, more than {most_chars}"))))
    checked = counted.join(totals, same).select(*keys, F.coalesce(fits, value).alias(col), "__n")
    text_value = isinstance(df.schema[col].dataType, StringType)
    head = F.substring(F.col(col), 1, 2) if text_value else F.lit("")
    pairs = F.array_sort(F.collect_list(F.struct(F.col(col).alias("v"), F.col("__n").alias("n"))))
    if distinct:
        text = F.array_join(F.transform(pairs, lambda p: p["v"]), sep)
    else:
        text = F.array_join(F.flatten(F.transform(pairs, lambda p: F.array_repeat(p["v"], p["n"].cast("int")))), sep)
    pieces = checked.groupBy(*keys, head.alias("__head")).agg(text.alias("__text"))
    whole = F.array_sort(F.collect_list(F.struct("__head", "__text")))
    return pieces.groupBy(*keys).agg(F.array_join(F.transform(whole, lambda p: p["__text"]), sep).alias(out))


def exists_flag(df: DataFrame, keys: Sequence[str], cond: Column, out: str) -> DataFrame:
    """``count(*) > 0`` of rows meeting ``cond`` per key."""
    return df.groupBy(*keys).agg(F.coalesce(F.max(cond), F.lit(False)).alias(out))


def all_of_n_present(df: DataFrame, keys: Sequence[str], col: str, values: Sequence[str], out: str) -> DataFrame:
    """True when every one of ``values`` occurs in the group."""
    want = [v.strip().lower() for v in values]
    return (df.groupBy(*keys).agg(
        (F.count_distinct(F.when(fold(col).isin(want), fold(col))) == F.lit(len(set(want)))).alias(out)))

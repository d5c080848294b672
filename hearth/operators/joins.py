"""Joins (J1-J6, J9, J14-J17).

Join strategy is left to Catalyst + AQE: a lookup or dimension small enough at
run time becomes a broadcast hash join, anything larger stays a sort-merge
join (with skewed partitions split by AQE).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_col


BROADCAST_BYTES, BROADCAST_ROWS = 64 << 20, 100_000


def small_enough(df: DataFrame, most_bytes: int = BROADCAST_BYTES, most_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table is known to be small: the planner's estimate of its size
    or, where the planner knows none (rows handed over by the driver), a count
    that stops at ``most_rows``."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    unknown = int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(2 ** 63 - 1)))
    if size < min(unknown, 2 ** 60):
        return size <= most_bytes
    return df.limit(most_rows + 1).count() <= most_rows


def broadcast_if_small(df: DataFrame, most_bytes: int = BROADCAST_BYTES, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint only if it is small; else the planner joins it by shuffles."""
    return F.broadcast(df) if small_enough(df, most_bytes, most_rows) else df


def decode(df: DataFrame, lookup: DataFrame, on: str, key: str, label: str, out: str | None = None) -> DataFrame:
    """Attach ``lookup.label`` where ``df.on == lookup.key``; a miss gives null, the row stays."""
    lk = lookup.select(F.col(key).alias("__lk_key"), F.col(label).alias(out or label))
    return df.join(lk, df[on] == lk["__lk_key"], "left").drop("__lk_key")


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "lookup") -> None:
    """Abort when ``keys`` repeat (the ETL's fail-on-multiple lookups).  Reads at most one row."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"{what} has duplicate keys {list(keys)}: {dup[0].asDict()}")


def decode_strict(df: DataFrame, lookup: DataFrame, on: str, key: str, label: str, out: str | None = None) -> DataFrame:
    """As ``decode`` but duplicate lookup keys are an error, found at once."""
    assert_unique(lookup, [key])
    return decode(df, lookup, on, key, label, out)


def decode_or_abort(df: DataFrame, lookup: DataFrame, on: str, key: str, label: str, out: str | None = None) -> DataFrame:
    """J2 inside a plan: the job fails when a row meets a lookup key that stands
    more than once, and nothing runs while the plan is built."""
    name = out or label
    once = lookup.groupBy(F.col(key).alias("__lk_key")).agg(F.count(F.lit(1)).alias("__n"), F.first(label).alias("__label"))
    j = df.join(once, df[on] == once["__lk_key"], "left")
    checked = F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit(f"lookup for {on} has duplicate key "),
                                                             F.col("__lk_key").cast("string")))).otherwise(F.col("__label"))
    return j.withColumn(name, checked).drop("__lk_key", "__n", "__label")


def decode_two_sources(df: DataFrame, first: tuple, second: tuple, out: str) -> DataFrame:
    """One label from two lookups (e.g. coded answer by concept, else by drug)."""
    (lk1, on1, k1, l1), (lk2, on2, k2, l2) = first, second
    x = decode(df, lk1, on1, k1, l1, "__lbl1")
    x = decode(x, lk2, on2, k2, l2, "__lbl2")
    return x.withColumn(out, F.coalesce("__lbl1", "__lbl2")).drop("__lbl1", "__lbl2")


def left_merge(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: Sequence[str] = ()) -> DataFrame:
    """Left outer join on 1-4 keys; keys in ``null_safe`` (e.g. location) match null to null."""
    from .pivot import left_join_keys
    return left_join_keys(left, right, keys, null_safe)


def left_join_nulls_apart(left: DataFrame, right: DataFrame, on: str, key: str, spread: str, parts: int = 1024) -> DataFrame:
    """J4 on one integer key where many rows of ``left`` have none: those match nothing,
    so they are dealt by ``spread`` and do not meet in one task.  ``key`` stays in the result."""
    # not a literal on either side: the optimizer would fold it out of the join's keys
    r = right.withColumn("__part", F.col(key).bitwiseAND(F.lit(0).cast("long")))
    part = F.when(F.col(on).isNull(), F.pmod(F.xxhash64(spread), F.lit(parts))).otherwise(F.lit(0).cast("long"))
    x = left.withColumn("__own", part)
    return x.join(r, (x[on] == r[key]) & (x["__own"] == r["__part"]), "left").drop("__own", "__part")


def full_merge(left: DataFrame, right: DataFrame, keys: Sequence[str], coalesce_cols: dict | None = None) -> DataFrame:
    """Full outer join; the keys are coalesced from both sides, and each
    ``out: (left_col, right_col)`` pair in ``coalesce_cols`` is merged too."""
    l2 = left.select(*[F.col(c).alias(f"__l_{c}") if c in keys else F.col(c) for c in left.columns])
    r2 = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = l2[f"__l_{k}"] == r2[f"__r_{k}"]
        cond = c if cond is None else cond & c
    j = l2.join(r2, cond, "full")
    for k in keys:
        j = j.withColumn(k, F.coalesce(F.col(f"__l_{k}"), F.col(f"__r_{k}"))).drop(f"__l_{k}", f"__r_{k}")
    for out, (a, b) in (coalesce_cols or {}).items():
        j = j.withColumn(out, F.coalesce(as_col(a), as_col(b)))
    return j.select(*keys, *[c for c in j.columns if c not in keys])


def semi_in(df: DataFrame, other: DataFrame, on: str, other_key: str | None = None) -> DataFrame:
    """``on IN (select key from other)``."""
    k = other_key or on
    return df.join(other.select(F.col(k).alias("__k")).where(F.col("__k").isNotNull()), df[on] == F.col("__k"),
                   "left_semi")


def anti_not_in(df: DataFrame, other: DataFrame, on: str, other_key: str | None = None) -> DataFrame:
    """``on NOT IN (select key from other)`` with SQL null rules: a null
    ``on`` never passes; a null in ``other`` removes every row."""
    k = other_key or on
    keys = other.select(F.col(k).alias("__k"))
    has_null = keys.where(F.col("__k").isNull()).limit(1)
    out = df.where(F.col(on).isNotNull()).join(keys.where(F.col("__k").isNotNull()), df[on] == F.col("__k"),
                                                "left_anti")
    return out.join(has_null, F.lit(True), "left_anti")


def correlated_agg(df: DataFrame, detail: DataFrame, on: str, detail_key: str, aggs: dict, fill: dict | None = None) -> DataFrame:
    """Scalar subqueries (``select count(*)/max(x) from detail where k = df.k``)
    as one pre-aggregation joined back; ``fill`` sets values for keys with no rows
    (``count`` gives 0)."""
    agg = detail.groupBy(F.col(detail_key).alias("__ck")).agg(*[e.alias(n) for n, e in aggs.items()])
    out = df.join(agg, df[on] == F.col("__ck"), "left").drop("__ck")
    for n, v in (fill or {}).items():
        out = out.withColumn(n, F.coalesce(F.col(n), F.lit(v)))
    return out


def two_sided_edges(rel: DataFrame, a_col: str, b_col: str, a_role: str, b_role: str, patients: DataFrame,
                    patient_key: str, out_cols: Sequence[str] = ()) -> DataFrame:
    """Each relationship yields one row per side that is a patient, with
    the roles swapped for the B side: (patient, other, role_of_other)."""
    pk = patients.select(F.col(patient_key).alias("__pk")).distinct()
    side_a = rel.select(F.col(a_col).alias("patient_id"), F.col(b_col).alias("related_person_id"),
                        F.col(a_role).alias("role"), *out_cols)
    side_b = rel.select(F.col(b_col).alias("patient_id"), F.col(a_col).alias("related_person_id"),
                        F.col(b_role).alias("role"), *out_cols)
    both = side_a.unionByName(side_b)
    return both.join(pk, both["patient_id"] == pk["__pk"], "left_semi")


def child_in_named_group(obs: DataFrame, groups: DataFrame, group_key: str, group_concept_col: str,
                         concept: str, obs_group_col: str = "obs_group_id") -> DataFrame:
    """Observations whose parent group has concept ``concept``."""
    from ..functions import ci_eq
    g = groups.where(ci_eq(group_concept_col, concept)).select(F.col(group_key).alias("__g"))
    return obs.join(g, obs[obs_group_col] == g["__g"], "left_semi")


def sibling_in_encounter(df: DataFrame, siblings: DataFrame, key: str, cols: dict) -> DataFrame:
    """Pair each row with values of another observation of the same
    encounter (left self-join on the encounter).  ``siblings`` must hold at
    most one row per key (pre-aggregate it) so no pairs multiply."""
    s = siblings.select(F.col(key).alias("__sk"), *[as_col(v).alias(n) for n, v in cols.items()])
    return df.join(s, df[key] == s["__sk"], "left").drop("__sk")

"""Row filters and predicates (P1-P14).  All are plain ``where`` clauses or
semi/anti joins, so Catalyst pushes them into the scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_col, ci_in
from .joins import broadcast_if_small


def not_voided(df: DataFrame, flag: str = "voided") -> Column:
    return F.coalesce(F.col(flag).cast("boolean"), F.lit(False)) == F.lit(False)


def keep_live(df: DataFrame, owner: DataFrame | None = None, on: str | None = None, owner_key: str | None = None,
              flag: str = "voided", owner_flag: str = "voided") -> DataFrame:
    """The row's own flag is 0 and (optionally) its owner's flag is 0 too."""
    out = df.where(~F.coalesce(F.col(flag).cast("boolean"), F.lit(False)))
    if owner is not None:
        live = owner.where(~F.coalesce(F.col(owner_flag).cast("boolean"), F.lit(False))) \
            .select(F.col(owner_key or on).alias("__owner"))
        out = out.join(live, out[on] == live["__owner"], "left_semi")
    return out


def require_not_null(df: DataFrame, cols: Sequence[str], non_blank: Sequence[str] = ()) -> DataFrame:
    """Drop rows lacking mandatory values (and, for ``non_blank``, empty text)."""
    out = df.dropna(subset=list(cols)) if cols else df
    for c in non_blank:
        out = out.where(F.col(c).isNotNull() & (F.trim(F.col(c)) != ""))
    return out


def exclude_flag_null_kept(df: DataFrame, flag) -> DataFrame:
    """Drop rows where the flag is true; a null flag passes."""
    return df.where(~F.coalesce(as_col(flag).cast("boolean"), F.lit(False)))


def retain_cohort(df: DataFrame, patient_col: str, cohort: DataFrame, cohort_key: str,
                  type_col: str | None = None, types: Sequence[str] = (), keep_null_type: bool = True) -> DataFrame:
    """Keep rows whose patient is in the cohort, or (when ``type_col`` is
    given) whose type is listed, or whose type is null."""
    c = cohort.select(F.col(cohort_key).alias("__cp")).distinct().withColumn("__in", F.lit(True))
    j = df.join(c, df[patient_col] == c["__cp"], "left")
    keep = F.coalesce(F.col("__in"), F.lit(False))
    if type_col is not None:
        keep = keep | ci_in(type_col, types)
        if keep_null_type:
            keep = keep | F.col(type_col).isNull()
    return j.where(keep).drop("__cp", "__in")


def drop_concepts(obs: DataFrame, concept_col: str, blacklist: DataFrame | Sequence[str], list_col: str = "concept") -> DataFrame:
    """Remove observations whose concept is on a blacklist (case-folded)."""
    if isinstance(blacklist, DataFrame):
        bl = blacklist.select(F.lower(F.trim(F.col(list_col))).alias("__bl"))
        return obs.join(broadcast_if_small(bl), F.lower(F.trim(obs[concept_col])) == bl["__bl"], "left_anti")
    return obs.where(~ci_in(concept_col, blacklist) | F.col(concept_col).isNull())


def delete_by_key_prefix(df: DataFrame, key: str, prefix: str) -> DataFrame:
    """Remove previously derived rows whose id starts with ``prefix``."""
    return df.where(F.col(key).isNull() | ~F.col(key).cast("string").startswith(prefix))


def typed_value_filter(obs: DataFrame, value_col: str) -> DataFrame:
    """P10: observations carrying the given value kind."""
    return obs.where(F.col(value_col).isNotNull())


def drop_if_latest_state_not(df: DataFrame, patient_col: str, states: DataFrame, state_patient: str, state_col: str,
                             date_col: str, id_col: str, keep_state: str | None) -> DataFrame:
    """When ``keep_state`` is given, drop patients whose latest state differs
    from it; patients without any state, or whose latest state is null, stay
    (SQL ``state <> x`` is not true of a null)."""
    if keep_state is None:
        return df
    from ..functions import ci_eq
    from .latest import latest_per_key
    latest = latest_per_key(states, [state_patient], date_col, id_col)
    bad = latest.where(~ci_eq(state_col, keep_state)).select(F.col(state_patient).alias("__p"))
    return df.join(bad, df[patient_col] == bad["__p"], "left_anti")


def active_on(df: DataFrame, end_col: str, as_of, location_col: str | None = None, location=None,
              start_col: str | None = None) -> DataFrame:
    """``end is null or end > as_of`` (and started by ``as_of`` when ``start_col`` is given)."""
    t = as_of if isinstance(as_of, Column) else F.lit(as_of)
    out = df.where(F.col(end_col).isNull() | (F.col(end_col) > t))
    if start_col:
        out = out.where(F.col(start_col) <= t)
    return optional_param(out, location_col, location) if location_col else out


def optional_param(df: DataFrame, col: str, value) -> DataFrame:
    """``(param is null or col = param)`` -- the predicate is added only when given."""
    if value is None:
        return df
    from ..functions import ci_eq
    return df.where(ci_eq(col, value) if isinstance(value, str) else (F.col(col) == F.lit(value)))


def in_list(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Literal list membership, case-folded."""
    return df.where(ci_in(col, values))

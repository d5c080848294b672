"""Set operations and stream routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """``UNION`` (distinct) of same-shaped inputs, matched by column name.
    The distinct is a hash aggregate with map-side dedup before the shuffle."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


def append_streams(tagged: Sequence[tuple[DataFrame, object]], tag_col: str = "tag") -> DataFrame:
    """Union-all of several streams, each tagged with a literal."""
    out = None
    for df, tag in tagged:
        x = df.withColumn(tag_col, F.lit(tag))
        out = x if out is None else out.unionByName(x, allowMissingColumns=True)
    return out


def rule_union(rules: Sequence[tuple[str, DataFrame]], key_cols: Sequence[str], label_col: str = "criteria") -> DataFrame:
    """U4: several rule queries into one ``(keys..., label)`` table; duplicates kept."""
    out = None
    for label, df in rules:
        x = df.select(*key_cols, F.lit(label).alias(label_col))
        out = x if out is None else out.unionByName(x)
    return out


def upsert_merge(parts: Sequence[DataFrame], key: str | Sequence[str]) -> DataFrame:
    """The ``INSERT ... ON DUPLICATE KEY UPDATE`` passes as a chain of full
    outer joins of per-key aggregates (each part has one row per key)."""
    from .joins import full_merge
    keys = [key] if isinstance(key, str) else list(key)
    out = parts[0]
    for p in parts[1:]:
        out = full_merge(out, p, keys)
    return out


def union_sites(frames: Sequence[tuple[str, DataFrame]], site_col: str = "site_id") -> DataFrame:
    """One table from many site copies, each row tagged with its site.
    Missing columns are filled with nulls; sites absent from the list are simply
    not passed (the caller lists only paths that exist)."""
    out = None
    for site, df in frames:
        x = df.withColumn(site_col, F.lit(site))
        out = x if out is None else out.unionByName(x, allowMissingColumns=True)
    return out


def route_by_flag(df: DataFrame, flag: Column) -> tuple[DataFrame, DataFrame]:
    """Split one stream into (flag true, flag false/null) branches."""
    f = F.coalesce(flag, F.lit(False))
    return df.where(f), df.where(~f)


def sink_order(df: DataFrame, keys) -> DataFrame:
    """O1: the multi-key, case-insensitive order used only when writing a sink
    (a distributed range-partitioned sort; nothing upstream depends on order)."""
    from ..functions import as_col
    cols = []
    for k in ([keys] if isinstance(keys, str) else keys):
        c = as_col(k)
        cols.append(F.lower(c) if isinstance(k, str) and dict(df.dtypes).get(k) == "string" else c)
    return df.orderBy(*cols)

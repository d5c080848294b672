"""Warehouse tables that several sites share, and loads that can be repeated.

A shared table is one folder with a folder per site (``site=s10``) and, for
dated tables, per year below it.  A load writes each of the site's folders
whole and writes its audit row **last**: readers take only the sites whose
latest audit row says ``loaded``, so a load that died leaves nothing anyone
reads, and the same load run again replaces what it had written.  (The site's
folder is replaced as a whole; replacing only the partitions that the new rows
hold would leave years the new load no longer has.)

The audit log ``import/`` is only appended to: ``reset`` when a warehouse is
rebuilt, ``started`` and ``loaded`` for each site's load.

``write_clustered`` lays a table out for repeated person joins: partitioned by
year and bucketed (and sorted) by person, so two such tables join without an
exchange and year views read their years only.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import check_prefixes
from .io import import_audit_row, path_exists

AUDIT = "import"
AUDIT_SCHEMA = ("import_date date, id_prefix string, source string, comment string, state string, "
                "recorded_at timestamp_ntz, seq long")
# the date a dated flat table is partitioned by
YEAR_OF = {"omrs_encounter": "encounter_date", "omrs_visit": "date_started", "omrs_obs": "obs_date",
           "omrs_obs_group": "obs_group_date", "omrs_program_enrollment": "enrollment_date", "omrs_program_state": "start_date"}


# ---------------------------------------------------------------- audit log

def _audit(spark: SparkSession, out: str) -> list:
    path = os.path.join(out, AUDIT)
    if not path_exists(spark, path):
        return []
    return spark.read.schema(AUDIT_SCHEMA).parquet(path).orderBy("seq").collect()   # a few rows a load


def record(spark: SparkSession, out: str, prefix: str | None, source: str, state: str, comment: str = "refresh") -> None:
    """Append one audit row."""
    seq = max((r["seq"] for r in _audit(spark, out)), default=0) + 1
    row = import_audit_row(spark, prefix, source, comment)
    row.select("import_date", F.col("id_prefix").cast("string").alias("id_prefix"), "source", "comment", F.lit(state).alias("state"),
               F.current_timestamp().cast("timestamp_ntz").alias("recorded_at"), F.lit(seq).cast("long").alias("seq")) \
        .coalesce(1).write.mode("append").parquet(os.path.join(out, AUDIT))


def loaded_sites(spark: SparkSession, out: str) -> list[str | None]:
    """Prefixes whose latest audit row since the last reset says ``loaded``."""
    state: dict = {}
    for r in _audit(spark, out):
        if r["state"] == "reset":
            state = {}
        else:
            state[r["id_prefix"]] = r["state"]
    return [p for p, s in state.items() if s == "loaded"]


def begin_load(spark: SparkSession, out: str, source: str, prefix: str | None, append: bool, replace: bool = False) -> list[str | None]:
    """Open a site's load and return the other sites that are loaded.  A site
    added to a warehouse needs a prefix that no other loaded site has and that
    is as long as theirs; ``replace`` loads a loaded site again."""
    if not append:
        record(spark, out, prefix, source, "reset")
        others: list[str | None] = []
    else:
        before = loaded_sites(spark, out)
        if prefix is None or None in before or (prefix in before and not replace):
            raise ValueError(f"a site added to a warehouse needs a prefix of its own, got {prefix!r} beside {before}")
        others = [p for p in before if p != prefix]
        check_prefixes([*others, prefix])
    record(spark, out, prefix, source, "started")
    return others


def finish_load(spark: SparkSession, out: str, source: str, prefix: str | None) -> None:
    record(spark, out, prefix, source, "loaded")


# ---------------------------------------------------------------- tables by site

def site_folder(prefix: str | None) -> str:
    return f"site=s{prefix or ''}"


def write_site_table(df: DataFrame, path: str, prefix: str | None, year_of: str | None = None) -> None:
    """Replace one site's rows of a shared table (by year of ``year_of``)."""
    target = os.path.join(path, site_folder(prefix))
    if year_of:
        df.withColumn("year", F.year(F.col(year_of))).write.mode("overwrite").partitionBy("year").parquet(target)
    else:
        df.write.mode("overwrite").parquet(target)


def read_site_table(spark: SparkSession, path: str, schema: StructType, prefixes: Iterable[str | None], by_year: bool = False,
                    keep_year: bool = False) -> DataFrame:
    """The rows of the given sites only; other folders are not read.  ``keep_year``
    keeps the partition column ``year``, whose filters prune folders."""
    folders = [f for f in (os.path.join(path, site_folder(p)) for p in prefixes) if path_exists(spark, f)]
    full = StructType(list(schema.fields)).add("year", "integer") if by_year else schema
    if not folders:
        return spark.createDataFrame([], full if keep_year else schema)
    df = spark.read.schema(full).option("basePath", path).parquet(*folders)
    return df.select(*schema.names, *(["year"] if by_year and keep_year else []))


def read_warehouse_table(spark: SparkSession, out: str, layer: str, name: str, schema: StructType, keep_year: bool = False) -> DataFrame:
    """A shared table as a user of the warehouse reads it: loaded sites only."""
    return read_site_table(spark, os.path.join(out, layer, name), schema, loaded_sites(spark, out), name in YEAR_OF, keep_year)


# ---------------------------------------------------------------- clustered copies

def write_clustered(df: DataFrame, name: str, path: str, key: str, buckets: int, year_of: str | None = None) -> DataFrame:
    """``df`` as an external table bucketed and sorted by ``key``,
    partitioned by the year of ``year_of``; returns the table.

    One task writes one bucket (one file a year), so the number of files is
    ``buckets`` x years.  Tables of one bucket count join on ``key`` without an
    exchange.  A key that holds a large share of the rows stays in one bucket:
    use the layout for person keys, not for sites or concepts."""
    spark = df.sparkSession
    if year_of:
        df = df.withColumn("year", F.year(F.col(year_of)))
    w = df.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key)
    if year_of:
        w = w.partitionBy("year")
    w.saveAsTable(name)
    return spark.table(name)


def open_clustered(spark: SparkSession, name: str, path: str, schema: StructType, key: str, buckets: int, by_year: bool = False) -> DataFrame:
    """Declare a clustered copy written by another session and return it."""
    fields: Sequence[str] = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    part = "PARTITIONED BY (year) " if by_year else ""
    cols = ", ".join([*fields, *(["year INT"] if by_year else [])])
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({cols}) USING parquet {part}CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    if by_year:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)

"""Sources and sinks.

Reads declare their columns and filters so Catalyst prunes the parquet scan
(``ReadSchema``) and pushes predicates (``PushedFilters``).  Writes replace
whole tables (every refresh is a rebuild) or append; a layer boundary writes
parquet so later layers and a lost executor re-read it instead of recomputing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, cols: Sequence[str] | None = None, where: Column | str | None = None,
               fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """Scan one table with a column list and a filter (both pushed into the scan)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    if cols:
        df = df.select(*cols)
    if where is not None:
        df = df.where(where)
    return df


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None, lower: int = 0,
              upper: int = 0, num_partitions: int = 1, **options) -> DataFrame:
    """S1 against a live relational source: split the read on a numeric key so
    each executor pulls one range (credentials come from the caller's options)."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def read_csv(spark: SparkSession, path: str, schema: StructType, date_format: str = "M/d/yyyy",
             strip_quotes: Sequence[str] = ()) -> DataFrame:
    """Header, comma, quote; typed fields with an explicit date format.
    Values wrapped in single quotes (the value-map files) are unwrapped."""
    df = (spark.read.option("header", True).option("quote", '"').option("dateFormat", date_format)
          .option("mode", "FAILFAST").schema(schema).csv(path))
    for c in strip_quotes:
        df = df.withColumn(c, F.regexp_replace(F.trim(F.col(c)), r"^'(.*)'$", "$1"))
    return df


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """S3: a constant table (dimension literals, value maps)."""
    return spark.createDataFrame(list(rows), schema)


def generate_ids(spark: SparkSession, start: int, step: int, n: int, prefix: str, width: int) -> DataFrame:
    """``prefix`` + zero-padded sequence ids (``a0001`` ...), generated in
    parallel.  An id longer than ``width`` keeps all its digits."""
    text = F.col("id").cast("string")
    padded = F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
    return spark.range(start, start + step * n, step).select(F.concat(F.lit(prefix), padded).alias("site"))


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows (each task commits its own files; a failed task's
    output is discarded by the commit protocol, so retries do not duplicate)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_table(df: DataFrame, path: str, columns: Sequence[str] | None = None,
                    partition_by: Sequence[str] = ()) -> None:
    """Replace a table with a declared column list."""
    out = df.select(*columns) if columns else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in the file system its scheme names (the session's default without one)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def existing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """S8 probe: keep only site paths that exist (the ETL skipped absent sites)."""
    return [p for p in paths if path_exists(spark, p)]


def read_sites(spark: SparkSession, site_paths: dict[str, str], site_col: str = "site_id") -> DataFrame | None:
    """One DataFrame over every existing site copy of a table, tagged with its site."""
    from ..operators.sets import union_sites
    frames = [(site, spark.read.parquet(p)) for site, p in site_paths.items() if path_exists(spark, p)]
    return union_sites(frames, site_col) if frames else None


def import_audit_row(spark: SparkSession, prefix: str, source: str, comment: str, counts: DataFrame | None = None) -> DataFrame:
    """One audit row per load: date, prefix, source, comment (+ row counts when given)."""
    row = spark.range(1).select(F.current_date().alias("import_date"), F.lit(prefix).alias("id_prefix"),
                                F.lit(source).alias("source"), F.lit(comment).alias("comment"))
    return row.crossJoin(counts) if counts is not None else row


def year_slice(df: DataFrame, date_col: str, year: int, year_col: str | None = None) -> DataFrame:
    """One calendar year as a half-open date range.  ``year_col`` names the
    column the table is partitioned by: only that year's folders are read, and
    the column is left out."""
    rows = df.where((F.col(date_col) >= F.lit(f"{year}-01-01").cast("date")) &
                    (F.col(date_col) < F.lit(f"{year + 1}-01-01").cast("date")))
    return rows.where(F.col(year_col) == year).drop(year_col) if year_col else rows


def register_year_views(df: DataFrame, date_col: str, years: Sequence[int], prefix: str, year_col: str | None = None) -> list[str]:
    """``<prefix>_<year>`` temporary views."""
    names = []
    for y in years:
        name = f"{prefix}_{y}"
        year_slice(df, date_col, y, year_col).createOrReplaceTempView(name)
        names.append(name)
    return names

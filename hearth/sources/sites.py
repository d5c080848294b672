"""Many site copies of one source read as one dataset.

Site folders ``root/<site>/<table>`` (a site is a letter and a number, such as
``a0406``) are read by one scan per table, whatever the number of sites; the
site's number comes from the file path.  Ids are unique within a site only, so
every id column becomes one long for (site, id) -- ``number * ID_SPAN + id`` --
and every uuid carries its site.  The flat layer then runs once over all sites:
each of its joins is a join on (site, id), and a site's lookups decode that
site's rows only.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SOURCE, struct

ID_SPAN = 10 ** 13                         # ids of a site are smaller than this
NOT_IDS = {"concept_name_tag_id"}          # compared with a constant, never joined
# a location's facility, and the person attribute that names a person's location
UNIFY_SOURCE = {"location_fosa": "location_id long, fosa_id string"}

_SITE = re.compile(r"[A-Za-z]+(\d+)")


def site_code(site: str) -> str:
    """The digits of a site's folder name (``a0406``: ``0406``)."""
    m = _SITE.fullmatch(site)
    if not m or len(m.group(1)) > 5:
        raise ValueError(f"a site is letters and at most five digits, got {site!r}")
    return m.group(1)


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [s.getPath().toString() for s in found or ()]


def present_sites(spark: SparkSession, root: str, sites: Sequence[str]) -> list[str]:
    """The listed sites that have a folder under ``root`` (one listing; the others are skipped, as the source job does)."""
    here = {p.rstrip("/").rsplit("/", 1)[-1] for p in _glob(spark, f"{root}/*")}
    found = [s for s in dict.fromkeys(sites) if s in here]
    codes = [site_code(s) for s in found]
    if len({len(c) for c in codes}) > 1 or len({int(c) for c in codes}) < len(codes):
        raise ValueError("site numbers must be distinct and of one length")
    return found


def _keyed(site: Column, value: Column) -> Column:
    inside = (value >= 0) & (value < ID_SPAN)
    return F.when(value.isNotNull(), F.when(inside, site * F.lit(ID_SPAN) + value).otherwise(
        F.raise_error(F.concat(F.lit("id outside the span of a site: "), value.cast("string")))))


def site_of(key: Column) -> Column:
    return F.floor(key / F.lit(ID_SPAN)).cast("long")


def own_id(key: Column) -> Column:
    """The id inside its site."""
    return key % F.lit(ID_SPAN)


def keyed_to_site(df: DataFrame, site: str = "__site") -> DataFrame:
    """Every long column as a (site, id) key and every uuid with its site."""
    out = []
    for f in df.schema.fields:
        if f.name == site:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.LongType) and f.name not in NOT_IDS:
            c = _keyed(F.col(site), c)
        elif f.name == "uuid":
            c = F.concat(F.col(site).cast("string"), F.lit("|"), c)
        out.append(c.alias(f.name))
    return df.select(*out)


def read_site_table(spark: SparkSession, root: str, sites: Sequence[str], table: str, optional: bool = False) -> DataFrame:
    """One table of all ``sites`` by one scan, keyed by (site, id).  A table that
    a site lacks is an error unless it is optional; then the site has no rows in it."""
    schema = struct({**SOURCE, **UNIFY_SOURCE}[table])
    if not sites:
        return spark.createDataFrame([], schema)
    pattern = f"{root}/{{{','.join(sites)}}}/{table}"
    found = {p.rstrip("/").rsplit("/", 2)[-2] for p in _glob(spark, pattern)}
    if not optional and set(sites) - found:
        raise FileNotFoundError(f"table {table} is missing at {sorted(set(sites) - found)}")
    if not found:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(pattern)
    number = F.regexp_extract(F.col("_metadata.file_path"), rf"^.*/[A-Za-z]+(\d+)/{re.escape(table)}/", 1).cast("long")
    return keyed_to_site(df.withColumn("__site", number))


def read_all_sites(spark: SparkSession, root: str, sites: Sequence[str], tables: Sequence[str], optional=()):
    """The named tables of every present site as a lazy mapping (a table is listed and planned when first used)."""
    from ..plans.lazy import LazyTables
    here = present_sites(spark, root, sites)
    if not here:
        raise FileNotFoundError(f"none of the {len(sites)} sites has a folder under {root}")
    return LazyTables({t: (lambda _, t=t: read_site_table(spark, root, here, t, t in optional)) for t in tables})


def read_site_list(spark: SparkSession, path: str) -> list[str]:
    """The site names of a one-column list with a header (one short row a site)."""
    return [r[0].strip() for r in spark.read.option("header", True).csv(path).collect() if r[0] and r[0].strip()]

"""Warehouse refresh: source tables -> flat layer -> star schema -> country mart.

    python -m hearth.refresh --source DIR --out DIR [--country malawi|rwanda|liberia] [--prefix 10]
                             [--append [--replace]] [--buckets N]
                             [--periods-from 2016-01-01 --periods-to 2018-12-31 | --periods-file CSV]
                             [--concepts name,name | --concepts-file CSV]
                             [--program-map CSV --encounter-type-map CSV]
                             [--anonymise --release-key-file FILE] [--optional-tables name,name]
    python -m hearth.refresh --source DIR --out DIR --sites LIST.csv [--anonymise --release-key-file FILE]

Each source table is read from ``DIR/<table>`` (parquet, any file system Spark
reads).  A table that is missing is an error unless it is named optional; an
optional table that is missing is empty.  Every layer is
written under ``--out`` (one folder per table) and the next layer reads the
written tables back, so layer edges cut lineage: a lost executor recomputes at
most one layer.  The order is fixed by data dependencies (lookups and flat
tables, then star and mart), not by a scheduler.

A site's rows stand in folders of their own and its audit row is written last
(``sources.warehouse``): a load that died is not read by anyone and is simply
run again.  ``--append`` adds a site, ``--append --replace`` loads it again.

``--sites`` loads many site copies ``DIR/<site>/<table>`` by one plan into
``--out/unified`` (``plans.unify``), with the cohort of the HIV programmes in
``--out/cohort``.

A de-identified copy needs a key of its own (``--release-key-file``): ids are
keyed hashes, alike in all tables of a release and different in the next.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .schemas import FLAT, LIBERIA_SOURCE, RWANDA_SOURCE, SOURCE, struct
from .sources import overwrite_table, path_exists, read_csv
from .sources import warehouse as W
from .sources.sites import read_site_list

PERIODS = "period_id int, start_date date, end_date date"
VALUE_MAP = "source string, target string"

# the person that rows of a clustered copy are bucketed by
CLUSTER_KEY = "patient_id"


def read_source(spark: SparkSession, root: str, names, optional=()) -> dict:
    """The named source tables under ``root``.  Of the ``optional`` ones
    those that are missing are empty; any other missing table is an error."""
    out = {}
    schemas = {**SOURCE, **RWANDA_SOURCE, **LIBERIA_SOURCE}
    for name in names:
        path = os.path.join(root, name)
        if name in optional and not path_exists(spark, path):
            out[name] = spark.createDataFrame([], struct(schemas[name]))
        else:
            out[name] = spark.read.parquet(path)
    return out


def write_layer(spark: SparkSession, tables, root: str, skip=(), shared: dict | None = None) -> dict:
    """Replace each table under ``root`` and return the written tables read
    back.  ``shared``: {"names", "prefix", "sites"} -- tables that hold a folder
    per site: only this site's is replaced, and the given sites are read."""
    written = {}
    shared = shared or {"names": ()}
    for name in list(tables):
        if name in skip:
            continue
        path, df = os.path.join(root, name), tables[name]
        if name in shared["names"]:
            schema = df.schema
            W.write_site_table(df, path, shared["prefix"], W.YEAR_OF.get(name))
            written[name] = W.read_site_table(spark, path, schema, shared["sites"], name in W.YEAR_OF)
        else:
            overwrite_table(df, path)
            written[name] = spark.read.parquet(path)
    return written


def read_periods(spark: SparkSession, path: str):
    """Periods from a file with a header: start and end date (more columns may follow), numbered by end date."""
    rows = spark.read.option("header", True).csv(path).select(F.to_date("start_date").alias("start_date"),
                                                             F.to_date("end_date").alias("end_date"))
    found = sorted((r["end_date"], r["start_date"]) for r in rows.collect())   # a parameter file
    return spark.createDataFrame([(i, s, e) for i, (e, s) in enumerate(found)], PERIODS)


def read_names(spark: SparkSession, path: str) -> list[str]:
    """The first column of a parameter file with a header."""
    return [r[0] for r in spark.read.option("header", True).csv(path).collect() if r[0]]


def clustered(spark: SparkSession, flat: dict, out: str, buckets: int) -> dict:
    """Person-keyed flat tables bucketed by person and partitioned by year under
    ``out/clustered``: the marts join them without exchanges."""
    done = dict(flat)
    for name in FLAT:
        if CLUSTER_KEY in flat[name].columns:
            path, table = os.path.join(out, "clustered", name), f"clustered_{name}"
            spark.sql(f"DROP TABLE IF EXISTS `{table}`")
            df = W.write_clustered(flat[name], table, path, CLUSTER_KEY, buckets, W.YEAR_OF.get(name))
            done[name] = df.select(*flat[name].columns)
    return done


def refresh(spark: SparkSession, source: str, out: str, country: str = "malawi", prefix: str | None = None,
            periods_from: str | None = None, periods_to: str | None = None, anonymise: bool = False,
            optional=(), append: bool = False, concepts=(), replace: bool = False, release_key: bytes | None = None,
            periods_file: str | None = None, buckets: int | None = None, program_map: str | None = None,
            encounter_type_map: str | None = None) -> dict:
    from .operators import quarter_periods
    from .plans.flat import FlatConfig, build_flat
    from .plans.star import build_star

    if anonymise and not release_key:
        raise ValueError("a de-identified copy needs a release key")
    others = W.begin_load(spark, out, source, prefix, append, replace)
    sites = [*others, prefix]
    src = read_source(spark, source, SOURCE, optional)
    tables = build_flat(src, FlatConfig(prefix=prefix))
    if country == "rwanda" and program_map and encounter_type_map:
        from .plans.rwanda import easternize
        maps = [read_csv(spark, m, struct(VALUE_MAP), strip_quotes=("source", "target")) for m in (program_map, encounter_type_map)]
        tables = easternize(tables, *maps)
    flat = write_layer(spark, tables, os.path.join(out, "flat"), shared={"names": set(FLAT), "prefix": prefix, "sites": sites})
    star_root = os.path.join(out, "star")

    def stored(name, df):
        overwrite_table(df, os.path.join(star_root, name))
        return spark.read.parquet(os.path.join(star_root, name))

    dims = build_star(spark, flat, stored)
    star = {name: dims[name] if name.startswith("dim_") else stored(name, dims[name]) for name in dims}
    marts_from = clustered(spark, flat, out, buckets) if buckets else flat
    periods = read_periods(spark, periods_file) if periods_file else \
        quarter_periods(spark, periods_from, periods_to) if periods_from and periods_to else None
    mart, mart_root = {}, os.path.join(out, "mart")
    if country == "malawi":
        from .plans.malawi import build_malawi
        mart = write_layer(spark, build_malawi(spark, marts_from, periods, *([concepts] if concepts else [])), mart_root)
    elif country == "rwanda":
        from .plans import rwanda as rw
        rsrc = {**src, **read_source(spark, source, RWANDA_SOURCE, optional)}
        tables = {"rw_location": rw.rw_location(rsrc, prefix), "rw_order": rw.rw_order(rsrc, flat, prefix),
                  "rw_order_group": rw.rw_order_group(rsrc, prefix), "rw_onc_diagnosis": rw.rw_onc_diagnosis(marts_from),
                  "rw_calculated_visit": rw.rw_calculated_visit(marts_from), "rw_bill": rw.rw_bill(rsrc),
                  "rw_payment": rw.rw_payment(rsrc), "rw_refund": rw.rw_refund(rsrc),
                  "rw_insurance_policy": rw.rw_insurance_policy(rsrc),
                  "rw_patient_service": rw.rw_patient_service(rsrc), "pdc_z_score_input": rw.pdc_z_score_input(marts_from),
                  "rw_program_enrollment": rw.rw_pdc_malnutrition_program(marts_from)[1],
                  "rw_import_metadata": rw.rw_import_metadata(spark, source, country, int(prefix) if prefix else None, "refresh")}
        if periods is not None:
            tables["rw_last_vl_include_blanks"] = rw.rw_last_vl_include_blanks(marts_from, periods)
            if concepts:
                tables["rw_last_obs_in_period"] = rw.rw_last_obs_in_period(marts_from, list(concepts), periods)
        # what comes from the site's own source stands by site, what comes from the flat layer is rebuilt
        own = {"rw_location", "rw_order", "rw_order_group", "rw_bill", "rw_payment", "rw_refund", "rw_insurance_policy",
               "rw_patient_service", "rw_import_metadata"}
        mart = write_layer(spark, tables, mart_root, shared={"names": own, "prefix": prefix, "sites": sites})
    elif country == "liberia":
        from .plans import liberia as lb
        lsrc = {**src, **read_source(spark, source, LIBERIA_SOURCE, optional)}
        tables = {"mh_encounter": lb.mh_encounter(lsrc, prefix=prefix), "rx_prescriptions": lb.rx_prescriptions(lsrc),
                  "program_statistics": lb.program_statistics(lsrc), "program_enrollment": lb.program_enrollment(lsrc)}
        mart = write_layer(spark, tables, mart_root, shared={"names": set(tables), "prefix": prefix, "sites": sites})
    result = {"flat": flat, "star": star, "mart": mart}
    if anonymise:
        from .plans.anonymise import anonymise_warehouse
        result["anonymised"] = write_layer(spark, anonymise_warehouse({**flat, **mart}, key=release_key), os.path.join(out, "anonymised"))
    W.finish_load(spark, out, source, prefix)
    return result


def refresh_sites(spark: SparkSession, source: str, out: str, sites, optional=(), release_key: bytes | None = None,
                  anonymise: bool = False) -> dict:
    """X3, X5, X6 (and X2 with ``anonymise``): all site copies under ``source`` by one plan."""
    from .plans.anonymise import anonymise_unified
    from .plans.unify import retain_hiv_cohort, unified
    if anonymise and not release_key:
        raise ValueError("a de-identified copy needs a release key")
    tables = write_layer(spark, unified(spark, source, sites, optional=optional), os.path.join(out, "unified"))
    omrs = {k: v for k, v in tables.items() if k.startswith("omrs_")}
    kept = retain_hiv_cohort(omrs)
    result = {"unified": tables, "cohort": write_layer(spark, kept, os.path.join(out, "cohort"))}
    if anonymise:
        result["anonymised"] = write_layer(spark, anonymise_unified(result["cohort"], key=release_key), os.path.join(out, "anonymised"))
    W.record(spark, out, None, source, "loaded", f"{len(sites)} sites listed")
    return result


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--source", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--country", default="malawi", choices=["malawi", "rwanda", "liberia", "none"])
    ap.add_argument("--prefix", default=None)
    ap.add_argument("--sites", default=None, help="load the site copies named in this list (one column with a header)")
    ap.add_argument("--periods-from", default=None)
    ap.add_argument("--periods-to", default=None)
    ap.add_argument("--periods-file", default=None, help="periods as a file with start_date and end_date")
    ap.add_argument("--anonymise", action="store_true")
    ap.add_argument("--release-key-file", default=None, help="file holding the secret of this release")
    ap.add_argument("--append", action="store_true", help="add a site to the warehouse (its own --prefix)")
    ap.add_argument("--replace", action="store_true", help="with --append: load a site that is loaded again")
    ap.add_argument("--buckets", type=int, default=None, help="also write person-keyed tables bucketed by person")
    ap.add_argument("--concepts", default="", help="concepts of the last-observation snapshot, comma-separated")
    ap.add_argument("--concepts-file", default=None)
    ap.add_argument("--program-map", default=None, help="value map of programme names (source, target)")
    ap.add_argument("--encounter-type-map", default=None)
    ap.add_argument("--optional-tables", default="", help="source tables that may be missing, comma-separated")
    ap.add_argument("--total-cores", type=int, default=None)
    a = ap.parse_args(argv)
    from .session import get_session
    spark = get_session(total_cores=a.total_cores)
    key = None
    if a.release_key_file:
        with open(a.release_key_file, "rb") as f:
            key = f.read().strip()
    optional = tuple(x for x in a.optional_tables.split(",") if x)
    if a.sites:
        refresh_sites(spark, a.source, a.out, read_site_list(spark, a.sites), optional, key, a.anonymise)
        return
    concepts = tuple(x for x in a.concepts.split(",") if x) or (tuple(read_names(spark, a.concepts_file)) if a.concepts_file else ())
    refresh(spark, a.source, a.out, a.country, a.prefix, a.periods_from, a.periods_to, a.anonymise, optional, a.append, concepts,
            a.replace, key, a.periods_file, a.buckets, a.program_map, a.encounter_type_map)


if __name__ == "__main__":
    main()

"""Multi-site unification.

The source job loads ~400 site databases one after another.  ``unified`` reads
every table of all sites by one scan (``sources.sites``) and runs the flat
layer once, with (site, id) keys in every join, so the plan does not grow with
the number of sites.  Its tables carry ids as text, the site's code before the
site's id (string F20), and each row's facility: the newest health-centre
attribute (type 7) of the person, mapped through the location -> facility
table, else 0 (X4).  Cohort retention (X6) keeps only HIV-programme patients
plus HIV-typed or untyped encounters and observations.

``unify_sites`` unions flat layers that were built site by site.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as H
from .. import operators as O
from ..operators.sets import union_sites
from ..schemas import SOURCE
from ..sources import sites as S
from ..sources.sites import ID_SPAN, UNIFY_SOURCE, own_id, read_all_sites, site_of
from .flat import FlatConfig, build_flat
from .lazy import LazyTables

# Programme and encounter-type names that define the HIV cohort
# (programme list is a parameter; the source's misspelt paediatric name is corrected here).
HIV_PROGRAMS = ["HIV PROGRAM", "PMTCT Pregnancy", "PMTCT Combined Clinic - Mother", "PEDIATRIC HIV PROGRAM",
                "PMTCT Combined Clinic - Infant"]
HIV_ENCOUNTER_TYPES = ["Adult HIV", "ADULT INITIAL VISIT", "ADULT RETURN VISIT", "Exposed Infant", "HOME VISIT",
                       "Patient Transfer", "Pediatric HIV", "PEDIATRIC INITIAL VISIT", "PEDIATRIC RETURN VISIT"]
HEALTH_CENTRE_ATTRIBUTE_TYPE = 7

ID_COLUMNS = {
    "omrs_patient": ["patient_id"],
    "omrs_patient_identifier": ["patient_identifier_id", "patient_id"],
    "omrs_relationship": ["relationship_id", "patient_id"],
    "omrs_encounter_provider": ["encounter_provider_id", "encounter_id"],
    "omrs_encounter": ["encounter_id", "patient_id", "visit_id"],
    "omrs_visit": ["visit_id", "patient_id"],
    "omrs_obs": ["obs_id", "patient_id", "encounter_id", "obs_group_id"],
    "omrs_obs_group": ["obs_group_id", "patient_id", "encounter_id"],
    "omrs_program_enrollment": ["program_enrollment_id", "patient_id"],
    "omrs_program_state": ["program_state_id", "program_enrollment_id", "patient_id"],
}


def site_code(db_name: str) -> str:
    """the facility code is characters 1..5 (0-based, end exclusive) of the site database name."""
    return db_name[1:5]


def patient_fosa(person_attribute: DataFrame, location_fosa: DataFrame,
                 attribute_type: int = HEALTH_CENTRE_ATTRIBUTE_TYPE, by_site: bool = False) -> DataFrame:
    """Person -> facility via the newest health-centre attribute; unknown -> 0.
    ``by_site``: ids are (site, id) keys, and the attribute's text is an id of the person's site."""
    kind, value = F.col("person_attribute_type_id"), F.col("value")
    if by_site:
        kind = own_id(kind)
        value = (site_of(F.col("person_id")) * F.lit(ID_SPAN) + value.try_cast("long")).cast("string")
    a = person_attribute.where((kind == attribute_type) & ~F.coalesce(F.col("voided"), F.lit(False)))
    newest = O.latest_per_key(a, "person_id", "date_created", "person_attribute_id")
    lf = location_fosa.select(F.col("location_id").cast("string").alias("value"), "fosa_id")
    j = newest.select("person_id", value.alias("value")).join(lf, "value", "left")
    return j.select("person_id", F.coalesce(F.col("fosa_id").cast("string"), F.lit("0")).alias("fosa_id"))


def _as_text(df: DataFrame, name: str, width: int) -> DataFrame:
    """(site, id) keys as text: the site's code, then the id; uuids as they were; ``site_id`` in front."""
    ids, out, site = ID_COLUMNS[name], [], None
    for c in df.columns:
        if c in ids:
            code = F.lpad(site_of(F.col(c)).cast("string"), width, "0")
            site = code if site is None else F.coalesce(site, code)
            out.append(F.concat(code, own_id(F.col(c)).cast("string")).alias(c))
        elif c == "uuid" or c.endswith("_uuid"):
            out.append(F.regexp_replace(F.col(c), r"^\d+\|", "").alias(c))
        else:
            out.append(F.col(c))
    return df.select(site.alias("site_id"), *out)


def unified(spark: SparkSession, root: str, sites: Sequence[str], cfg: FlatConfig | None = None, optional=()) -> LazyTables:
    """The flat tables over every present site under ``root``, by one plan.

    Sites without a folder are skipped; a site that lacks a table which is not
    optional is an error.  Every table carries ``site_id`` (the code) and
    ``fosa_id`` (the person's facility, 0 if unknown)."""
    optional = {*optional, *UNIFY_SOURCE}
    src = read_all_sites(spark, root, sites, [*SOURCE, *UNIFY_SOURCE], optional)
    width = len(S.site_code(next(iter(sites))))   # present sites have codes of one length
    flat = build_flat(src, replace(cfg or FlatConfig(), prefix=None, id_span=ID_SPAN))

    def table(name):
        def build(t):
            df, person = flat[name], F.col("patient_id")
            if "patient_id" not in df.columns:
                encounters = src["encounter"].select("encounter_id", F.col("patient_id").alias("__person"))
                df, person = df.join(encounters, "encounter_id", "left"), F.col("__person")
            pf = t["__facility"].select(F.col("person_id").alias("__fp"), "fosa_id")
            df = df.join(pf, person == F.col("__fp"), "left").withColumn("fosa_id", F.coalesce("fosa_id", F.lit("0")))
            return _as_text(df.drop("__fp", "__person"), name, width)
        return build

    return LazyTables({"__facility": lambda t: patient_fosa(src["person_attribute"], src["location_fosa"], by_site=True),
                       **{name: table(name) for name in ID_COLUMNS},
                       "patient_facility": lambda t: patient_facility_pairs(t["omrs_encounter"])})


def tag_site(tables: dict[str, DataFrame], db_name: str, pf: DataFrame | None = None) -> dict[str, DataFrame]:
    """One site's flat tables with ids prefixed by the facility code (text) and
    a ``fosa_id`` column from the patient's facility (or the site code)."""
    code = site_code(db_name)
    out = {}
    for name, df in tables.items():
        x = df
        if pf is not None and "patient_id" in x.columns:
            x = x.join(pf.withColumnRenamed("person_id", "patient_id"), "patient_id", "left")
            x = x.withColumn("fosa_id", F.coalesce("fosa_id", F.lit(code)))
        else:
            x = x.withColumn("fosa_id", F.lit(code))
        for c in ID_COLUMNS.get(name, []):
            if c in x.columns:
                x = x.withColumn(c, H.prefix_id_text(c, code))
        out[name] = x
    return out


def unify_sites(sites: dict[str, dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """One table per name over all sites (sites absent from ``sites``
    are simply not loaded), rows tagged with ``site_id``."""
    names = sorted({n for t in sites.values() for n in t})
    out = {}
    for n in names:
        frames = [(site, t[n]) for site, t in sites.items() if n in t]
        out[n] = union_sites(frames, "site_id")
    return out


def retain_hiv_cohort(tables: dict[str, DataFrame], programs=HIV_PROGRAMS,
                      encounter_types=HIV_ENCOUNTER_TYPES) -> dict[str, DataFrame]:
    """X6 (P7): keep cohort patients everywhere; encounters and observations
    also stay when their type is an HIV type or null; obs groups stay when a
    kept observation refers to them."""
    cohort = (tables["omrs_program_enrollment"].where(H.ci_in("program", programs))
              .select("patient_id").distinct())
    out = dict(tables)
    for n in ("omrs_patient", "omrs_patient_identifier", "omrs_program_enrollment", "omrs_program_state",
              "omrs_relationship", "rw_order"):
        if n in tables:
            out[n] = O.retain_cohort(tables[n], "patient_id", cohort, "patient_id")
    for n in ("omrs_encounter", "omrs_obs"):
        if n in tables:
            out[n] = O.retain_cohort(tables[n], "patient_id", cohort, "patient_id", "encounter_type", encounter_types)
    if "omrs_obs_group" in tables and "omrs_obs" in out:
        used = out["omrs_obs"].where(F.col("obs_group_id").isNotNull()).select("obs_group_id").distinct()
        out["omrs_obs_group"] = tables["omrs_obs_group"].join(used, "obs_group_id", "left_semi")
    return out


def patient_facility_pairs(encounters: DataFrame) -> DataFrame:
    """X5 (A18): distinct (patient, facility) pairs seen on encounters."""
    return encounters.select("patient_id", "fosa_id").distinct()

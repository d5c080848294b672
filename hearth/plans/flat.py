"""Lookup tables and the flat ``omrs_*`` layer (L1-L5, O-PAT ... O-PST).

Input: a dict of source DataFrames keyed by source table name (see
``hearth.schemas.SOURCE``).  Output: a dict of flat tables conforming to
``hearth.schemas.FLAT``.  Lookups are dimension-sized; joins against them are
left to AQE, which broadcasts them when their measured size is small.  The
only shuffles on large tables are the person-keyed joins and the
best-per-key windows (each with a partial group limit before the shuffle).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as H
from .. import operators as O
from ..schemas import FLAT, conform


@dataclass(frozen=True)
class FlatConfig:
    """Per-country settings (the ETL's property files)."""
    prefix: str | None = None                  # site id prefix (F20); None = ids unchanged
    phone_attribute: str | None = "Cell Phone Number"
    mothers_name_attribute: str | None = "Mother's Name"
    fathers_name_attribute: str | None = None
    health_center_attribute: str | None = "Health Center"
    test_patient_attribute: str | None = "Test Patient"
    concept_locale: str = "en"
    id_span: int | None = None                 # ids are (site, id) keys of this span (sources.sites)


def _live(df: DataFrame) -> DataFrame:
    return df.where(~F.coalesce(F.col("voided"), F.lit(False)))


def _pid(c, cfg: FlatConfig):
    return H.prefix_id(c, cfg.prefix)


def _age(kind: str, birth, at):
    """F1 guarded: null unless both dates exist."""
    fn = H.full_years_between if kind == "years" else H.full_months_between
    return F.when(F.col(birth).isNull() | at.isNull(), F.lit(None).cast("long")).otherwise(fn(F.col(birth), at))


# ------------------------------------------------------------------ lookups

def lookup_concept(src: dict, locale: str = "en") -> DataFrame:
    """L1: one name per concept -- fully specified first, then the locale, then
    ``locale_preferred`` ascending (kept as the source orders it), then id."""
    names = _live(src["concept_name"])
    order = [H.ci_eq("concept_name_type", "FULLY_SPECIFIED").desc(), H.ci_eq("locale", locale).desc(),
             F.coalesce(F.col("locale_preferred"), F.lit(False)).asc(), F.col("concept_name_id").asc()]
    best = O.best_per_key(names, "concept_id", order)
    return src["concept"].join(best, "concept_id", "left").select(
        F.col("concept_id").alias("source_key"), F.col("name").alias("target_value"))


def lookup_concept_by_tag(src: dict, locale: str = "en", tag_id: int = 4) -> DataFrame:
    """Concept names for the older source version -- the locale first, then
    names carrying the given name tag, then the oldest name (then id)."""
    names = _live(src["concept_name"])
    tagged = src["concept_name_tag_map"].where(F.col("concept_name_tag_id") == tag_id) \
        .select("concept_name_id").distinct().withColumn("__tag", F.lit(True))
    names = names.join(tagged, "concept_name_id", "left")
    order = [H.ci_eq("locale", locale).desc(), F.coalesce(F.col("__tag"), F.lit(False)).desc(),
             F.col("date_created").asc_nulls_last(), F.col("concept_name_id").asc()]
    best = O.best_per_key(names, "concept_id", order)
    return src["concept"].join(best, "concept_id", "left").select(
        F.col("concept_id").alias("source_key"), F.col("name").alias("target_value"))


def lookup_simple(df: DataFrame, key: str, name: str = "name") -> DataFrame:
    """L2: id -> name."""
    return df.select(F.col(key).alias("source_key"), F.col(name).alias("target_value"))


def lookup_user(src: dict) -> DataFrame:
    """User id -> username, else system id."""
    return src["users"].select(F.col("user_id").alias("source_key"),
                               F.coalesce("username", "system_id").alias("target_value"))


def _best_name(src: dict) -> DataFrame:
    names = _live(src["person_name"])
    return O.best_per_key(names, "person_id", [F.coalesce(F.col("preferred"), F.lit(False)).desc(),
                                               F.col("date_created").desc(), F.col("person_name_id").desc()])


def lookup_person_name(src: dict) -> DataFrame:
    """L3: one name per person (preferred, then newest); last name joins prefix,
    family, family2 and suffix with spaces (nulls skipped)."""
    n = _best_name(src)
    p = src["person"].select("person_id", "uuid")
    return p.join(n, "person_id", "inner").select(
        "uuid", F.col("given_name").alias("first_name"), "middle_name",
        H.join_nonnull(" ", "family_name_prefix", "family_name", "family_name2", "family_name_suffix").alias("last_name"))


def lookup_provider_name(src: dict) -> DataFrame:
    """Person name > provider name > provider identifier > 'Unknown'
    (left join, so providers without a person name still fall back)."""
    n = _best_name(src).select("person_id", H.join_nonnull(
        " ", "given_name", "middle_name", "family_name_prefix", "family_name", "family_name2",
        "family_name_suffix").alias("__pname"))
    pr = src["provider"]
    j = pr.join(n, "person_id", "left")
    return j.select("uuid", H.name_fallback("__pname", "name", "identifier").alias("provider_name"))


def lookups(src: dict, cfg: FlatConfig = FlatConfig()):
    """L1-L4 as a lazy mapping: each lookup is built when first used."""
    from .lazy import LazyTables
    return LazyTables({
        "lookup_concept": lambda t: lookup_concept(src, cfg.concept_locale),
        "lookup_location": lambda t: lookup_simple(src["location"], "location_id"),
        "lookup_drug": lambda t: lookup_simple(src["drug"], "drug_id"),
        "lookup_encounter_type": lambda t: lookup_simple(src["encounter_type"], "encounter_type_id"),
        "lookup_form": lambda t: lookup_simple(src["form"], "form_id"),
        "lookup_identifier_type": lambda t: lookup_simple(src["patient_identifier_type"], "patient_identifier_type_id"),
        "lookup_visit_type": lambda t: lookup_simple(src["visit_type"], "visit_type_id"),
        "lookup_user": lambda t: lookup_user(src),
        "lookup_person_name": lambda t: lookup_person_name(src),
        "lookup_provider_name": lambda t: lookup_provider_name(src),
    })


def _decode(df, lk, on, out):
    return O.decode(df, lk, on, "source_key", "target_value", out)


def _decode_once(df, lk, on, out):
    """Where the source job aborts on a lookup key that stands twice."""
    return O.decode_or_abort(df, lk, on, "source_key", "target_value", out)


# ------------------------------------------------------------------ flat tables

def omrs_patient(src: dict, lk: dict, cfg: FlatConfig = FlatConfig()) -> DataFrame:
    """O-PAT: one row per live patient with name, identifier, address and
    configured attributes; test patients (flag true) removed, null flag kept."""
    person = src["person"]
    base = (_live(src["patient"]).select("patient_id", F.col("date_created").alias("__created"))
            .join(_live(person), F.col("patient_id") == F.col("person_id"), "inner"))
    base = base.select(
        "patient_id", F.col("uuid").alias("patient_uuid"), "gender", "birthdate", "birthdate_estimated", "dead",
        "death_date", _age("years", "birthdate", F.col("death_date")).alias("age_years_at_death"),
        _age("months", "birthdate", F.col("death_date")).alias("age_months_at_death"),
        "cause_of_death", F.to_date("__created").alias("date_created"))
    base = _decode(base, lk["lookup_concept"], "cause_of_death", "__cod").drop("cause_of_death") \
        .withColumnRenamed("__cod", "cause_of_death")

    # names by person id (the same rule as the name lookup), so every per-person join shares one key
    names = _best_name(src).select(
        F.col("person_id").alias("__np"), F.col("given_name").alias("first_name"), "middle_name",
        H.join_nonnull(" ", "family_name_prefix", "family_name", "family_name2", "family_name_suffix").alias("last_name"))
    ident = O.best_per_key(_live(src["patient_identifier"]), "patient_id",
                           [F.coalesce(F.col("preferred"), F.lit(False)).desc(), F.col("date_created").desc(),
                            F.col("patient_identifier_id").desc()]).select(
        F.col("patient_id").alias("__ip"), "identifier")
    addr_cols = ["country", "postal_code", "state_province", "county_district", "city_village", "address1",
                 "address2", "address3", "address4", "address5", "address6", "latitude", "longitude"]
    addr = O.best_per_key(_live(src["person_address"]), "person_id",
                          [F.coalesce(F.col("preferred"), F.lit(False)).desc(), F.col("date_created").desc(),
                           F.col("person_address_id").desc()]).select(F.col("person_id").alias("__ap"), *addr_cols)

    attr_map = {"phone_number": cfg.phone_attribute, "mothers_name": cfg.mothers_name_attribute,
                "fathers_name": cfg.fathers_name_attribute, "health_center": cfg.health_center_attribute,
                "__test": cfg.test_patient_attribute}
    wanted = {k: v for k, v in attr_map.items() if v}
    attrs = (_live(src["person_attribute"]).join(src["person_attribute_type"], "person_attribute_type_id")
             .select("person_id", "name", "value", "date_created", "person_attribute_id"))
    piv = O.pivot_attributes(attrs, ["person_id"], "name", "value", sorted(set(wanted.values())),
                             [F.col("date_created").desc(), F.col("person_attribute_id").desc()])
    piv = piv.select(F.col("person_id").alias("__tp"),
                     *[F.col(f"`{v}`").alias(k) for k, v in wanted.items()])

    out = (base.join(names, F.col("patient_id") == F.col("__np"), "left")
           .join(ident, F.col("patient_id") == F.col("__ip"), "left")
           .join(addr, F.col("patient_id") == F.col("__ap"), "left")
           .join(piv, F.col("patient_id") == F.col("__tp"), "left"))
    if "health_center" in wanted:
        # the attribute's text is a location's id; any other text stays as it is
        center = F.col("health_center").try_cast("long")
        if cfg.id_span:
            center = F.floor(F.col("patient_id") / cfg.id_span).cast("long") * F.lit(cfg.id_span) + center
        out = out.withColumn("__hc", center)
        out = _decode(out, lk["lookup_location"], "__hc", "__hc_name").withColumn(
            "health_center", F.coalesce("__hc_name", "health_center"))
    if "__test" in wanted:
        out = O.exclude_flag_null_kept(out, H.fold("__test") == F.lit("true"))
    out = out.withColumn("patient_id", _pid("patient_id", cfg))
    return conform(out, FLAT["omrs_patient"])


def omrs_patient_identifier(src: dict, lk: dict, cfg: FlatConfig = FlatConfig()) -> DataFrame:
    """O-PID: every live identifier of a live patient; blank identifiers dropped."""
    pat = _live(src["patient"]).select(F.col("patient_id").alias("__p"))
    ids = O.require_not_null(_live(src["patient_identifier"]), ["identifier"], non_blank=["identifier"])
    ids = ids.join(pat, F.col("patient_id") == F.col("__p"), "left_semi")
    ids = _decode_once(ids, lk["lookup_identifier_type"], "identifier_type", "type")
    ids = _decode_once(ids, lk["lookup_location"], "location_id", "location")
    out = ids.select(_pid("patient_identifier_id", cfg).alias("patient_identifier_id"), "uuid",
                     _pid("patient_id", cfg).alias("patient_id"), "type", "identifier", "location",
                     F.to_date("date_created").alias("date_created"))
    return conform(out, FLAT["omrs_patient_identifier"])


def omrs_relationship(src: dict, lk: dict, cfg: FlatConfig = FlatConfig()) -> DataFrame:
    """O-REL (J15): one row per side that is a live patient, roles swapped for the B side;
    the related person is named from the name lookup."""
    rel = _live(src["relationship"]).where(F.col("person_a").isNotNull() & F.col("person_b").isNotNull())
    rt = src["relationship_type"]
    live_person = _live(src["person"]).select("person_id", "uuid")
    live_patient = _live(src["patient"]).select("patient_id")
    pname = lk["lookup_person_name"].select(
        F.col("uuid").alias("__ruuid"), H.join_nonnull(" ", "first_name", "middle_name", "last_name").alias("related_person"))
    r = rel.join(rt, rel["relationship"] == rt["relationship_type_id"])

    def side(me, other, my_role, other_role):
        x = (r.where(F.col(my_role).isNotNull())
             .select("relationship_id", "uuid", F.col(me).alias("patient_id"), F.col(my_role).alias("patient_role"),
                     F.col(other_role).alias("related_person_role"), F.col(other).alias("__other"),
                     "start_date", "end_date", F.to_date("date_created").alias("date_created")))
        x = x.join(live_patient, "patient_id", "left_semi").join(
            live_person.select(F.col("person_id").alias("patient_id")), "patient_id", "left_semi")
        op = live_person.select(F.col("person_id").alias("__other"), F.col("uuid").alias("__ruuid"))
        return x.join(op, "__other", "inner").join(pname, "__ruuid", "left")

    both = side("person_a", "person_b", "a_is_to_b", "b_is_to_a").unionByName(
        side("person_b", "person_a", "b_is_to_a", "a_is_to_b"))
    both = both.withColumn("relationship_id", _pid("relationship_id", cfg)).withColumn(
        "patient_id", _pid("patient_id", cfg))
    return conform(both, FLAT["omrs_relationship"])


def omrs_encounter_provider(src: dict, lk: dict, cfg: FlatConfig = FlatConfig()) -> DataFrame:
    """O-EPR: live encounter-provider links with provider name and role."""
    ep = _live(src["encounter_provider"])
    enc = _live(src["encounter"]).select(F.col("encounter_id").alias("__e"), F.col("uuid").alias("encounter_uuid"))
    j = ep.join(enc, F.col("encounter_id") == F.col("__e"), "inner")
    prov = src["provider"].select(F.col("provider_id").alias("__pr"), F.col("uuid").alias("__pruuid"))
    j = j.join(prov, F.col("provider_id") == F.col("__pr"), "left")
    pn = lk["lookup_provider_name"].select(F.col("uuid").alias("__pruuid"), F.col("provider_name").alias("provider"))
    j = j.join(pn, "__pruuid", "left")
    j = O.decode(j, src["encounter_role"], "encounter_role_id", "encounter_role_id", "name", "provider_role")
    out = j.select(_pid("encounter_provider_id", cfg).alias("encounter_provider_id"), "uuid",
                   _pid("encounter_id", cfg).alias("encounter_id"), "encounter_uuid", "provider", "provider_role")
    return conform(out, FLAT["omrs_encounter_provider"])


def omrs_encounter(src: dict, lk: dict, providers: DataFrame, cfg: FlatConfig = FlatConfig()) -> DataFrame:
    """O-ENC: live encounters of live persons, decoded, with ages and one
    provider per encounter (A1: the smallest encounter-provider id)."""
    person = _live(src["person"]).select(F.col("person_id").alias("__pp"), F.col("birthdate").alias("__bd"))
    e = _live(src["encounter"]).join(person, F.col("patient_id") == F.col("__pp"), "inner")
    e = e.select("encounter_id", "uuid", "patient_id", "encounter_type", "form_id", "location_id", "visit_id",
                 H.date_part("encounter_datetime").alias("encounter_date"),
                 H.time_part("encounter_datetime").alias("encounter_time"),
                 _age("years", "__bd", F.col("encounter_datetime")).alias("age_years_at_encounter"),
                 _age("months", "__bd", F.col("encounter_datetime")).alias("age_months_at_encounter"),
                 F.to_date("date_created").alias("date_created"), "creator")
    e = _decode(e, lk["lookup_encounter_type"], "encounter_type", "__etype").drop("encounter_type") \
        .withColumnRenamed("__etype", "encounter_type")
    e = _decode(e, lk["lookup_form"], "form_id", "form")
    e = _decode(e, lk["lookup_location"], "location_id", "location")
    e = _decode(e, lk["lookup_user"], "creator", "created_by")
    one = O.any_per_key(providers, "encounter_uuid", "encounter_provider_id").select(
        F.col("encounter_uuid").alias("uuid"), "provider", "provider_role")
    e = e.join(one, "uuid", "left")
    out = e.withColumn("encounter_id", _pid("encounter_id", cfg)).withColumn("patient_id", _pid("patient_id", cfg)) \
        .withColumn("visit_id", _pid("visit_id", cfg))
    return conform(out, FLAT["omrs_encounter"])


def omrs_visit(src: dict, lk: dict, cfg: FlatConfig = FlatConfig()) -> DataFrame:
    """O-VIS: live visits with type and location names."""
    v = _live(src["visit"])
    v = _decode(v, lk["lookup_visit_type"], "visit_type_id", "visit_type")
    v = _decode(v, lk["lookup_location"], "location_id", "location")
    out = v.select(_pid("visit_id", cfg).alias("visit_id"), "uuid", _pid("patient_id", cfg).alias("patient_id"),
                   "visit_type", "location", F.to_date("date_started").alias("date_started"),
                   F.to_date("date_stopped").alias("date_stopped"), F.to_date("date_created").alias("date_created"))
    return conform(out, FLAT["omrs_visit"])


def omrs_obs_and_groups(src: dict, lk: dict, cfg: FlatConfig = FlatConfig()) -> tuple[DataFrame, DataFrame]:
    """O-OBS: live observations of live persons, decoded, split (P6) into
    group headers (obs that are some other obs' group) and value rows."""
    person = _live(src["person"]).select(F.col("person_id").alias("__pp"), F.col("birthdate").alias("__bd"))
    enc = src["encounter"].select(F.col("encounter_id").alias("__e"), F.col("encounter_type").alias("__et"),
                                  F.col("location_id").alias("__loc"), F.col("form_id").alias("__form"))
    obs = _live(src["obs"]).withColumn("uuid", H.packed_uuid("uuid"))
    groups = obs.where(F.col("obs_group_id").isNotNull()).select(F.col("obs_group_id").alias("__gid")).distinct() \
        .withColumn("is_obs_group", F.lit(True))
    # split first: the later joins then move only the rows of one side
    flagged = obs.join(groups, F.col("obs_id") == F.col("__gid"), "left").drop("__gid") \
        .withColumn("is_obs_group", F.coalesce("is_obs_group", F.lit(False)))

    def decoded(o: DataFrame) -> DataFrame:
        o = O.left_join_nulls_apart(o.join(person, F.col("person_id") == F.col("__pp"), "inner"), enc, "encounter_id", "__e", "obs_id")
        o = o.select("obs_id", H.unpacked_uuid("uuid").alias("uuid"), F.col("person_id").alias("patient_id"), "encounter_id", "concept_id",
                     H.date_part("obs_datetime").alias("obs_date"), H.time_part("obs_datetime").alias("obs_time"),
                     _age("years", "__bd", F.col("obs_datetime")).alias("age_years_at_obs"),
                     _age("months", "__bd", F.col("obs_datetime")).alias("age_months_at_obs"),
                     "__et", "__loc", "__form", "value_coded", "value_drug", "value_numeric",
                     F.to_date("value_datetime").alias("value_date"), "value_text", "comments", "obs_group_id",
                     F.to_date("date_created").alias("date_created"))
        o = _decode(o, lk["lookup_concept"], "concept_id", "concept")
        o = _decode(o, lk["lookup_encounter_type"], "__et", "encounter_type")
        o = _decode(o, lk["lookup_location"], "__loc", "location")
        o = _decode(o, lk["lookup_form"], "__form", "form")
        o = O.decode_two_sources(o, (lk["lookup_concept"], "value_coded", "source_key", "target_value"),
                                 (lk["lookup_drug"], "value_drug", "source_key", "target_value"), "__vc")
        o = o.drop("value_coded").withColumnRenamed("__vc", "value_coded")
        for c in ("obs_id", "patient_id", "encounter_id", "obs_group_id"):
            o = o.withColumn(c, _pid(c, cfg))
        return o

    grp_rows, val_rows = map(decoded, O.route_by_flag(flagged, F.col("is_obs_group")))
    grp = grp_rows.select(F.col("obs_id").alias("obs_group_id"), "uuid", "patient_id", "encounter_id",
                          F.col("obs_date").alias("obs_group_date"), F.col("obs_time").alias("obs_group_time"),
                          "encounter_type", "location", "concept", "date_created")
    return conform(val_rows, FLAT["omrs_obs"]), conform(grp, FLAT["omrs_obs_group"])


def _program_frame(src: dict, lk: dict) -> DataFrame:
    person = _live(src["person"]).select(F.col("person_id").alias("__pp"), F.col("birthdate").alias("__bd"))
    pp = _live(src["patient_program"]).where(F.col("date_enrolled").isNotNull())
    pp = pp.join(person, F.col("patient_id") == F.col("__pp"), "inner")
    prog = src["program"].select(F.col("program_id").alias("__prid"), F.col("concept_id").alias("__pcid"))
    pp = pp.join(prog, F.col("program_id") == F.col("__prid"), "inner")
    pp = _decode_once(pp, lk["lookup_concept"], "__pcid", "program")
    pp = _decode_once(pp, lk["lookup_location"], "location_id", "location")
    return pp


def omrs_program_enrollment(src: dict, lk: dict, cfg: FlatConfig = FlatConfig()) -> DataFrame:
    """O-PEN: live enrollments with an enrollment date; ages at enrollment and completion."""
    pp = _program_frame(src, lk)
    pp = _decode_once(pp, lk["lookup_concept"], "outcome_concept_id", "outcome")
    guard = F.col("__bd").isNull() | F.col("date_enrolled").isNull()
    out = pp.select(
        _pid("patient_program_id", cfg).alias("program_enrollment_id"), "uuid",
        _pid("patient_id", cfg).alias("patient_id"), "program", F.col("date_enrolled").alias("enrollment_date"),
        _age("years", "__bd", F.col("date_enrolled")).alias("age_years_at_enrollment"),
        _age("months", "__bd", F.col("date_enrolled")).alias("age_months_at_enrollment"), "location",
        F.col("date_completed").alias("completion_date"),
        F.when(guard, None).otherwise(H.full_years_between("__bd", "date_completed")).alias("age_years_at_completion"),
        F.when(guard, None).otherwise(H.full_months_between("__bd", "date_completed")).alias("age_months_at_completion"),
        "outcome")
    return conform(out, FLAT["omrs_program_enrollment"])


def omrs_program_state(src: dict, lk: dict, cfg: FlatConfig = FlatConfig()) -> DataFrame:
    """O-PST: live states (with a start date) of live enrollments, with
    program, workflow and state names and ages at start and end."""
    pp = _program_frame(src, lk).select("patient_program_id", "patient_id", "program", "location", "__bd")
    ps = _live(src["patient_state"]).where(F.col("start_date").isNotNull())
    pws = src["program_workflow_state"].select(F.col("program_workflow_state_id").alias("__s"),
                                               "program_workflow_id", F.col("concept_id").alias("__scid"))
    pw = src["program_workflow"].select(F.col("program_workflow_id").alias("__w"), F.col("concept_id").alias("__wcid"))
    j = (ps.join(pp, "patient_program_id", "inner").join(pws, F.col("state") == F.col("__s"), "inner")
         .join(pw, F.col("program_workflow_id") == F.col("__w"), "inner"))
    j = _decode_once(j, lk["lookup_concept"], "__wcid", "workflow")
    j = _decode_once(j, lk["lookup_concept"], "__scid", "__state").drop("state").withColumnRenamed("__state", "state")
    guard = F.col("__bd").isNull() | F.col("start_date").isNull()
    out = j.select(
        _pid("patient_state_id", cfg).alias("program_state_id"), "uuid",
        _pid("patient_program_id", cfg).alias("program_enrollment_id"), _pid("patient_id", cfg).alias("patient_id"),
        "program", "workflow", "state", "start_date",
        _age("years", "__bd", F.col("start_date")).alias("age_years_at_start"),
        _age("months", "__bd", F.col("start_date")).alias("age_months_at_start"), "end_date",
        F.when(guard, None).otherwise(H.full_years_between("__bd", "end_date")).alias("age_years_at_end"),
        F.when(guard, None).otherwise(H.full_months_between("__bd", "end_date")).alias("age_months_at_end"),
        "location")
    return conform(out, FLAT["omrs_program_state"])


def build_flat(src: dict, cfg: FlatConfig = FlatConfig()):
    """The whole flat layer (entry points B/C) as a lazy mapping: lookups first,
    providers before encounters; a table and what it depends on are built when
    first read."""
    from .lazy import LazyTables
    lk = lookups(src, cfg)
    builders = {name: (lambda t, name=name: lk[name]) for name in lk}
    builders.update({
        "omrs_patient": lambda t: omrs_patient(src, lk, cfg),
        "omrs_patient_identifier": lambda t: omrs_patient_identifier(src, lk, cfg),
        "omrs_relationship": lambda t: omrs_relationship(src, lk, cfg),
        "omrs_encounter_provider": lambda t: omrs_encounter_provider(src, lk, cfg),
        "omrs_encounter": lambda t: omrs_encounter(src, lk, t["omrs_encounter_provider"], cfg),
        "omrs_visit": lambda t: omrs_visit(src, lk, cfg),
        "__obs_pair": lambda t: omrs_obs_and_groups(src, lk, cfg),
        "omrs_obs": lambda t: t["__obs_pair"][0],
        "omrs_obs_group": lambda t: t["__obs_pair"][1],
        "omrs_program_enrollment": lambda t: omrs_program_enrollment(src, lk, cfg),
        "omrs_program_state": lambda t: omrs_program_state(src, lk, cfg),
    })
    return LazyTables(builders)

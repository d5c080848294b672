"""Rwanda mart (R-LOC, R-ORD, R-OGR, R-ONC, R-EAST, R-CVIS, R-LOBS, R-LVL,
R-PDC, R-ZIN, R-BILL, R-PAY, R-REF, R-INS, R-SVC, R-META).

Billing tables are left-join chains over the billing source; scalar
subqueries (is this payment cash? which patient?) are pre-aggregated once and
joined back (J14).  Snapshots use the period operators; the derived
malnutrition enrollments take their ids from a parallel dense numbering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as H
from .. import operators as O

# Names as stored in the source dictionary.
ONCOLOGY = "Oncology"
DIAGNOSIS_WF = "Diagnosis"
DIAGNOSIS_STATUS_WF = "Diagnosis Status"
PDC_FORMS = ["PDC malnutrition Growth Failure form", "PDC malnutrition Acute form"]
PDC_PROGRAM = "PDC PROGRAM"
CURED = "Cured (malnutrition)"
WEIGHT = "WEIGHT (KG)"
HEIGHT = "HEIGHT (CM)"
VIRAL_LOAD = "HIV VIRAL LOAD"
HIV_PROGRAMS = ["HIV Program", "PMTCT Pregnancy", "Pediatric HIV Program", "PMTCT Combined Clinic - Mother"]
PDC_ID_START = 9_990_000
PDC_UUID = "derived-pdc-malnutrition-"     # marks the rows this job derives


def _live(df):
    return df.where(~F.coalesce(F.col("voided"), F.lit(False)))


def remap_values(df: DataFrame, col: str, mapping: DataFrame, source_col: str, target_col: str) -> DataFrame:
    """R-EAST: rename values through a vocabulary map, once and simultaneously
    (``coalesce(mapped, original)``); the map is a small parameter table joined
    on the case-folded value."""
    m = mapping.select(H.fold(source_col).alias("__src"), F.col(target_col).alias("__tgt"))
    j = df.join(O.broadcast_if_small(m), H.fold(col) == F.col("__src"), "left")
    return j.withColumn(col, F.coalesce("__tgt", F.col(col))).drop("__src", "__tgt")


def easternize(flat: dict, program_map: DataFrame, encounter_type_map: DataFrame,
               source_col: str = "source", target_col: str = "target") -> dict:
    """R-EAST over the flat layer: program names on enrollments and states,
    encounter-type names on encounters and observations."""
    out = dict(flat)
    for t in ("omrs_program_enrollment", "omrs_program_state"):
        out[t] = remap_values(flat[t], "program", program_map, source_col, target_col)
    for t in ("omrs_encounter", "omrs_obs"):
        out[t] = remap_values(flat[t], "encounter_type", encounter_type_map, source_col, target_col)
    return out


def rw_location(src: dict, prefix: str | None = None) -> DataFrame:
    """R-LOC: non-retired locations with address fields (id prefixed)."""
    loc = src["location_full"].where(~F.coalesce(F.col("retired"), F.lit(False)))
    return loc.select(H.prefix_id("location_id", prefix).alias("location_id"), "name", "description", "address1",
                      "address2", "address3", "address4", "city_village", "state_province", "country",
                      "county_district")


PERSON_KEYS_ORDER = ["order_id", "orderer", "discontinued_by", "patient_id", "uuid", "encounter_id"]
PERSON_KEYS_GROUP = ["uuid", "patient_id"]


def rw_order(src: dict, lk: dict, prefix: str | None = None, pharmacy: bool = False) -> DataFrame:
    """R-ORD: live orders of live persons with extension, encounter, order set,
    drug order and drug name (7 left joins), ages at start, decoded names (a
    lookup key that stands twice aborts the job when an order meets it).
    ``pharmacy`` gives the variant without person keys."""
    person = _live(src["person"]).select(F.col("person_id").alias("__pp"), F.col("birthdate").alias("__bd"))
    o = _live(src["orders"]).drop("voided").join(person, F.col("patient_id") == F.col("__pp"), "inner")
    oeo = src["orderextension_order"]
    enc = src["encounter"].select(F.col("encounter_id").alias("__e"), F.col("encounter_type").alias("__et"),
                                  F.col("location_id").alias("__loc"))
    og = src["orderextension_order_group"].select(F.col("id").alias("__gid"), F.col("order_set_id").alias("__osid"))
    os_ = src["orderextension_order_set"].select(F.col("id").alias("__osid"), F.col("name").alias("order_set"))
    groups = og.join(os_, "__osid", "left").drop("__osid")
    do = src["drug_order"]
    drug = src["drug"].select(F.col("drug_id").alias("drug_inventory_id"), F.col("name").alias("drug"))
    j = (o.join(oeo, "order_id", "left").join(enc, F.col("encounter_id") == F.col("__e"), "left")
         .join(groups, F.col("group_id") == F.col("__gid"), "left").join(do, "order_id", "left")
         .join(drug, "drug_inventory_id", "left"))
    concept = lk["lookup_concept"]
    j = O.decode_or_abort(j, concept, "concept_id", "source_key", "target_value", "concept")
    j = O.decode_or_abort(j, concept, "discontinued_reason", "source_key", "target_value", "discontinued_reason_name")
    j = O.decode_or_abort(j, concept, "indication", "source_key", "target_value", "indication_name")
    j = O.decode_or_abort(j, concept, "route", "source_key", "target_value", "route_name")
    j = O.decode_or_abort(j, lk["lookup_encounter_type"], "__et", "source_key", "target_value", "encounter_type")
    j = O.decode_or_abort(j, lk["lookup_location"], "__loc", "source_key", "target_value", "location")
    j = O.decode_or_abort(j, lk["lookup_user"], "orderer", "source_key", "target_value", "orderer_name")
    j = O.decode_or_abort(j, lk["lookup_user"], "discontinued_by", "source_key", "target_value", "discontinued_by_name")
    guard = F.col("__bd").isNull() | F.col("start_date").isNull()
    out = j.select(
        H.prefix_id("order_id", prefix).alias("order_id"), "order_type_id", "concept",
        F.col("orderer_name").alias("orderer"), "instructions", "start_date", "auto_expire_date", "discontinued_date",
        F.col("discontinued_by_name").alias("discontinued_by"), F.col("discontinued_reason_name").alias("discontinued_reason"),
        H.prefix_id("patient_id", prefix).alias("patient_id"), "uuid", "discontinued_reason_non_coded", "urgency",
        "date_created", H.prefix_id("encounter_id", prefix).alias("encounter_id"), "encounter_type", "location",
        H.prefix_id("group_id", prefix).alias("group_id"), "order_index", F.col("indication_name").alias("indication"),
        F.col("route_name").alias("route"), "administration_instructions", "dose", "equivalent_daily_dose", "units",
        "frequency", "prn", "complex", "quantity", "order_set",
        F.when(guard, None).otherwise(H.full_years_between("__bd", "start_date")).alias("age_years_at_start_date"),
        F.when(guard, None).otherwise(H.full_months_between("__bd", "start_date")).alias("age_months_at_start_date"),
        "drug")
    return out.drop(*PERSON_KEYS_ORDER) if pharmacy else out


def rw_order_group(src: dict, prefix: str | None = None, pharmacy: bool = False) -> DataFrame:
    """R-OGR (A9): per live order group, first/last start and discontinuation of
    its orders, the patient (max over the group's orders), and the initially
    planned end = first start + the order set's cycle length in days."""
    o = src["orders"].select("order_id", "patient_id", "start_date", "discontinued_date")
    per_group = (o.join(src["orderextension_order"].select("order_id", "group_id"), "order_id", "left")
                 .groupBy("group_id").agg(F.min("start_date").alias("first_start_date"),
                                          F.max("start_date").alias("Last_start_date"),
                                          F.min("discontinued_date").alias("first_discontinued"),
                                          F.max("discontinued_date").alias("last_discontinued"),
                                          F.max("patient_id").alias("patient_id")))
    og = _live(src["orderextension_order_group"])
    os_ = src["orderextension_order_set"].select(F.col("id").alias("order_set_id"), F.col("uuid").alias("order_set_uuid"),
                                                 F.col("name").alias("order_set_name"),
                                                 F.col("description").alias("order_set_description"), "indication",
                                                 "cycle_length")
    j = og.join(os_, "order_set_id", "left").join(per_group, og["id"] == per_group["group_id"], "left")
    j = j.where(F.col("patient_id").isNotNull())
    planned = F.when(F.col("first_start_date").isNull() | F.col("cycle_length").isNull(), None).otherwise(
        H.add_days("first_start_date", F.col("cycle_length").cast("int")))
    out = j.select(H.prefix_id("id", prefix).alias("order_group_id"), "uuid", "group_type", "cycle_number",
                   "date_created", "order_set_uuid", "order_set_name", "order_set_description", "indication",
                   "first_start_date", "Last_start_date", "first_discontinued", "last_discontinued",
                   H.prefix_id("patient_id", prefix).alias("patient_id"), planned.alias("initially_planned_end"))
    return out.drop(*PERSON_KEYS_GROUP) if pharmacy else out


def rw_onc_diagnosis(flat: dict) -> DataFrame:
    """R-ONC: each oncology diagnosis state with the diagnosis-status state of
    the same enrollment that was in force at the diagnosis start (latest status
    starting on or before it) and the day differences between the two.

    Re-aimed: the source pairs every diagnosis with every status of the
    enrollment; here each diagnosis gets the one status in force (an as-of
    join), so no all-pairs expansion within an enrollment.
    """
    st = flat["omrs_program_state"].where(H.ci_eq("program", ONCOLOGY))
    dx = st.where(H.ci_eq("workflow", DIAGNOSIS_WF))
    status = st.where(H.ci_eq("workflow", DIAGNOSIS_STATUS_WF)).select(
        "program_enrollment_id", F.col("start_date").alias("__ss"),
        F.col("program_enrollment_id").alias("diagnosis_status_program_enrollment_id"),
        F.col("patient_id").alias("diagnosis_status_patient_id"), F.col("program").alias("diagnosis_status_program"),
        F.col("workflow").alias("diagnosis_status_workflow"), F.col("state").alias("diagnosis_status"),
        F.col("start_date").alias("diagnosis_status_start_date"), F.col("end_date").alias("diagnosis_status_end_date"),
        F.col("program_state_id").alias("__sid"))
    cols = ["diagnosis_status_program_enrollment_id", "diagnosis_status_patient_id", "diagnosis_status_program",
            "diagnosis_status_workflow", "diagnosis_status", "diagnosis_status_start_date",
            "diagnosis_status_end_date"]
    j = O.asof_join(dx, status, ["program_enrollment_id"], "start_date", "__ss", cols, direction="backward",
                    inclusive=True, tiebreak="__sid", bucket="adaptive")
    return j.select("program_state_id", "diagnosis_status_program_enrollment_id", "uuid", "program_enrollment_id",
                    "patient_id", "diagnosis_status_patient_id", "program", "diagnosis_status_program", "workflow",
                    "diagnosis_status_workflow", "state", "diagnosis_status", "start_date",
                    "diagnosis_status_start_date", "age_years_at_start", "age_months_at_start", "end_date",
                    "diagnosis_status_end_date", "age_years_at_end", "age_months_at_end", "location",
                    H.days_between("start_date", "diagnosis_status_start_date").cast("double").alias("start_date_difference"),
                    H.days_between("end_date", "diagnosis_status_end_date").cast("double").alias("end_date_difference"))


def rw_calculated_visit(flat: dict) -> DataFrame:
    """R-CVIS (A18, F24): distinct (patient, encounter date) with a visit key."""
    d = flat["omrs_encounter"].select("patient_id", "encounter_date").distinct()
    return d.select("patient_id", "encounter_date", H.visit_key("patient_id", "encounter_date").alias("visit_id"))


def rw_last_obs_in_period(flat: dict, concepts, periods: DataFrame) -> DataFrame:
    """R-LOBS (W5): per patient x selected concept x period end, the observations
    at the latest date on or before the end (ties kept, period kept)."""
    o = flat["omrs_obs"].where(H.ci_in("concept", concepts)).select(
        "patient_id", "concept", "obs_id", "obs_date", "encounter_type", "location", "value_coded", "value_date",
        "value_numeric", "value_text", "obs_group_id")
    snap = O.snapshot_latest_per_period(o, ["patient_id", "concept"], "obs_date", periods)
    return snap.select("patient_id", "concept", "obs_id", "end_date", F.col("obs_date").alias("last_obs_date"),
                       "encounter_type", "location", "value_coded", "value_date", "value_numeric", "value_text",
                       "obs_group_id")


def rw_last_vl_include_blanks(flat: dict, periods: DataFrame, programs=HIV_PROGRAMS,
                              concept: str = VIRAL_LOAD) -> DataFrame:
    """R-LVL (W6): every patient enrolled in an HIV programme x period, with the
    single latest viral load (``concept``) on or before the end (same-date tie
    -> smallest id), or nulls."""
    cohort = flat["omrs_program_enrollment"].where(H.ci_in("program", programs)).select("patient_id").distinct()
    cohort = cohort.join(flat["omrs_patient"].select("patient_id"), "patient_id", "left_semi")
    vl = flat["omrs_obs"].where(H.ci_eq("concept", concept))
    cols = ["concept", "encounter_type", "location", "value_coded", "value_date", "value_numeric", "value_text",
            "obs_group_id"]
    snap = O.snapshot_with_blanks(cohort, vl, ["patient_id"], "obs_date", "obs_id", periods, cols)
    return snap.select("patient_id", "concept", "obs_id", "end_date", F.col("obs_date").alias("last_obs_date"),
                       *cols[1:])


def rw_pdc_malnutrition_program(flat: dict) -> tuple[DataFrame, DataFrame]:
    """R-PDC: one derived enrollment per patient at the first visit on either
    malnutrition form (location and ages of that visit), completed at the
    patient's first 'cured' observation; ids numbered from 9,990,000.  Derived
    rows are marked by their uuid (``PDC_UUID`` + patient id), which is how a rerun
    finds them, however many there are.  Returns (derived rows, enrollment
    table with earlier derived rows removed (P9) and the new ones appended)."""
    e = flat["omrs_encounter"].where(H.ci_in("form", PDC_FORMS))
    first = O.earliest_per_key(e, "patient_id", "encounter_date", "encounter_id")
    cured = flat["omrs_obs"].where(H.ci_eq("concept", CURED)).groupBy("patient_id").agg(
        F.min("obs_date").alias("completion_date"))
    keyed = O.dense_key(first.select("patient_id"), ["patient_id"], "program_enrollment_id", start=PDC_ID_START)
    rows = (first.join(cured, "patient_id", "left").join(keyed, "patient_id")
            .select("program_enrollment_id", F.concat(F.lit(PDC_UUID), F.col("patient_id").cast("string")).alias("uuid"), "patient_id",
                    F.lit("PDC malnutrition").alias("program"), F.col("encounter_date").alias("enrollment_date"),
                    F.col("age_years_at_encounter").alias("age_years_at_enrollment"),
                    F.col("age_months_at_encounter").alias("age_months_at_enrollment"), "location", "completion_date",
                    F.lit(None).cast("long").alias("age_years_at_completion"),
                    F.lit(None).cast("long").alias("age_months_at_completion"),
                    F.lit(None).cast("string").alias("outcome")))
    kept = flat["omrs_program_enrollment"].where(~F.coalesce(F.col("uuid").startswith(PDC_UUID), F.lit(False)))
    return rows, kept.unionByName(rows)


def pdc_z_score_input(flat: dict) -> DataFrame:
    """R-ZIN: per PDC patient and day with both a weight and a height: the two
    values (first of each that day), sex code (F21) and age in days (F2).
    One conditional aggregate per (patient, day) instead of a weight x height self-join."""
    cohort = flat["omrs_program_enrollment"].where(H.ci_eq("program", PDC_PROGRAM)).select("patient_id").distinct()
    o = flat["omrs_obs"].where(H.ci_in("concept", [WEIGHT, HEIGHT])).join(cohort, "patient_id", "left_semi")
    is_w, is_h = H.ci_eq("concept", WEIGHT), H.ci_eq("concept", HEIGHT)
    per_day = o.groupBy("patient_id", "obs_date").agg(
        F.min_by(F.when(is_w, F.col("value_numeric")), F.when(is_w & F.col("value_numeric").isNotNull(), F.col("obs_id"))).alias("weight"),
        F.min_by(F.when(is_h, F.col("value_numeric")), F.when(is_h & F.col("value_numeric").isNotNull(), F.col("obs_id"))).alias("__h"))
    per_day = per_day.where(F.col("weight").isNotNull() & F.col("__h").isNotNull())
    p = flat["omrs_patient"].select("patient_id", "gender", "birthdate")
    j = per_day.join(p, "patient_id", "left")
    return j.select("patient_id", F.date_format("obs_date", "yyyy-MM-dd").alias("obs_date"), F.lit(0).alias("oedema"),
                    F.lit("l").alias("lh"), "weight", F.round("__h").cast("int").alias("clenhei"),
                    H.gender_code("gender").alias("sex"), H.days_between("obs_date", "birthdate").alias("agedays"))


def _user_uuid(src: dict) -> DataFrame:
    return (src["users"].select("user_id", "person_id")
            .join(src["person"].select("person_id", F.col("uuid").alias("__uuid")), "person_id", "left")
            .select("user_id", "__uuid"))


def rw_bill(src: dict) -> DataFrame:
    """R-BILL: live patient bills with a consumption date; total = patient +
    third party + insurance amounts (null if any part is null, F17)."""
    pb = _live(src["moh_bill_patient_bill"]).select("patient_bill_id", F.col("amount").alias("amount_patient"), "is_paid")
    cons = src["moh_bill_consommation"]
    j = (pb.join(cons, "patient_bill_id", "left").where(F.col("created_date").isNotNull())
         .join(src["moh_bill_beneficiary"].select("beneficiary_id", "patient_id"), "beneficiary_id", "left")
         .join(src["moh_bill_third_party_bill"].withColumnRenamed("amount", "amount_3rd_part"), "third_party_bill_id", "left")
         .join(src["moh_bill_insurance_bill"].withColumnRenamed("amount", "amount_insurance"), "insurance_bill_id", "left")
         .join(_user_uuid(src), F.col("creator") == F.col("user_id"), "left"))
    total = F.col("amount_patient") + F.col("amount_3rd_part") + F.col("amount_insurance")
    return j.select("patient_id", total.cast("decimal(20,2)").alias("amount"), "amount_3rd_part", "amount_insurance",
                    "amount_patient", "is_paid", "created_date", F.lit(None).cast("string").alias("creator"),
                    F.col("__uuid").alias("creator_uuid"), "patient_bill_id")


def rw_payment(src: dict) -> DataFrame:
    """R-PAY (J14): live payments with is-cash / is-deposit counts and the
    patient (max over the bill's beneficiaries), each pre-aggregated once."""
    pay = _live(src["moh_bill_payment"])
    cash = src["moh_bill_cash_payment"]
    dep = src["moh_bill_deposit_payment"]
    bill_patient = (src["moh_bill_consommation"].select("patient_bill_id", "beneficiary_id")
                    .join(src["moh_bill_beneficiary"].select("beneficiary_id", "patient_id"), "beneficiary_id")
                    .groupBy("patient_bill_id").agg(F.max("patient_id").alias("patient_id")))
    out = O.correlated_agg(pay, cash, "bill_payment_id", "cash_payment_id", {"is_cash": F.count(F.lit(1))},
                           fill={"is_cash": 0})
    out = O.correlated_agg(out, dep, "bill_payment_id", "deposit_payment_id", {"is_deposit": F.count(F.lit(1))},
                           fill={"is_deposit": 0})
    out = out.join(bill_patient, "patient_bill_id", "left").join(_user_uuid(src), F.col("collector") == F.col("user_id"), "left")
    return out.select("bill_payment_id", "amount_paid", "date_received", F.lit(None).cast("string").alias("collector"),
                      F.col("__uuid").alias("collector_uuid"), "is_cash", "is_deposit", "patient_id", "patient_bill_id")


def rw_refund(src: dict) -> DataFrame:
    """R-REF: live refunds with the refunding user's person uuid."""
    r = _live(src["moh_bill_payment_refund"]).join(_user_uuid(src), F.col("refunded_by") == F.col("user_id"), "left")
    return r.select("bill_payment_id", F.lit(None).cast("string").alias("refunded_by"), "amount_refunded",
                    F.col("__uuid").alias("refunded_by_person_uuid"))


def rw_insurance_policy(src: dict) -> DataFrame:
    """R-INS: policies with company, third-party rate, owner uuid and beneficiary patients."""
    pol = src["moh_bill_insurance_policy"]
    j = (pol.join(src["moh_bill_insurance"], "insurance_id", "left")
         .join(src["moh_bill_beneficiary"].select("insurance_policy_id", "patient_id"), "insurance_policy_id", "left")
         .join(src["person"].select(F.col("person_id").alias("owner"), F.col("uuid").alias("owner_uuid")), "owner", "left")
         .join(src["moh_bill_third_party"], "third_party_id", "left"))
    return j.select("patient_id", F.lit(None).cast("string").alias("owner"), "coverage_start_date", "expiration_date",
                    "retire_date", "retire_reason", F.col("rate").alias("third_part_rate"),
                    F.col("name").alias("insurance_company"), "owner_uuid")


def rw_patient_service(src: dict) -> DataFrame:
    """R-SVC: live service lines with patient, service name and category."""
    s = _live(src["moh_bill_patient_service_bill"])
    j = (s.join(src["moh_bill_consommation"].select("consommation_id", "beneficiary_id", "patient_bill_id"),
                "consommation_id", "left")
         .join(src["moh_bill_beneficiary"].select("beneficiary_id", "patient_id"), "beneficiary_id", "left")
         .join(src["moh_bill_billable_service"], "billable_service_id", "left")
         .join(src["moh_bill_facility_service_price"].withColumnRenamed("name", "service_name"),
               "facility_service_price_id", "left")
         .join(src["moh_bill_service_category"].withColumnRenamed("name", "category_name"), "service_category_id", "left"))
    return j.select("patient_id", F.col("unit_price").alias("UNIT_PRICE"), "quantity", "paid_quantity",
                    F.to_date("created_date").alias("created_date"), "is_paid", "service_name", "patient_bill_id",
                    "category_name")


def rw_import_metadata(spark: SparkSession, source_host: str, source_db: str, prefix: int | None,
                       comment: str) -> DataFrame:
    """R-META (S10): one audit row per load."""
    return spark.range(1).select(F.lit(source_host).alias("source_host"), F.lit(source_db).alias("source_db"),
                                 F.lit(prefix).cast("long").alias("warehouse_prefix"),
                                 F.current_date().alias("import_date"), F.lit(comment).alias("import_comment"))

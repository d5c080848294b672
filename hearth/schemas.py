"""Table schemas: the source EMR tables the jobs read, and the flat layer
they write (SURVEY §1.2, Appendix C).  Ids are longs (site-prefixed ids
overflow 32 bits); datetimes are ``timestamp_ntz``; TIME is ``HH:mm:ss`` text.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# --------------------------------------------------------------- source tables
SOURCE = {
    "patient": "patient_id long, voided boolean, date_created timestamp_ntz",
    "person": ("person_id long, uuid string, gender string, birthdate date, birthdate_estimated boolean, "
               "dead boolean, death_date date, cause_of_death long, voided boolean, date_created timestamp_ntz"),
    "person_name": ("person_name_id long, person_id long, given_name string, middle_name string, "
                    "family_name_prefix string, family_name string, family_name2 string, family_name_suffix string, "
                    "preferred boolean, voided boolean, date_created timestamp_ntz"),
    "person_address": ("person_address_id long, person_id long, country string, postal_code string, "
                       "state_province string, county_district string, city_village string, address1 string, "
                       "address2 string, address3 string, address4 string, address5 string, address6 string, "
                       "latitude string, longitude string, preferred boolean, voided boolean, "
                       "date_created timestamp_ntz"),
    "person_attribute": ("person_attribute_id long, person_id long, person_attribute_type_id long, value string, "
                         "voided boolean, date_created timestamp_ntz"),
    "person_attribute_type": "person_attribute_type_id long, name string, format string",
    "patient_identifier": ("patient_identifier_id long, uuid string, patient_id long, identifier string, "
                           "identifier_type long, location_id long, preferred boolean, voided boolean, "
                           "date_created timestamp_ntz"),
    "patient_identifier_type": "patient_identifier_type_id long, name string",
    "relationship": ("relationship_id long, uuid string, person_a long, person_b long, relationship long, "
                     "start_date date, end_date date, voided boolean, date_created timestamp_ntz"),
    "relationship_type": "relationship_type_id long, a_is_to_b string, b_is_to_a string",
    "encounter": ("encounter_id long, uuid string, patient_id long, encounter_type long, form_id long, "
                  "location_id long, visit_id long, encounter_datetime timestamp_ntz, creator long, voided boolean, "
                  "date_created timestamp_ntz"),
    "encounter_type": "encounter_type_id long, name string",
    "encounter_provider": ("encounter_provider_id long, uuid string, encounter_id long, provider_id long, "
                           "encounter_role_id long, voided boolean"),
    "encounter_role": "encounter_role_id long, name string",
    "provider": "provider_id long, uuid string, person_id long, name string, identifier string",
    "visit": ("visit_id long, uuid string, patient_id long, visit_type_id long, location_id long, "
              "date_started timestamp_ntz, date_stopped timestamp_ntz, voided boolean, date_created timestamp_ntz"),
    "visit_type": "visit_type_id long, name string",
    "obs": ("obs_id long, uuid string, person_id long, encounter_id long, concept_id long, obs_datetime timestamp_ntz, "
            "obs_group_id long, value_coded long, value_drug long, value_numeric double, value_datetime timestamp_ntz, "
            "value_text string, comments string, voided boolean, date_created timestamp_ntz"),
    "concept": "concept_id long",
    "concept_name": ("concept_name_id long, concept_id long, name string, locale string, locale_preferred boolean, "
                     "concept_name_type string, voided boolean, date_created timestamp_ntz"),
    "concept_name_tag_map": "concept_name_id long, concept_name_tag_id long",
    "drug": "drug_id long, name string",
    "location": "location_id long, name string",
    "form": "form_id long, name string",
    "users": "user_id long, username string, system_id string, person_id long",
    "patient_program": ("patient_program_id long, uuid string, patient_id long, program_id long, date_enrolled date, "
                        "date_completed date, location_id long, outcome_concept_id long, voided boolean"),
    "program": "program_id long, concept_id long, name string",
    "patient_state": ("patient_state_id long, uuid string, patient_program_id long, state long, start_date date, "
                      "end_date date, voided boolean"),
    "program_workflow": "program_workflow_id long, concept_id long",
    "program_workflow_state": "program_workflow_state_id long, program_workflow_id long, concept_id long",
}

# --------------------------------------------------------------- flat layer
FLAT = {
    "omrs_patient": ("patient_id long, patient_uuid string, identifier string, first_name string, middle_name string, "
                     "last_name string, gender string, birthdate date, birthdate_estimated boolean, phone_number string, "
                     "country string, state_province string, county_district string, city_village string, "
                     "postal_code string, address1 string, address2 string, address3 string, address4 string, "
                     "address5 string, address6 string, latitude string, longitude string, dead boolean, "
                     "death_date date, age_years_at_death long, age_months_at_death long, cause_of_death string, "
                     "mothers_name string, fathers_name string, health_center string, date_created date"),
    "omrs_patient_identifier": ("patient_identifier_id long, uuid string, patient_id long, type string, "
                                "identifier string, location string, date_created date"),
    "omrs_relationship": ("relationship_id long, uuid string, patient_id long, patient_role string, "
                          "related_person_role string, related_person string, start_date date, end_date date, "
                          "date_created date"),
    "omrs_encounter_provider": ("encounter_provider_id long, uuid string, encounter_id long, encounter_uuid string, "
                                "provider string, provider_role string"),
    "omrs_encounter": ("encounter_id long, uuid string, patient_id long, encounter_type string, form string, "
                       "location string, encounter_date date, encounter_time string, provider string, "
                       "provider_role string, visit_id long, age_years_at_encounter long, "
                       "age_months_at_encounter long, date_created date, created_by string"),
    "omrs_visit": ("visit_id long, uuid string, patient_id long, visit_type string, location string, "
                   "date_started date, date_stopped date, date_created date"),
    "omrs_obs_group": ("obs_group_id long, uuid string, patient_id long, encounter_id long, obs_group_date date, "
                       "obs_group_time string, encounter_type string, location string, concept string, "
                       "date_created date"),
    "omrs_obs": ("obs_id long, uuid string, patient_id long, encounter_id long, obs_date date, obs_time string, "
                 "age_years_at_obs long, age_months_at_obs long, encounter_type string, form string, location string, "
                 "concept string, value_coded string, value_date date, value_numeric double, value_text string, "
                 "comments string, obs_group_id long, date_created date"),
    "omrs_program_enrollment": ("program_enrollment_id long, uuid string, patient_id long, program string, "
                                "enrollment_date date, age_years_at_enrollment long, age_months_at_enrollment long, "
                                "location string, completion_date date, age_years_at_completion long, "
                                "age_months_at_completion long, outcome string"),
    "omrs_program_state": ("program_state_id long, uuid string, program_enrollment_id long, patient_id long, "
                           "program string, workflow string, state string, start_date date, age_years_at_start long, "
                           "age_months_at_start long, end_date date, age_years_at_end long, age_months_at_end long, "
                           "location string"),
}


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def column_names(ddl: str) -> list[str]:
    return [f.name for f in struct(ddl).fields]


def conform(df, ddl: str):
    """Select and cast ``df`` to a declared table schema (missing columns -> null)."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import DecimalType, DoubleType, FloatType, IntegralType
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in struct(ddl).fields:
        src = have.get(f.name)
        c = F.col(f.name) if src is not None else F.lit(None)
        if isinstance(f.dataType, IntegralType) and isinstance(src, (DoubleType, FloatType, DecimalType)):
            c = F.round(c)   # INT targets round half away from zero, never truncate
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


# --------------------------------------------------------------- Rwanda-only source tables
RWANDA_SOURCE = {
    "location_full": ("location_id long, name string, description string, address1 string, address2 string, "
                      "address3 string, address4 string, city_village string, state_province string, country string, "
                      "county_district string, retired boolean"),
    "orders": ("order_id long, order_type_id long, concept_id long, orderer long, instructions string, "
               "start_date date, auto_expire_date date, discontinued_date date, discontinued_by long, "
               "discontinued_reason long, patient_id long, uuid string, discontinued_reason_non_coded string, "
               "urgency string, date_created date, encounter_id long, voided boolean"),
    "orderextension_order": ("order_id long, group_id long, order_index long, indication long, route long, "
                             "administration_instructions string"),
    "orderextension_order_group": ("id long, uuid string, group_type string, cycle_number long, order_set_id long, "
                                   "date_created date, voided boolean"),
    "orderextension_order_set": "id long, uuid string, name string, description string, indication long, cycle_length long",
    "drug_order": ("order_id long, drug_inventory_id long, dose double, units string, frequency string, prn long, "
                   "complex string, quantity decimal(20,2), equivalent_daily_dose decimal(12,2)"),
    "moh_bill_patient_bill": "patient_bill_id long, amount decimal(20,2), is_paid long, voided boolean",
    "moh_bill_consommation": ("consommation_id long, patient_bill_id long, beneficiary_id long, third_party_bill_id long, "
                              "insurance_bill_id long, creator long, created_date timestamp_ntz"),
    "moh_bill_beneficiary": "beneficiary_id long, patient_id long, insurance_policy_id long",
    "moh_bill_third_party_bill": "third_party_bill_id long, amount decimal(20,2)",
    "moh_bill_insurance_bill": "insurance_bill_id long, amount decimal(20,2)",
    "moh_bill_payment": ("bill_payment_id long, patient_bill_id long, amount_paid decimal(20,2), "
                         "date_received timestamp_ntz, collector long, voided boolean"),
    "moh_bill_cash_payment": "cash_payment_id long",
    "moh_bill_deposit_payment": "deposit_payment_id long",
    "moh_bill_payment_refund": "bill_payment_id long, refunded_by long, amount_refunded decimal(20,2), voided boolean",
    "moh_bill_insurance_policy": ("insurance_policy_id long, insurance_id long, owner long, third_party_id long, "
                                  "coverage_start_date date, expiration_date date, retire_date date, retire_reason string"),
    "moh_bill_insurance": "insurance_id long, name string",
    "moh_bill_third_party": "third_party_id long, rate decimal(20,2)",
    "moh_bill_patient_service_bill": ("patient_service_bill_id long, consommation_id long, billable_service_id long, "
                                      "unit_price decimal(20,2), quantity decimal(20,2), paid_quantity decimal(20,2), "
                                      "created_date timestamp_ntz, is_paid long, voided boolean"),
    "moh_bill_billable_service": "billable_service_id long, facility_service_price_id long, service_category_id long",
    "moh_bill_facility_service_price": "facility_service_price_id long, name string",
    "moh_bill_service_category": "service_category_id long, name string",
}


# --------------------------------------------------------------- Liberia-only source tables
LIBERIA_SOURCE = {
    "concept_reference_map": "concept_id long, concept_reference_term_id long",
    "concept_reference_term": "concept_reference_term_id long, code string, concept_source_id long",
    "concept_reference_source": "concept_source_id long, name string",
    "encounter_type_uuid": "encounter_type_id long, name string, uuid string",
}

LIBERIA_OUT = {
    "program_enrollment": ("program_enrollment_id long, patient_id long, program_id long, program_name string, "
                           "date_enrolled date, date_completed date, location_id long, location_name string, "
                           "outcome_concept_id long, outcome_concept_name string, creator string, date_created date, "
                           "changed_by string, date_changed date, voided boolean, voided_by string, "
                           "date_voided date, void_reason string, uuid string"),
}

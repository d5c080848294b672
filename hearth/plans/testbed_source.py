"""Source tables derived from the driver's test tables, and the jobs from source to
flat layer bound to them: names, identifiers, addresses, attributes, providers,
visits, relationships, observation groups, programmes, orders, bills, and voided rows in all of them.

Like the other derived inputs each table is one SQL text shared by Spark and
DuckDB.  ``site_folders`` writes the tables as two of three listed sites with the
same ids for the multi-site load.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..schemas import LIBERIA_SOURCE, RWANDA_SOURCE, SOURCE, conform, struct
from ..session import scratch_table_path
from ..sources.sites import UNIFY_SOURCE
from . import flat as flat_jobs
from . import liberia, rwanda, unify
from .lazy import LazyTables
from .testbed_flat import run

SCHEMAS = {**SOURCE, **RWANDA_SOURCE, **LIBERIA_SOURCE, **UNIFY_SOURCE}
PREFIX = "10"


def _at(base: str, days: str) -> str:
    return f"CAST(DATE '{base}' + CAST({days} AS INT) AS TIMESTAMP)"


def _values(columns: str, *rows: str) -> str:
    return f"SELECT {columns} FROM (VALUES {', '.join(rows)}) AS t({columns})"


CONCEPTS = ["Weight", "Visit construct", "Appointment date", "Yes", "No", "HIV PROGRAM", "Chronic care", "Treatment status", "On treatment", "Transferred", "Died",
            "Prescription construct", "Medication orders", "Quantity of medication prescribed per dose", "Time units", "Days", "Mental health intervention",
            "Psychotherapy", "PATIENT PREGNANT", "RETURN VISIT DATE", "Patient died", "Lost to followup", "Type of referral role", "DOCTOR"]
CID = {c: i + 1 for i, c in enumerate(CONCEPTS)}
_C = {k: str(v) for k, v in CID.items()}
_EXTRA_NAMES = [f"({1000 + i}, {CID[c]}, 'autre {c}', 'fr', true, 'SHORT', {str(i % 3 == 0).lower()}, {i})" for i, c in enumerate(CONCEPTS)] \
    + [f"({2000 + i}, {CID[c]}, 'short {c}', 'en', false, 'SHORT', false, {i * 7 % 5})" for i, c in enumerate(CONCEPTS)]
_ENC_TYPES = ["ART visit", "Mental Health", "Laboratory", "Adult HIV", "Pediatric HIV"]
MH_UUID = liberia.MH_ENCOUNTER_TYPE_UUID

TABLES = {
    "patient": f"SELECT c_custkey AS patient_id, c_custkey % 17 = 3 AS voided, {_at('2000-01-01', 'c_custkey % 900')} AS date_created FROM customer",
    "person": "SELECT c_custkey AS person_id, md5(CAST(c_custkey AS STRING)) AS uuid, CASE WHEN c_acctbal > 0 THEN 'F' ELSE 'M' END AS gender, "
              "CASE WHEN c_custkey % 29 <> 0 THEN DATE '1950-01-01' + CAST(c_custkey * 37 % 14000 AS INT) END AS birthdate, c_custkey % 23 = 0 AS dead, "
              f"CASE WHEN c_custkey % 23 = 0 THEN DATE '2002-01-01' + CAST(c_custkey % 500 AS INT) END AS death_date, "
              f"CASE WHEN c_custkey % 23 = 0 THEN {_C['Died']} END AS cause_of_death, c_custkey % 19 = 4 AS voided FROM customer",
    "person_name": " UNION ALL ".join(
        f"SELECT c_custkey * 10 + {i} AS person_name_id, c_custkey AS person_id, 'Given{i} ' || c_name AS given_name, "
        f"CASE WHEN c_custkey % 4 <> {i} THEN 'M' || CAST(c_custkey % 7 AS STRING) END AS middle_name, CASE WHEN c_custkey % 5 = {i} THEN 'de' END AS family_name_prefix, "
        f"c_mktsegment AS family_name, CASE WHEN c_custkey % 6 = {i} THEN 'Second' END AS family_name2, c_custkey % 3 = {i} AS preferred, "
        f"c_custkey % 7 = {i} AS voided, {_at('2000-01-01', f'c_custkey * {i + 3} % 500')} AS date_created FROM customer WHERE c_custkey % 11 <> {i}" for i in range(3)),
    "person_address": " UNION ALL ".join(
        f"SELECT c_custkey * 10 + {i} AS person_address_id, c_custkey AS person_id, 'Country {i}' AS country, 'District ' || CAST(c_nationkey AS STRING) AS county_district, "
        f"'Village ' || CAST(c_custkey % 40 AS STRING) AS city_village, c_custkey % 2 = {i} AS preferred, c_custkey % 9 = {i} AS voided, "
        f"{_at('2000-01-01', f'c_custkey * {i + 2} % 300')} AS date_created FROM customer WHERE c_custkey % 8 <> {i}" for i in range(2)),
    "person_attribute_type": _values("person_attribute_type_id, name", "(1, 'Cell Phone Number')", "(2, 'Mother''s Name')", "(7, 'Health Center')", "(9, 'Test Patient')"),
    "person_attribute": " UNION ALL ".join(
        f"SELECT c_custkey * 100 + {k * 2 + i} AS person_attribute_id, c_custkey AS person_id, {k} AS person_attribute_type_id, {v} AS value, "
        f"c_custkey % 13 = {i} AS voided, {_at('2000-01-01', f'c_custkey * {i + k} % 300')} AS date_created FROM customer WHERE {w}"
        for k, v, w in ((1, "'07' || CAST(c_custkey AS STRING)", "c_custkey % 3 <> 0"), (2, "'Mother ' || c_name", "c_custkey % 4 <> 0"),
                        (7, "CASE WHEN c_custkey % 6 = 0 THEN 'Clinic by name' ELSE CAST(c_nationkey AS STRING) END", "c_custkey % 5 <> 0"),
                        (9, "CASE WHEN c_custkey % 31 = 0 THEN 'True' ELSE 'false' END", "c_custkey % 2 = 0")) for i in range(2)),
    "patient_identifier_type": _values("patient_identifier_type_id, name", "(1, 'National ID')", "(2, 'ARV Number')", "(3, 'Old number')"),
    "patient_identifier": " UNION ALL ".join(
        f"SELECT c_custkey * 10 + {i} AS patient_identifier_id, md5('i{i}' || CAST(c_custkey AS STRING)) AS uuid, c_custkey AS patient_id, "
        f"CASE WHEN c_custkey % 21 = {i} THEN '  ' WHEN c_custkey % 22 <> {i} THEN 'ID ' || CAST(c_custkey * {i + 1} AS STRING) END AS identifier, {i} AS identifier_type, "
        f"CASE WHEN c_custkey % 8 <> {i} THEN c_nationkey END AS location_id, c_custkey % 2 = {i % 2} AS preferred, c_custkey % 15 = {i} AS voided, "
        f"{_at('2001-01-01', f'c_custkey * {i} % 200')} AS date_created FROM customer" for i in (1, 2, 3)),
    "relationship_type": _values("relationship_type_id, a_is_to_b, b_is_to_a", "(1, 'Community Health Worker', 'Patient')", "(2, 'Parent', 'Child')", "(3, NULL, 'Guardian')"),
    "relationship": "SELECT o_orderkey AS relationship_id, md5('r' || CAST(o_orderkey AS STRING)) AS uuid, CASE WHEN o_orderkey % 25 <> 0 THEN o_custkey END AS person_a, "
                    "(o_custkey * 7 + 11) % 1700 AS person_b, 1 + o_orderkey % 3 AS relationship, CAST(o_orderdate AS DATE) AS start_date, "
                    "o_orderkey % 14 = 1 AS voided, o_orderdate AS date_created FROM orders WHERE o_orderkey % 5 = 0",
    "encounter_type": _values("encounter_type_id, name", *[f"({i + 1}, '{t}')" for i, t in enumerate(_ENC_TYPES)]),
    "encounter_type_uuid": _values("encounter_type_id, name, uuid", *[f"({i + 1}, '{t}', '{MH_UUID if t == 'Mental Health' else t}')" for i, t in enumerate(_ENC_TYPES)]),
    "encounter": "SELECT o_orderkey AS encounter_id, md5('e' || CAST(o_orderkey AS STRING)) AS uuid, o_custkey AS patient_id, 1 + o_orderkey % 6 AS encounter_type, "
                 "CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 3 END AS form_id, o_custkey % 26 AS location_id, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 900 END AS visit_id, "
                 "o_orderdate AS encounter_datetime, 1 + o_orderkey % 4 AS creator, o_orderkey % 16 = 5 AS voided, o_orderdate AS date_created FROM orders",
    "form": _values("form_id, name", "(1, 'Form A')", "(2, 'Form B')"),
    "users": _values("user_id, username, system_id, person_id", "(1, 'admin', '1-1', 1)", "(2, NULL, '2-6', 2)", "(3, 'clerk', NULL, 3)"),
    "location": "SELECT CAST(n_nationkey AS BIGINT) AS location_id, n_name AS name FROM nation",
    "location_fosa": "SELECT CAST(n_nationkey AS BIGINT) AS location_id, CAST(500 + n_nationkey AS STRING) AS fosa_id FROM nation WHERE n_nationkey % 4 <> 1",
    "encounter_role": _values("encounter_role_id, name", "(1, 'Clinician')", "(2, 'Nurse')"),
    "provider": "SELECT s_suppkey AS provider_id, md5('p' || CAST(s_suppkey AS STRING)) AS uuid, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey * 3 END AS person_id, "
                "CASE WHEN s_suppkey % 4 = 1 THEN s_name WHEN s_suppkey % 4 = 2 THEN ' ' END AS name, CASE WHEN s_suppkey % 5 <> 0 THEN 'X' || CAST(s_suppkey AS STRING) END AS identifier FROM supplier",
    "encounter_provider": "SELECT ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS encounter_provider_id, "
                          "md5('ep' || CAST(((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS STRING)) AS uuid, l_orderkey AS encounter_id, "
                          "l_suppkey AS provider_id, 1 + l_linenumber % 3 AS encounter_role_id, l_partkey % 12 = 0 AS voided FROM lineitem WHERE l_partkey % 4 = 0",
    "visit_type": _values("visit_type_id, name", "(1, 'Clinic visit')", "(2, 'Home visit')"),
    "visit": "SELECT o_orderkey AS visit_id, md5('v' || CAST(o_orderkey AS STRING)) AS uuid, o_custkey AS patient_id, 1 + o_orderkey % 3 AS visit_type_id, o_custkey % 27 AS location_id, "
             "o_orderdate AS date_started, CASE WHEN o_orderkey % 4 <> 1 THEN CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 6 AS INT) AS TIMESTAMP) END AS date_stopped, "
             "o_orderkey % 9 = 4 AS voided, o_orderdate AS date_created FROM orders WHERE o_orderkey % 3 = 0",
    "concept": _values("concept_id", *[f"({i})" for i in CID.values()], "(900)"),
    "concept_name": f"SELECT concept_name_id, concept_id, name, locale, locale_preferred, concept_name_type, voided, {_at('2000-01-01', 'd')} AS date_created FROM (VALUES "
                    + ", ".join([f"({i}, {i}, '{c}', 'en', true, 'FULLY_SPECIFIED', false, 2)" for c, i in CID.items()] + _EXTRA_NAMES)
                    + ") AS t(concept_name_id, concept_id, name, locale, locale_preferred, concept_name_type, voided, d)",
    "concept_name_tag_map": _values("concept_name_id, concept_name_tag_id", *[f"({2000 + i}, {4 if i % 2 else 5})" for i in range(len(CONCEPTS))], "(2001, 4)"),
    "drug": _values("drug_id, name", "(1, 'Aspirin')", "(2, 'Nevirapine')"),
    # group headers are the lines of number 1; the order's other lines belong to the order's least header
    "obs": f"""SELECT l.obs_id, md5('o' || CAST(l.obs_id AS STRING)) AS uuid, o_custkey AS person_id, CASE WHEN l_orderkey % 7 <> 0 THEN l_orderkey END AS encounter_id,
        CASE WHEN l_linenumber = 1 THEN CASE l_orderkey % 3 WHEN 0 THEN {_C['Visit construct']} WHEN 1 THEN {_C['Prescription construct']} ELSE 900 END
          ELSE CASE l_partkey % 10 WHEN 0 THEN {_C['Weight']} WHEN 1 THEN {_C['Appointment date']} WHEN 2 THEN {_C['Medication orders']}
            WHEN 3 THEN {_C['Quantity of medication prescribed per dose']} WHEN 4 THEN {_C['Time units']} WHEN 5 THEN {_C['Mental health intervention']}
            WHEN 6 THEN {_C['PATIENT PREGNANT']} WHEN 7 THEN {_C['RETURN VISIT DATE']} WHEN 8 THEN {_C['Type of referral role']} ELSE 900 END END AS concept_id,
        o_orderdate AS obs_datetime, CASE WHEN l_linenumber > 1 AND l_partkey % 10 <> 9 THEN h.header END AS obs_group_id,
        CASE WHEN l_partkey % 10 IN (2, 4) THEN CASE l_suppkey % 3 WHEN 0 THEN {_C['Days']} WHEN 1 THEN {_C['Yes']} END
          WHEN l_partkey % 10 = 5 THEN {_C['Psychotherapy']} WHEN l_partkey % 10 = 6 THEN l_suppkey % 2 WHEN l_partkey % 10 = 8 THEN {_C['DOCTOR']} END AS value_coded,
        CASE WHEN l_partkey % 10 = 2 AND l_suppkey % 3 = 2 THEN 1 + l_suppkey % 2 END AS value_drug,
        CASE WHEN l_partkey % 10 IN (0, 3) THEN l_quantity END AS value_numeric, CASE WHEN l_partkey % 10 IN (1, 7) THEN l_shipdate END AS value_datetime,
        CASE WHEN l_partkey % 10 = 9 THEN 'text ' || CAST(l_suppkey AS STRING) END AS value_text, l_suppkey % 18 = 0 AS voided, l_shipdate AS date_created
        FROM (SELECT *, ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS obs_id FROM lineitem) l JOIN orders ON o_orderkey = l_orderkey
        LEFT JOIN (SELECT l_orderkey AS k, min(((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) AS header FROM lineitem
          WHERE l_linenumber = 1 GROUP BY l_orderkey) h ON h.k = l_orderkey""",
    "program": _values("program_id, concept_id, name", f"(1, {_C['HIV PROGRAM']}, 'HIV PROGRAM')", f"(2, {_C['Chronic care']}, 'Chronic care')", "(3, 900, 'Empty programme')"),
    "patient_program": f"SELECT o_orderkey AS patient_program_id, md5('pp' || CAST(o_orderkey AS STRING)) AS uuid, o_custkey AS patient_id, 1 + o_orderkey % 2 AS program_id, "
                       "CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS date_enrolled, "
                       "CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 500 AS INT) END AS date_completed, o_custkey % 26 AS location_id, "
                       f"CASE o_orderkey % 4 WHEN 0 THEN {_C['Patient died']} WHEN 1 THEN {_C['Lost to followup']} END AS outcome_concept_id, o_orderkey % 13 = 2 AS voided "
                       "FROM orders WHERE o_custkey % 3 <> 0 AND o_orderkey % 4 <> 3",
    "program_workflow": _values("program_workflow_id, concept_id", f"(1, {_C['Treatment status']})"),
    "program_workflow_state": _values("program_workflow_state_id, program_workflow_id, concept_id", f"(1, 1, {_C['On treatment']})", f"(2, 1, {_C['Transferred']})"),
    "concept_reference_source": _values("concept_source_id, name", "(1, 'PIH')", "(2, 'CIEL')"),
    "concept_reference_term": _values("concept_reference_term_id, code, concept_source_id", "(1, 'Mental health intervention', 1)", "(2, 'PATIENT PREGNANT', 1)",
                                      "(3, 'RETURN VISIT DATE', 1)", "(4, '165137', 2)", "(5, 'Type of referral role', 1)"),
    "concept_reference_map": _values("concept_id, concept_reference_term_id", f"({_C['Mental health intervention']}, 1)", f"({_C['PATIENT PREGNANT']}, 2)",
                                     f"({_C['RETURN VISIT DATE']}, 3)", f"({_C['Weight']}, 4)", f"({_C['Type of referral role']}, 5)"),
    # ------------------------------------------------------------ orders and bills
    "location_full": "SELECT CAST(n_nationkey AS BIGINT) AS location_id, n_name AS name, 'About ' || n_name AS description, 'Road ' || CAST(n_regionkey AS STRING) AS address1, "
                     "n_nationkey % 6 = 0 AS retired FROM nation",
    "orders": f"SELECT o_orderkey AS order_id, o_orderkey % 3 AS order_type_id, CASE WHEN o_orderkey % 6 <> 0 THEN {_C['Medication orders']} ELSE 901 END AS concept_id, "
              "1 + o_orderkey % 4 AS orderer, 'Take ' || CAST(o_orderkey % 4 AS STRING) AS instructions, CASE WHEN o_orderkey % 31 <> 0 THEN CAST(o_orderdate AS DATE) END AS start_date, "
              "CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INT) END AS discontinued_date, CASE WHEN o_orderkey % 5 = 0 THEN 1 + o_orderkey % 3 END AS discontinued_by, "
              f"CASE WHEN o_orderkey % 5 = 0 THEN {_C['Died']} END AS discontinued_reason, o_custkey AS patient_id, md5('or' || CAST(o_orderkey AS STRING)) AS uuid, 'ROUTINE' AS urgency, "
              "CAST(o_orderdate AS DATE) AS date_created, (o_orderkey * 3) % 15000 AS encounter_id, o_orderkey % 20 = 7 AS voided FROM orders",
    "orderextension_order": f"SELECT o_orderkey AS order_id, o_orderkey % 400 AS group_id, o_orderkey % 5 AS order_index, CASE WHEN o_orderkey % 4 = 0 THEN {_C['Weight']} END AS indication, "
                            f"CASE WHEN o_orderkey % 4 = 1 THEN {_C['Yes']} END AS route, 'with food' AS administration_instructions FROM orders WHERE o_orderkey % 3 <> 2",
    "orderextension_order_group": "SELECT o_orderkey AS id, md5('og' || CAST(o_orderkey AS STRING)) AS uuid, 'Drugs' AS group_type, o_orderkey % 6 AS cycle_number, "
                                  "CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 4 END AS order_set_id, CAST(o_orderdate AS DATE) AS date_created, o_orderkey % 10 = 9 AS voided FROM orders WHERE o_orderkey < 450",
    "orderextension_order_set": _values("id, uuid, name, description, indication, cycle_length", "(1, 'u1', 'Set A', 'first', 1, 21)", "(2, 'u2', 'Set B', NULL, NULL, NULL)", "(3, 'u3', 'Set C', 'x', 5, 28)"),
    "drug_order": "SELECT o_orderkey AS order_id, 1 + o_orderkey % 3 AS drug_inventory_id, CAST(o_orderkey % 9 AS DOUBLE) / 2 AS dose, 'mg' AS units, 'daily' AS frequency, o_orderkey % 2 AS prn, "
                  "'no' AS complex, CAST(o_orderkey % 70 AS DECIMAL(20,2)) AS quantity, CAST(o_orderkey % 30 AS DECIMAL(12,2)) AS equivalent_daily_dose FROM orders WHERE o_orderkey % 3 <> 0",
    "moh_bill_patient_bill": "SELECT o_orderkey AS patient_bill_id, CAST(o_orderkey % 5000 AS DECIMAL(20,2)) AS amount, o_orderkey % 2 AS is_paid, o_orderkey % 12 = 1 AS voided FROM orders",
    "moh_bill_consommation": "SELECT o_orderkey * 10 + 1 AS consommation_id, o_orderkey AS patient_bill_id, o_custkey AS beneficiary_id, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 50 END AS third_party_bill_id, "
                             "o_orderkey % 70 AS insurance_bill_id, 1 + o_orderkey % 3 AS creator, CASE WHEN o_orderkey % 17 <> 0 THEN o_orderdate END AS created_date FROM orders "
                             "UNION ALL SELECT o_orderkey * 10 + 2, o_orderkey, o_custkey + 1, NULL, 3, 2, o_orderdate FROM orders WHERE o_orderkey % 6 = 0",
    "moh_bill_beneficiary": "SELECT c_custkey AS beneficiary_id, c_custkey AS patient_id, c_custkey % 300 AS insurance_policy_id FROM customer",
    "moh_bill_third_party_bill": "SELECT CAST(n_nationkey AS BIGINT) AS third_party_bill_id, CAST(n_nationkey * 3 AS DECIMAL(20,2)) AS amount FROM nation",
    "moh_bill_insurance_bill": "SELECT s_suppkey AS insurance_bill_id, CAST(s_suppkey * 2 AS DECIMAL(20,2)) AS amount FROM supplier WHERE s_suppkey < 60",
    "moh_bill_payment": "SELECT o_orderkey AS bill_payment_id, (o_orderkey * 7) % 16000 AS patient_bill_id, CAST(o_orderkey % 900 AS DECIMAL(20,2)) AS amount_paid, o_orderdate AS date_received, "
                        "1 + o_orderkey % 4 AS collector, o_orderkey % 15 = 2 AS voided FROM orders",
    "moh_bill_cash_payment": "SELECT o_orderkey AS cash_payment_id FROM orders WHERE o_orderkey % 3 = 0",
    "moh_bill_deposit_payment": "SELECT o_orderkey AS deposit_payment_id FROM orders WHERE o_orderkey % 4 = 0 UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 40 = 0",
    "moh_bill_payment_refund": "SELECT o_orderkey AS bill_payment_id, 1 + o_orderkey % 4 AS refunded_by, CAST(o_orderkey % 90 AS DECIMAL(20,2)) AS amount_refunded, o_orderkey % 7 = 1 AS voided FROM orders WHERE o_orderkey % 9 = 0",
    "moh_bill_insurance_policy": "SELECT c_custkey AS insurance_policy_id, c_custkey % 5 AS insurance_id, (c_custkey * 3) % 1600 AS owner, CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 3 END AS third_party_id, "
                                 "DATE '2000-01-01' + CAST(c_custkey % 400 AS INT) AS coverage_start_date, DATE '2002-01-01' AS expiration_date FROM customer WHERE c_custkey < 320",
    "moh_bill_insurance": _values("insurance_id, name", "(1, 'Mutuelle')", "(2, 'RAMA')", "(3, 'MMI')"),
    "moh_bill_third_party": "SELECT third_party_id, CAST(rate AS DECIMAL(20,2)) AS rate FROM (VALUES (1, 15), (2, 20)) AS t(third_party_id, rate)",
    "moh_bill_patient_service_bill": "SELECT ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS patient_service_bill_id, l_orderkey * 10 + 1 AS consommation_id, "
                                     "l_partkey % 40 AS billable_service_id, CAST(l_partkey AS DECIMAL(20,2)) AS unit_price, CAST(l_linenumber AS DECIMAL(20,2)) AS quantity, CAST(1 AS DECIMAL(20,2)) AS paid_quantity, "
                                     "l_shipdate AS created_date, l_linenumber % 2 AS is_paid, l_suppkey % 9 = 0 AS voided FROM lineitem",
    "moh_bill_billable_service": "SELECT s_suppkey AS billable_service_id, s_suppkey % 20 AS facility_service_price_id, s_suppkey % 6 AS service_category_id FROM supplier WHERE s_suppkey < 35",
    "moh_bill_facility_service_price": "SELECT CAST(n_nationkey AS BIGINT) AS facility_service_price_id, 'Service ' || n_name AS name FROM nation WHERE n_nationkey < 18",
    "moh_bill_service_category": _values("service_category_id, name", "(1, 'CONSULTATION')", "(2, 'LABORATOIRE')", "(3, 'MEDICAMENTS')"),
}
assert set(TABLES) <= set(SCHEMAS)


def source(spark: SparkSession, sf: str) -> LazyTables:
    """The derived source; tables it does not fill are empty."""
    tables = {n: (lambda _, n=n: spark.createDataFrame([], struct(SCHEMAS[n]))) for n in SCHEMAS if n not in TABLES}
    return LazyTables(tables | {n: (lambda _, n=n, q=q: conform(run(spark, sf, q), SCHEMAS[n])) for n, q in TABLES.items()})


def _flat(name):
    def query(spark, sf):
        return flat_jobs.build_flat(source(spark, sf), flat_jobs.FlatConfig(prefix=PREFIX))[name]
    query.__name__, query.__doc__ = f"o_{name[5:]}", f"The flat table {name} from the derived source, ids prefixed."
    return query


def l3_person_name(spark, sf):
    """L3: the best name of each person."""
    return flat_jobs.lookup_person_name(source(spark, sf))


def l4_provider_name(spark, sf):
    """person's name, provider's name, identifier, 'Unknown'."""
    return flat_jobs.lookup_provider_name(source(spark, sf))


def l5_concept_by_tag(spark, sf):
    """Concept names of the older source version."""
    return flat_jobs.lookup_concept_by_tag(source(spark, sf))


def f23_user(spark, sf):
    """username, else system id, decoded on every encounter."""
    s = source(spark, sf)
    from .. import operators as O
    return O.decode(s["encounter"].select("encounter_id", "creator"), flat_jobs.lookup_user(s), "creator", "source_key", "target_value", "created_by")


def r_location(spark, sf):
    """R-LOC."""
    return rwanda.rw_location(source(spark, sf), PREFIX)


def r_order(spark, sf):
    """R-ORD: orders with extension, set, drug and decoded names."""
    s = source(spark, sf)
    return rwanda.rw_order(s, flat_jobs.lookups(s), PREFIX)


def r_order_group(spark, sf):
    """R-OGR."""
    return rwanda.rw_order_group(source(spark, sf), PREFIX)


def r_bill(spark, sf):
    """R-BILL."""
    return rwanda.rw_bill(source(spark, sf))


def r_payment(spark, sf):
    """R-PAY."""
    return rwanda.rw_payment(source(spark, sf))


def r_refund(spark, sf):
    """R-REF."""
    return rwanda.rw_refund(source(spark, sf))


def r_insurance_policy(spark, sf):
    """R-INS."""
    return rwanda.rw_insurance_policy(source(spark, sf))


def r_patient_service(spark, sf):
    """R-SVC."""
    return rwanda.rw_patient_service(source(spark, sf))


def lb1_mh_encounter(spark, sf):
    """LB1: mental-health encounters with their answers by reference term."""
    return liberia.mh_encounter(source(spark, sf), prefix=PREFIX).select("encounter_id", "patient_id", "encounter_datetime", "visit_id", "pregnant", "phq_9", "return_visit_date",
                                                                          "referral_role_doctor", "referral_role_nurse", "intervention_psychotherapy")


def lb2_prescriptions(spark, sf):
    """LB2."""
    return liberia.rx_prescriptions(source(spark, sf))


def lb3_program_statistics(spark, sf):
    """LB3."""
    return liberia.program_statistics(source(spark, sf))


def lb4_program_enrollment(spark, sf):
    """LB4."""
    return liberia.program_enrollment(source(spark, sf)).select("program_enrollment_id", "patient_id", "program_name", "date_enrolled", "date_completed", "location_name",
                                                                 "outcome_concept_name", "voided", "uuid")


def x4_patient_facility(spark, sf):
    """Each person's facility by the newest health-centre attribute."""
    s = source(spark, sf)
    return unify.patient_fosa(s["person_attribute"], s["location_fosa"])


SITES = ["a0001", "a0002", "a0003"]        # a0002 has no folder


def site_folders(spark: SparkSession, sf: str, tables) -> str:
    """The named tables as folders of two sites whose ids are the same; the second
    names its places its own way.  (A copy of the source in the shared scratch folder.)"""
    root = scratch_table_path(spark, "sites")
    src = source(spark, sf)
    for site in (SITES[0], SITES[2]):
        for name in tables:
            df = src[name]
            if site == SITES[2] and name == "location":
                df = df.selectExpr("location_id", "name || ' (3)' AS name")
            df.write.parquet(f"{root}/{site}/{name}")
    return root


_FACILITY = ("person_attribute", "location_fosa")


def x3_identifiers(spark, sf):
    """Identifiers of all sites by one plan, with site and facility."""
    root = site_folders(spark, sf, ("patient", "patient_identifier", "patient_identifier_type", "location", *_FACILITY))
    return unify.unified(spark, root, SITES)["omrs_patient_identifier"]


def x3_visits(spark, sf):
    """Visits of all sites by one plan."""
    root = site_folders(spark, sf, ("visit", "visit_type", "location", *_FACILITY))
    return unify.unified(spark, root, SITES)["omrs_visit"]


def x6_encounters(spark, sf):
    """Encounters of the cohort of one programme, or of cohort types or without a type."""
    flat = flat_jobs.build_flat(source(spark, sf), flat_jobs.FlatConfig(prefix=PREFIX))
    kept = unify.retain_hiv_cohort({k: flat[k] for k in ("omrs_program_enrollment", "omrs_encounter")})
    return kept["omrs_encounter"].select("encounter_id", "patient_id", "encounter_type")


FLAT_TABLES = ("omrs_patient", "omrs_patient_identifier", "omrs_relationship", "omrs_encounter_provider", "omrs_encounter", "omrs_visit", "omrs_obs", "omrs_obs_group",
               "omrs_program_enrollment")
QUERIES = {f.__name__: f for f in (*map(_flat, FLAT_TABLES), l3_person_name, l4_provider_name, l5_concept_by_tag, f23_user, r_location, r_order, r_order_group, r_bill,
                                   r_payment, r_refund, r_insurance_policy, r_patient_service, lb1_mh_encounter, lb2_prescriptions, lb3_program_statistics,
                                   lb4_program_enrollment, x4_patient_facility, x3_identifiers, x3_visits, x6_encounters)}

"""An EMR-shaped source derived by Spark from the driver's test tables, so the
warehouse jobs themselves (flat layer, star schema, form tables, registers)
run over the whole test tables and grow with them.

Role map (FIXTURES §3): person/patient = customer, encounter = order (type =
priority, location = the customer's nation), observations = order lines
(concept = return flag, value = extended price, time = ship date), events
(concept = event type, value, time = ts, no encounter) and one status
observation per order; programme enrollment = the customer's market segment
from the first order to the last finished order; programme states = one per
order, ended by the customer's next order (an as-of join).  Ids come from the
source keys or from 64-bit hashes of natural keys; every name table is the
distinct values found in the data.  Tables are built lazily, one at a time.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as H
from .. import operators as O
from ..operators.pivot import PivotColumn as C
from ..schemas import SOURCE, conform
from ..session import written
from .forms import FormSpec
from .lazy import LazyTables

LINE_OBS_BASE = 1 << 60     # line observation ids are this + 60 bits of the line's md5
ORDER_OBS_BASE = 2_000_000_000_000
APPT_OBS_BASE = 3_000_000_000_000
APPT_CONCEPT = "Appointment date"
CREATED = "2000-01-01 00:00:00"
STATUS_CONCEPT = "order status"


def _names(values: DataFrame, col: str, key: str) -> DataFrame:
    """A name table (id, name) over the distinct values of ``col``; the id is a
    64-bit hash of the name, computed row-locally (no numbering pass)."""
    return values.select(F.col(col).alias("name")).distinct().select(H.stable_key("name").alias(key), "name")


class _Derived:
    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf
        self.created = F.lit(CREATED).cast("timestamp_ntz")

    def _t(self, name):
        from .testbed import _t
        return _t(self.spark, self.sf, name)

    @cached_property
    def c(self):
        return self._t("customer")

    @cached_property
    def o(self):
        return self._t("orders")

    @cached_property
    def concepts(self):
        li, ev = self._t("lineitem"), self._t("events")
        vocab = O.union_distinct([li.select(F.col("l_returnflag").alias("v")), li.select(F.col("l_linestatus").alias("v")),
                                  ev.select(F.col("event_type").alias("v")), self.o.select(F.col("o_orderstatus").alias("v")),
                                  self.c.select(F.col("c_mktsegment").alias("v")),
                                  self.o.select(F.lit(STATUS_CONCEPT).alias("v")),
                                  self.o.select(F.lit(APPT_CONCEPT).alias("v"))])
        return written(_names(vocab, "v", "concept_id").coalesce(1), "concepts")    # three name tables come from these

    def cid(self, as_name):
        return self.concepts.select(F.col("name").alias(as_name), "concept_id")

    @staticmethod
    def key(col):
        """The id of a name, computed row-locally (the same hash the name tables use)."""
        return H.stable_key(col)

    @cached_property
    def etypes(self):
        return _names(self.o, "o_orderpriority", "encounter_type_id")

    # ---------------------------------------------------------------- tables
    def person(self):
        return self.c.select(
            F.col("c_custkey").alias("person_id"), F.md5(F.col("c_custkey").cast("string")).alias("uuid"),
            F.when(F.col("c_acctbal") >= 0, "F").otherwise("M").alias("gender"),
            F.add_months(F.lit("1940-01-01").cast("date"), (F.col("c_nationkey") * 13).cast("int")).alias("birthdate"),
            F.lit(False).alias("birthdate_estimated"), F.lit(False).alias("dead"),
            F.lit(None).cast("date").alias("death_date"), F.lit(None).cast("long").alias("cause_of_death"),
            F.lit(False).alias("voided"), self.created.alias("date_created"))

    def patient(self):
        return self.c.select(F.col("c_custkey").alias("patient_id"), F.lit(False).alias("voided"),
                             self.created.alias("date_created"))

    def person_name(self):
        return self.c.select(
            F.col("c_custkey").alias("person_name_id"), F.col("c_custkey").alias("person_id"),
            F.col("c_name").alias("given_name"), F.col("c_mktsegment").alias("family_name"),
            F.lit(True).alias("preferred"), F.lit(False).alias("voided"), self.created.alias("date_created"))

    def location(self):
        return self._t("nation").select(F.col("n_nationkey").cast("long").alias("location_id"),
                                        F.col("n_name").alias("name"))

    def encounter_type(self):
        return self.etypes.select("encounter_type_id", "name")

    def encounter(self):
        oc = self.o.join(self.c.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
        oc = oc.withColumn("encounter_type_id", self.key("o_orderpriority"))
        return oc.select(
            F.col("o_orderkey").alias("encounter_id"),
            F.md5(F.concat(F.lit("e"), F.col("o_orderkey").cast("string"))).alias("uuid"),
            F.col("o_custkey").alias("patient_id"), F.col("encounter_type_id").alias("encounter_type"),
            F.lit(1).cast("long").alias("form_id"), F.col("c_nationkey").cast("long").alias("location_id"),
            F.col("o_orderdate").alias("encounter_datetime"), F.lit(1).cast("long").alias("creator"),
            F.lit(False).alias("voided"), F.col("o_orderdate").alias("date_created"))

    def concept(self):
        return self.concepts.select("concept_id")

    def concept_name(self):
        return self.concepts.select(
            F.col("concept_id").alias("concept_name_id"), "concept_id", "name", F.lit("en").alias("locale"),
            F.lit(True).alias("locale_preferred"), F.lit("FULLY_SPECIFIED").alias("concept_name_type"),
            F.lit(False).alias("voided"), self.created.alias("date_created"))

    def obs(self):
        li = self._t("lineitem")
        line_key = [*[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                    F.date_format("l_shipdate", "yyyy-MM-dd"), F.col("l_returnflag"), F.col("l_linestatus")]
        bits = F.conv(F.substring(F.md5(F.concat_ws("|", *line_key)), 1, 15), 16, 10).cast("long")
        lines = (li.withColumn("__lid", bits)
                 .withColumn("concept_id", self.key("l_returnflag"))
                 .join(self.o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey"))
        line_obs = lines.select(
            (F.lit(LINE_OBS_BASE) + F.col("__lid")).alias("obs_id"), F.col("o_custkey").alias("person_id"),
            F.col("l_orderkey").alias("encounter_id"), "concept_id", F.col("l_shipdate").alias("obs_datetime"),
            F.col("l_extendedprice").alias("value_numeric"), F.lit(False).alias("voided"),
            F.col("l_shipdate").alias("date_created"))
        event_obs = self._t("events").withColumn("concept_id", self.key("event_type")).select(
            F.col("event_id").alias("obs_id"), F.col("user_id").alias("person_id"), "concept_id",
            F.col("ts").alias("obs_datetime"), F.col("value").alias("value_numeric"), F.lit(False).alias("voided"),
            F.col("ts").alias("date_created"))
        order_obs = self.o.select(
            (F.lit(ORDER_OBS_BASE) + F.col("o_orderkey")).alias("obs_id"), F.col("o_custkey").alias("person_id"),
            F.col("o_orderkey").alias("encounter_id"), self.key(F.lit(STATUS_CONCEPT)).alias("concept_id"),
            F.col("o_orderdate").alias("obs_datetime"), self.key("o_orderstatus").alias("value_coded"),
            F.lit(False).alias("voided"), F.col("o_orderdate").alias("date_created"))
        # the appointment set at each order: its last ship date (orders without lines set none)
        appt_obs = (li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("__appt"))
                    .join(self.o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"), "l_orderkey")
                    .select((F.lit(APPT_OBS_BASE) + F.col("l_orderkey")).alias("obs_id"),
                            F.col("o_custkey").alias("person_id"), F.col("l_orderkey").alias("encounter_id"),
                            self.key(F.lit(APPT_CONCEPT)).alias("concept_id"), F.col("o_orderdate").alias("obs_datetime"),
                            F.col("__appt").alias("value_datetime"), F.lit(False).alias("voided"),
                            F.col("o_orderdate").alias("date_created")))
        return (line_obs.unionByName(event_obs, allowMissingColumns=True)
                .unionByName(order_obs, allowMissingColumns=True).unionByName(appt_obs, allowMissingColumns=True))

    def program(self):
        return self.c.select("c_mktsegment").distinct().select(
            self.key("c_mktsegment").alias("program_id"), self.key("c_mktsegment").alias("concept_id"),
            F.col("c_mktsegment").alias("name"))

    def patient_program(self):
        span = self.o.groupBy("o_custkey").agg(
            F.min("o_orderdate").alias("__first"),
            F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))).alias("__done"))
        pp = self.c.join(span, self.c["c_custkey"] == span["o_custkey"])
        return pp.select(
            F.col("c_custkey").alias("patient_program_id"),
            F.md5(F.concat(F.lit("pp"), F.col("c_custkey").cast("string"))).alias("uuid"),
            F.col("c_custkey").alias("patient_id"), self.key("c_mktsegment").alias("program_id"),
            F.to_date("__first").alias("date_enrolled"), F.to_date("__done").alias("date_completed"),
            F.col("c_nationkey").cast("long").alias("location_id"), F.lit(False).alias("voided"))

    @staticmethod
    def _one_from(col):
        """The workflow id 1 written as an expression of a data column: a literal
        on both sides would let the optimizer fold the join condition away and
        plan a cartesian product instead of an equi-join."""
        return (F.length(F.col(col)) * 0 + 1).cast("long")

    def program_workflow(self):
        return self.concepts.where(F.col("name") == STATUS_CONCEPT).select(
            self._one_from("name").alias("program_workflow_id"), "concept_id")

    def program_workflow_state(self):
        st = self.o.select("o_orderstatus").distinct()
        return st.select(self.key("o_orderstatus").alias("program_workflow_state_id"),
                         self._one_from("o_orderstatus").alias("program_workflow_id"),
                         self.key("o_orderstatus").alias("concept_id"))

    def patient_state(self):
        o = self.o.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
        nxt = O.asof_join(o, o.select("o_custkey", F.col("o_orderdate").alias("__nd"), F.col("o_orderkey").alias("__nk")),
                          ["o_custkey"], "o_orderdate", "__nd", ["__nd"], direction="forward", inclusive=False,
                          tiebreak="__nk", bucket="adaptive", prefix="next")
        states = nxt.withColumn("__state", self.key("o_orderstatus"))
        return states.select(
            F.col("o_orderkey").alias("patient_state_id"),
            F.md5(F.concat(F.lit("ps"), F.col("o_orderkey").cast("string"))).alias("uuid"),
            F.col("o_custkey").alias("patient_program_id"), F.col("__state").alias("state"),
            F.to_date("o_orderdate").alias("start_date"), F.to_date("next__nd").alias("end_date"),
            F.lit(False).alias("voided"))


# name tables: small, read by every decode, and files in a real source
NAME_TABLES = ("concept", "concept_name", "encounter_type", "program", "program_workflow", "program_workflow_state")


def emr_source(spark: SparkSession, sf: str) -> LazyTables:
    """The derived source as a lazy mapping; tables the role map does not fill are
    empty.  Name tables are written when first read, so that each decode scans a
    small file instead of deriving the names from the data again."""
    d = _Derived(spark, sf)

    def builder(name):
        def build(_):
            fn = getattr(d, name, None)
            if fn is None:
                return spark.createDataFrame([], SOURCE[name])
            table = conform(fn(), SOURCE[name])
            return written(table.coalesce(1), name) if name in NAME_TABLES else table
        return build
    return LazyTables({k: builder(k) for k in SOURCE})


# Visits of every encounter type with the appointment set there (the visit table of the reports).
VISITS_FORM = FormSpec(
    "emr_visits", "visit_id", ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
    (C("next_appointment_date", APPT_CONCEPT, "value_date", agg="min"),), untyped=frozenset({"next_appointment_date"}))

# A form over the derived vocabulary: urgent-order visits with the cheapest line per return flag.
URGENT_FORM = FormSpec(
    "emr_urgent_visits", "urgent_visit_id", ("1-URGENT",),
    (C("min_price_a", "A", "value_numeric", agg="min"), C("min_price_n", "N", "value_numeric", agg="min"),
     C("min_price_r", "R", "value_numeric", agg="min"), C("status", STATUS_CONCEPT, "value_coded"),
     C("n_lines", ("A", "N", "R"), "value_numeric", agg="count", cast="long")))

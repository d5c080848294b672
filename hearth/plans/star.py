"""Star schema over the flat layer (D-*, X-EVENT, X-CODED, X-DATE, X-NUM).

Dimensions are distinct values numbered with ``dense_key`` (a parallel
ordered numbering, no single-partition window).  Their size is bounded by
their domain, not by the data: dates span decades (tens of thousands of
rows), times of day at most 86,400, ages a few thousand, names the
vocabulary -- so fact joins against them are broadcast joins in practice
(AQE decides from measured size).  Name dimensions fold case, as the source
database's collation does.  The three value facts share one scan of
``omrs_obs`` (Catalyst reuses the scan when the plans are run together).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as H
from .. import operators as O
from .lazy import LazyTables

EVENTS = ["Program Enrollment", "Program Completion", "Patient Encounter", "Patient Born", "Patient Died"]
GENDERS = [("M", "Male"), ("F", "Female")]


def dim_date(flat: dict) -> DataFrame:
    """D-DATE: every date used anywhere (null included, as the source UNION keeps it)."""
    sources = [("omrs_patient", ["birthdate", "death_date"]), ("omrs_program_enrollment", ["enrollment_date", "completion_date"]),
               ("omrs_program_state", ["start_date", "end_date"]), ("omrs_encounter", ["encounter_date"]), ("omrs_obs", ["obs_date", "value_date"])]
    # one pass over each table, whatever the number of its dates
    dates = O.union_distinct([flat[t].select(F.explode(F.array(*cols)).alias("full_date")) for t, cols in sources])
    keyed = O.dense_key(dates, ["full_date"], "date_id")
    return keyed.select("date_id", "full_date", F.year("full_date").alias("year"),
                        F.month("full_date").alias("month"), F.dayofmonth("full_date").alias("day"))


def dim_time(flat: dict) -> DataFrame:
    """D-TIME: every time of day used by encounters and observations."""
    times = O.union_distinct([flat["omrs_encounter"].select(F.col("encounter_time").alias("full_time")),
                              flat["omrs_obs"].select(F.col("obs_time").alias("full_time"))])
    keyed = O.dense_key(times, ["full_time"], "time_id")
    parts = F.split(F.col("full_time"), ":")
    return keyed.select("time_id", "full_time", parts[0].cast("int").alias("hour"),
                        parts[1].cast("int").alias("minute"), parts[2].cast("int").alias("second"))


def dim_age(flat: dict) -> DataFrame:
    """D-AGE: distinct (years, months) ages; each source pair is kept when its
    own months value is present (the source tests the enrollment column for
    completion ages -- the build tests the selected one)."""
    def pairs(table, *events):
        both = [F.struct(F.col(f"age_years_at_{x}").alias("full_years"), F.col(f"age_months_at_{x}").alias("full_months")) for x in events]
        return flat[table].select(F.explode(F.array(*both)).alias("a")).select("a.*").where(F.col("full_months").isNotNull())

    ages = O.union_distinct([
        pairs("omrs_patient", "death"), pairs("omrs_program_enrollment", "enrollment", "completion"),
        pairs("omrs_program_state", "start", "end"), pairs("omrs_encounter", "encounter"), pairs("omrs_obs", "obs")])
    return O.dense_key(ages, ["full_years", "full_months"], "age_id").select("age_id", "full_years", "full_months")


def name_dim(values: DataFrame, key: str) -> DataFrame:
    """D-LOC / D-PROG / D-ETYPE / D-CQ / D-CV / D-DQ / D-NQ: distinct names in
    name order (O3), case variants folded to one row (smallest spelling kept)."""
    v = values.where(F.col("name").isNotNull()).groupBy(H.fold("name").alias("__fold")).agg(F.min("name").alias("name"))
    return O.dense_key(v, ["name"], key).select(key, "name")


def dim_event(spark: SparkSession) -> DataFrame:
    """D-EVENT: literal event names, numbered in listed order."""
    return spark.createDataFrame([(i + 1, n) for i, n in enumerate(EVENTS)], "event_id long, name string")


def dim_gender(spark: SparkSession) -> DataFrame:
    """D-GENDER: literal gender codes."""
    return spark.createDataFrame([(i + 1, c, n) for i, (c, n) in enumerate(GENDERS)],
                                 "gender_id long, code string, name_en string")


def dim_patient(flat: dict, ddate: DataFrame) -> DataFrame:
    """D-PAT: patients with birth and death date ids (two left joins to D-DATE)."""
    p = flat["omrs_patient"].select("patient_id", "patient_uuid", "gender", "birthdate", "dead", "death_date")
    d1 = ddate.select(F.col("full_date").alias("birthdate"), F.col("date_id").alias("birthdate_id"))
    d2 = ddate.select(F.col("full_date").alias("death_date"), F.col("date_id").alias("death_date_id"))
    return p.join(d1, "birthdate", "left").join(d2, "death_date", "left").select(
        "patient_id", "patient_uuid", "gender", "birthdate", "birthdate_id", "dead", "death_date", "death_date_id")


def _answers(value: str, name: str):
    """Distinct names among the observations that hold an answer of one type."""
    return lambda spark, flat: flat["omrs_obs"].where(F.col(value).isNotNull()).select(F.col(name).alias("name"))


def _column(table: str, column: str):
    return lambda spark, flat: flat[table].select(F.col(column).alias("name"))


NAME_DIMENSIONS = {
    "dim_location": ("location_id", _column("lookup_location", "target_value")),
    "dim_program": ("program_id", _column("omrs_program_enrollment", "program")),
    "dim_encounter_type": ("encounter_type_id", _column("omrs_encounter", "encounter_type")),
    "dim_coded_question": ("coded_question_id", _answers("value_coded", "concept")),
    "dim_coded_value": ("coded_value_id", _answers("value_coded", "value_coded")),
    "dim_date_question": ("date_question_id", _answers("value_date", "concept")),
    "dim_numeric_question": ("numeric_question_id", _answers("value_numeric", "concept")),
}


def _by_name(df: DataFrame, dim: DataFrame, col: str, key: str, how: str = "left") -> DataFrame:
    d = dim.select(H.fold("name").alias("__n"), F.col(key))
    return df.join(d, H.fold(col) == d["__n"], how).drop("__n")


def _common(df: DataFrame, dims: dict, age_y: str | None, age_m: str | None,
            date_col: str, time_col: str | None, loc_col: str | None) -> DataFrame:
    """Star joins shared by every fact: left on age, date, time, location (J6); ``_fact`` adds the patient's."""
    x = df
    if age_y:
        a = dims["dim_age"]
        x = x.join(a, (x[age_y] == a["full_years"]) & (x[age_m] == a["full_months"]), "left") \
            .drop("full_years", "full_months")
    d = dims["dim_date"].select(F.col("full_date").alias("__d"), "date_id")
    x = x.join(d, x[date_col] == d["__d"], "left").drop("__d")
    if time_col:
        t = dims["dim_time"].select(F.col("full_time").alias("__t"), "time_id")
        x = x.join(t, x[time_col] == t["__t"], "left").drop("__t")
    if loc_col:
        x = _by_name(x, dims["dim_location"], loc_col, "location_id")
    return x


FACT_COLS = ["patient_id", "gender_id", "age_id", "date_id", "time_id", "location_id", "program_id",
             "encounter_type_id"]


def _fact(x: DataFrame, flat: dict, dims: dict, extra: list[str]) -> DataFrame:
    """The fact's columns, with the joins on patient (inner) and gender (left).  These come
    last: patients are a table of data size, and here a row is its ids and moves at its smallest."""
    own = [c for c in FACT_COLS + extra if c in x.columns]
    pat = flat["omrs_patient"].select("patient_id", F.col("gender").alias("__gender"))   # D-PAT has these rows
    g = dims["dim_gender"].select(H.fold("code").alias("__g"), "gender_id")
    x = x.select(*own).join(pat, "patient_id", "inner").join(g, H.fold("__gender") == g["__g"], "left")
    return x.select(*[F.col(c) if c in x.columns else F.lit(None).cast("long").alias(c) for c in FACT_COLS + extra])


def fact_patient_event(flat: dict, dims: dict) -> DataFrame:
    """X-EVENT: births, deaths, encounters, enrollments, completions as one
    union; program only on program events, time and type only on encounters."""
    ev = {r: i + 1 for i, r in enumerate(EVENTS)}
    p = flat["omrs_patient"].select("patient_id", "birthdate", "death_date")
    born = _common(p.where(F.col("birthdate").isNotNull()), dims, None, None, "birthdate", None, None)
    died = _common(p.where(F.col("death_date").isNotNull()), dims, None, None, "death_date", None, None)
    e = flat["omrs_encounter"].where(F.col("encounter_date").isNotNull())
    enc = _common(e, dims, "age_years_at_encounter", "age_months_at_encounter", "encounter_date",
                  "encounter_time", "location")
    enc = _by_name(enc, dims["dim_encounter_type"], "encounter_type", "encounter_type_id", "inner")
    en = flat["omrs_program_enrollment"]
    enrol = _common(en.where(F.col("enrollment_date").isNotNull()), dims, "age_years_at_enrollment",
                    "age_months_at_enrollment", "enrollment_date", None, "location")
    enrol = _by_name(enrol, dims["dim_program"], "program", "program_id", "inner")
    comp = _common(en.where(F.col("completion_date").isNotNull()), dims, "age_years_at_completion",
                   "age_months_at_completion", "completion_date", None, "location")
    comp = _by_name(comp, dims["dim_program"], "program", "program_id", "inner")
    parts = [(born, "Patient Born"), (died, "Patient Died"), (enc, "Patient Encounter"),
             (enrol, "Program Enrollment"), (comp, "Program Completion")]
    out = None
    for df, name in parts:
        f = _fact(df.withColumn("event_id", F.lit(ev[name]).cast("long")), flat, dims, ["event_id"])
        out = f if out is None else out.unionByName(f)
    return out


def _value_fact(flat: dict, dims: dict, value_col: str, qdim: str, qkey: str, vdim: str | None,
                vkey: str | None, extra_value: str | None) -> DataFrame:
    o = O.typed_value_filter(flat["omrs_obs"], value_col)
    x = _common(o, dims, "age_years_at_obs", "age_months_at_obs", "obs_date", "obs_time", "location")
    x = _by_name(x, dims["dim_encounter_type"], "encounter_type", "encounter_type_id")
    x = _by_name(x, dims[qdim], "concept", qkey, "inner")
    extra = [qkey]
    if vdim:
        x = _by_name(x, dims[vdim], value_col, vkey, "inner")
        extra.append(vkey)
    if extra_value:
        x = x.withColumnRenamed(value_col, extra_value)
        extra.append(extra_value)
    return _fact(x, flat, dims, extra)


def fact_coded(flat, dims):
    """X-CODED: coded answers, question and value decoded to dimension ids."""
    return _value_fact(flat, dims, "value_coded", "dim_coded_question", "coded_question_id", "dim_coded_value",
                       "coded_value_id", None)


def fact_date(flat, dims):
    """X-DATE: date answers with the question id and the date value."""
    return _value_fact(flat, dims, "value_date", "dim_date_question", "date_question_id", None, None, "date_value")


def fact_numeric(flat, dims):
    """X-NUM: numeric answers with the question id and the value."""
    return _value_fact(flat, dims, "value_numeric", "dim_numeric_question", "numeric_question_id", None, None,
                       "numeric_value")


def build_star(spark: SparkSession, flat: dict, stored: Callable[[str, DataFrame], DataFrame] | None = None) -> LazyTables:
    """The star schema as a lazy mapping: a dimension or fact is planned when it
    is first read, and a fact plans only the dimensions it joins.

    Without ``stored`` nothing runs before the caller's action.  ``stored(name,
    df)`` writes a dimension and returns the written table (its size is then
    known to the planner): a refresh passes the writer of its star layer, so
    each dimension is built once and every fact reads it back."""
    keep = stored or (lambda name, df: df)
    dims: dict[str, Callable] = {
        "dim_date": lambda t: dim_date(flat),
        "dim_time": lambda t: dim_time(flat),
        "dim_age": lambda t: dim_age(flat),
        "dim_event": lambda t: dim_event(spark),
        "dim_gender": lambda t: dim_gender(spark),
        "dim_patient": lambda t: dim_patient(flat, t["dim_date"]),
        **{name: (lambda t, key=key, of=of: name_dim(of(spark, flat), key)) for name, (key, of) in NAME_DIMENSIONS.items()},
    }
    return LazyTables({
        **{name: (lambda t, name=name, build=build: keep(name, build(t))) for name, build in dims.items()},
        "fact_patient_event": lambda t: fact_patient_event(flat, t),
        "fact_patient_coded_value": lambda t: fact_coded(flat, t),
        "fact_patient_date_value": lambda t: fact_date(flat, t),
        "fact_patient_numeric_value": lambda t: fact_numeric(flat, t)})

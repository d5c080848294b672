"""Operator tests on inline rows: null keys, ties, empty groups, open intervals,
case differences (SURVEY §5 item 1)."""

import datetime as dt

from pyspark.sql import functions as F

from hearth import operators as O

from .conftest import rows

D = dt.date


def test_best_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame([
        (1, 10, D(2020, 1, 1)), (1, 11, D(2020, 1, 1)), (1, 12, D(2019, 1, 1)),
        (2, 20, None), (2, 21, D(2018, 5, 5)), (None, 30, D(2020, 1, 1))], "p long, id long, d date")
    latest = O.latest_per_key(df, "p", "d", "id")
    assert rows(latest, "p", "id") == [(None, 30), (1, 11), (2, 21)]
    second = O.nth_latest(df, "p", "d", n=1, tiebreak="id")
    assert rows(second, "p", "id") == [(1, 10)]
    assert rows(O.any_per_key(df, "p", "id"), "p", "id") == [(None, 30), (1, 10), (2, 20)]
    ties = O.ties_at_extreme(df, ["p"], "d")
    assert rows(ties, "p", "id") == [(None, 30), (1, 10), (1, 11), (2, 21)]


def test_latest_vs_previous_and_value_at_latest(spark):
    df = spark.createDataFrame([(1, 1, D(2020, 1, 1), 5.0), (1, 2, D(2020, 2, 1), 7.0), (1, 3, D(2020, 2, 1), 9.0),
                                (2, 4, D(2020, 1, 1), 1.0)], "p long, id long, d date, v double")
    lv = O.latest_vs_previous(df, ["p"], "d", "v", "id", last_date=None, prev_date=None)
    assert rows(lv, "p", "last_value", "previous_value") == [(1, 9.0, 7.0), (2, 1.0, None)]
    va = O.value_at_latest(df, ["p"], "d", "id", ["v"], prefix="last_")
    assert rows(va, "p", "last_date", "last_v") == [(1, D(2020, 2, 1), 9.0), (2, D(2020, 1, 1), 1.0)]


def test_current_state_at_open_intervals(spark):
    df = spark.createDataFrame([
        (1, 1, D(2020, 1, 1), D(2020, 6, 1)), (1, 2, D(2020, 3, 1), None), (1, 3, D(2020, 3, 1), D(2020, 4, 1)),
        (2, 4, D(2020, 1, 1), D(2020, 2, 1))], "p long, id long, s date, e date")
    cur = O.current_state_at(df, ["p"], "s", "e", F.lit(D(2020, 5, 1)), [F.col("id").desc()])
    assert rows(cur, "p", "id") == [(1, 2)]


def _asof_frames(spark):
    left = spark.createDataFrame([
        (1, 1, dt.datetime(2020, 1, 1, 10)), (2, 1, dt.datetime(2020, 1, 1, 12)), (3, 1, dt.datetime(2020, 1, 3, 9)),
        (4, 2, dt.datetime(2020, 1, 1, 0)), (5, 1, None), (6, None, dt.datetime(2020, 1, 1, 0)),
        (7, 1, dt.datetime(2020, 2, 1, 0))], "lid long, g long, t timestamp_ntz")
    right = spark.createDataFrame([
        (100, 1, dt.datetime(2020, 1, 1, 12)), (101, 1, dt.datetime(2020, 1, 1, 12)),
        (102, 1, dt.datetime(2020, 1, 5, 0)), (103, None, dt.datetime(2020, 1, 1, 0)),
        (104, 1, dt.datetime(2019, 12, 31, 0))], "rid long, g long, rt timestamp_ntz")
    return left, right


def test_asof_forward_inclusive_with_and_without_buckets(spark):
    left, right = _asof_frames(spark)
    expect = [(1, 100), (2, 100), (3, 102), (4, None), (5, None), (6, None), (7, None)]
    for bucket in (None, "day", "month"):
        out = O.asof_join(left, right, ["g"], "t", "rt", ["rid"], "forward", True, "rid", bucket)
        assert rows(out, "lid", "rid") == expect, bucket


def test_asof_forward_exclusive_and_backward(spark):
    left, right = _asof_frames(spark)
    for bucket in (None, "day"):
        ex = O.asof_join(left, right, ["g"], "t", "rt", ["rid"], "forward", False, "rid", bucket)
        assert rows(ex, "lid", "rid") == [(1, 100), (2, 102), (3, 102), (4, None), (5, None), (6, None), (7, None)]
        bw = O.asof_join(left, right, ["g"], "t", "rt", ["rid"], "backward", True, "rid", bucket)
        assert rows(bw, "lid", "rid") == [(1, 104), (2, 101), (3, 101), (4, None), (5, None), (6, None), (7, 102)]


def test_first_after_last_other(spark):
    df = spark.createDataFrame([
        (1, D(2020, 1, 1), "F"), (1, D(2020, 2, 1), "O"), (1, D(2020, 2, 1), "F"), (1, D(2020, 3, 1), "F"),
        (2, D(2020, 1, 1), "F"), (2, D(2020, 5, 1), "F"), (3, D(2020, 1, 1), "O")], "k long, d date, s string")
    out = O.first_after_last_other(df, ["k"], "d", "s", "F")
    assert rows(out) == [(1, D(2020, 2, 1)), (2, D(2020, 1, 1))]
    strict = O.first_after_last_other(df, ["k"], "d", "s", "F", strict=True)
    assert rows(strict) == [(1, D(2020, 3, 1)), (2, D(2020, 1, 1))]


def test_period_snapshots(spark):
    periods = O.quarter_periods(spark, "2020-01-01", "2020-12-31")
    obs = spark.createDataFrame([
        (1, 1, D(2020, 2, 1)), (1, 2, D(2020, 2, 1)), (1, 3, D(2020, 8, 1)), (2, 4, D(2019, 5, 1)),
        (3, 5, D(2021, 1, 5))], "p long, id long, d date")
    snap = O.snapshot_latest_per_period(obs, ["p"], "d", periods)
    got = rows(snap, "p", "end_date", "id")
    assert got == [(1, D(2020, 3, 31), 1), (1, D(2020, 3, 31), 2), (1, D(2020, 6, 30), 1), (1, D(2020, 6, 30), 2),
                   (1, D(2020, 9, 30), 3), (1, D(2020, 12, 31), 3),
                   (2, D(2020, 3, 31), 4), (2, D(2020, 6, 30), 4), (2, D(2020, 9, 30), 4), (2, D(2020, 12, 31), 4)]
    cohort = spark.createDataFrame([(1,), (9,)], "p long")
    blanks = O.snapshot_with_blanks(cohort, obs, ["p"], "d", "id", periods, [])
    got = rows(blanks, "p", "end_date", "id")
    assert got == [(1, D(2020, 3, 31), 1), (1, D(2020, 6, 30), 1), (1, D(2020, 9, 30), 3), (1, D(2020, 12, 31), 3),
                   (9, D(2020, 3, 31), None), (9, D(2020, 6, 30), None), (9, D(2020, 9, 30), None),
                   (9, D(2020, 12, 31), None)]
    counts = O.counts_up_to_period(obs, ["p"], "d", periods, cohort=cohort, out="n")
    assert rows(counts, "p", "end_date", "n")[:4] == [(1, D(2020, 3, 31), 2), (1, D(2020, 6, 30), 2),
                                                      (1, D(2020, 9, 30), 3), (1, D(2020, 12, 31), 3)]


def test_form_pivot_null_safe_spine(spark):
    obs = spark.createDataFrame([
        (1, 1, D(2020, 1, 1), None, "Weight", 60.0, None), (2, 1, D(2020, 1, 1), None, "weight", 61.0, None),
        (3, 1, D(2020, 1, 1), None, "HIV test", None, "Positive"), (4, 2, D(2020, 1, 1), 7, "Weight", 50.0, None)],
        "obs_id long, patient_id long, visit_date date, location long, concept string, value_numeric double, value_coded string")
    spine = spark.createDataFrame([(1, D(2020, 1, 1), None), (2, D(2020, 1, 1), 7), (3, D(2020, 1, 1), None)],
                                  "patient_id long, visit_date date, location long")
    cols = [O.PivotColumn("weight", "WEIGHT", "value_numeric"),
            O.PivotColumn("hiv_positive", "HIV test", None, answer="positive", agg="exists"),
            O.PivotColumn("n_weights", "weight", "value_numeric", agg="count", cast="long")]
    out = O.form_pivot(obs, ["patient_id", "visit_date", "location"], cols, answer_col="value_coded", spine=spine,
                       null_safe=["location"])
    assert rows(out, "patient_id", "weight", "hiv_positive", "n_weights") == [
        (1, 60.0, True, 2), (2, 50.0, False, 1), (3, None, None, None)]


def test_pivot_attributes_newest_wins(spark):
    df = spark.createDataFrame([(1, "Phone", "111", 1), (1, "Phone", "222", 2), (1, "Mother", "Ann", 3),
                                (2, "Other", "x", 4)], "p long, name string, value string, id long")
    out = O.pivot_attributes(df, ["p"], "name", "value", ["Phone", "Mother"], [F.col("id").desc()])
    assert rows(out, "p", "Phone", "Mother") == [(1, "222", "Ann")]


def test_conditional_sums_keep_empty_groups(spark):
    df = spark.createDataFrame([("HIV", "died"), ("HIV", "cured")], "prog string, outcome string")
    progs = spark.createDataFrame([("HIV",), ("TB",)], "prog string")
    out = O.conditional_sums(df, ["prog"], {"died": F.col("outcome") == "died"}, all_keys=progs)
    assert rows(out) == [("HIV", 1), ("TB", 0)]


def test_dense_key_matches_global_order(spark):
    df = spark.range(0, 500).select(((F.col("id") * 7919) % 1000).alias("v"))
    keyed = O.dense_key(df, ["v"], "k")
    got = rows(keyed, "v", "k")
    assert [k for _, k in got] == list(range(1, len(got) + 1))
    assert len(got) == df.distinct().count()


def test_not_in_with_null_in_list(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    b = spark.createDataFrame([(1,)], "k long")
    assert rows(O.anti_not_in(a, b, "k")) == [(2,)]
    b_null = spark.createDataFrame([(1,), (None,)], "k long")
    assert O.anti_not_in(a, b_null, "k").count() == 0
    assert rows(O.semi_in(a, b_null, "k")) == [(1,)]


def test_full_merge_coalesces_keys(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k long, a string")
    b = spark.createDataFrame([(2, "z"), (3, "w")], "k long, b string")
    assert rows(O.full_merge(a, b, ["k"])) == [(1, "x", None), (2, "y", "z"), (3, None, "w")]


def test_retain_cohort_and_filters(spark):
    enc = spark.createDataFrame([(1, 1, "ART"), (2, 2, None), (3, 3, "Other"), (4, 4, "art ")],
                                "id long, p long, t string")
    cohort = spark.createDataFrame([(3,)], "p long")
    out = O.retain_cohort(enc, "p", cohort, "p", "t", ["ART"])
    assert rows(out, "id") == [(1,), (2,), (3,), (4,)]
    out2 = O.retain_cohort(enc, "p", cohort, "p", "t", ["TB"], keep_null_type=False)
    assert rows(out2, "id") == [(3,)]
    flags = spark.createDataFrame([(1, True), (2, None), (3, False)], "id long, f boolean")
    assert rows(O.exclude_flag_null_kept(flags, "f"), "id") == [(2,), (3,)]
    keys = spark.createDataFrame([(9990001,), (123,), (None,)], "id long")
    assert rows(O.delete_by_key_prefix(keys, "id", "999")) == [(None,), (123,)]


def test_two_sided_edges(spark):
    rel = spark.createDataFrame([(1, 2, "Parent", "Child"), (1, 50, "Doctor", "Patient")],
                                "a long, b long, ra string, rb string")
    pats = spark.createDataFrame([(1,), (2,)], "pid long")
    out = O.two_sided_edges(rel, "a", "b", "ra", "rb", pats, "pid")
    assert rows(out) == [(1, 2, "Parent"), (1, 50, "Doctor"), (2, 1, "Child")]


def test_union_helpers(spark):
    a = spark.createDataFrame([(1,), (2,)], "d long")
    b = spark.createDataFrame([(2,), (3,)], "d long")
    assert rows(O.union_distinct([a, b])) == [(1,), (2,), (3,)]
    ru = O.rule_union([("A", a), ("B", b)], ["d"], "label")
    assert rows(ru) == [(1, "A"), (2, "A"), (2, "B"), (3, "B")]
    up = O.upsert_merge([a.withColumn("x", F.lit(1)), b.withColumn("y", F.lit(2))], "d")
    assert rows(up, "d", "x", "y") == [(1, 1, None), (2, 1, 2), (3, None, 2)]


def test_pivot_conditions_combine(spark):
    """Concept, parent-group and required-flag conditions all apply together."""
    obs = spark.createDataFrame([
        (1, 1, "Weight", 60.0, True, "Vitals"), (2, 1, "Weight", 70.0, False, "Vitals"),
        (3, 1, "Weight", 80.0, True, "Other group")],
        "obs_id long, k long, concept string, value_numeric double, typed boolean, group_concept string")
    cols = [O.PivotColumn("w_typed", "Weight", "value_numeric", agg="count", require="typed"),
            O.PivotColumn("w_vitals", "Weight", "value_numeric", agg="max", group="vitals"),
            O.PivotColumn("w_both", "Weight", "value_numeric", agg="max", group="Vitals", require="typed")]
    r = O.form_pivot(obs, ["k"], cols).collect()[0]
    assert (r["w_typed"], r["w_vitals"], r["w_both"]) == (2, 70.0, 60.0)

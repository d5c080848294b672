"""Operators bound to the driver's test tables (FIXTURES §3 role map).

patient = customer, encounter = orders (type = o_orderpriority, status =
o_orderstatus, date = o_orderdate), observation = events (concept =
event_type, value, time = ts, patient = user_id) or lineitem (concept =
l_returnflag, encounter = l_orderkey), periods = quarters 1995Q1-2001Q4.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole tables.  Datetimes are reduced to dates wherever the rule is
date-based, and every computed column has the alias the oracle SQL uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as H
from .. import operators as O

T_ORDER = "1998-06-30"          # as-of date for order-based reports
T_ORDER_END = "1998-09-30"      # end of the expected-patients window
T_EVENT = "2024-01-20 00:00:00"  # as-of time for event-based lookups
Q_FIRST, Q_LAST = "1995-01-01", "2001-12-31"
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
FLAGS = ["A", "N", "R"]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _orders(spark, sf) -> DataFrame:
    return _t(spark, sf, "orders").withColumn("order_date", F.to_date("o_orderdate"))


def _lines(spark, sf) -> DataFrame:
    return _t(spark, sf, "lineitem").withColumn("ship_date", F.to_date("l_shipdate"))


def _quarters(spark) -> DataFrame:
    return O.quarter_periods(spark, Q_FIRST, Q_LAST)


def _last_ship(spark, sf) -> DataFrame:
    return _lines(spark, sf).groupBy("l_orderkey").agg(F.max("ship_date").alias("last_ship"))


def _order_intervals(spark, sf) -> DataFrame:
    """Orders as open intervals ``[order_date, last ship)``; no line -> open end."""
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "order_date")
    ls = _last_ship(spark, sf)
    return o.join(ls, o["o_orderkey"] == ls["l_orderkey"], "left").drop("l_orderkey")


# ---------------------------------------------------------------- aggregation

def a1(spark, sf):
    o = _orders(spark, sf)
    return O.any_per_key(o, "o_custkey", "o_orderkey").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "order_date", "o_totalprice")


def a2(spark, sf):
    o = _orders(spark, sf)
    order = [(F.col("o_orderstatus") == "F").desc(), F.col("order_date").desc(), F.col("o_orderkey").desc()]
    return O.best_per_key(o, "o_custkey", order).select("o_custkey", "o_orderkey", "o_orderstatus", "order_date")


def a3(spark, sf):
    o = _orders(spark, sf)
    return O.best_per_key(o, ["o_custkey", "o_orderpriority"],
                          [F.col("order_date").desc(), F.col("o_orderkey").desc()]).select(
        "o_custkey", "o_orderpriority", "o_orderkey", "order_date")


def a4(spark, sf):
    e = _t(spark, sf, "events")
    return O.pivot_attributes(e, ["user_id"], "event_type", "value", EVENT_TYPES,
                              [F.col("ts").desc(), F.col("event_id").desc()])


def _flag_columns():
    return [O.PivotColumn(f"min_price_{f.lower()}", f, "l_extendedprice", agg="min") for f in FLAGS]


def a5(spark, sf):
    spine = _orders(spark, sf).where((F.col("o_orderpriority") == "1-URGENT")).select(
        "o_orderkey", "o_custkey", "order_date")
    lines = _lines(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    return O.form_pivot(lines, ["o_orderkey"], _flag_columns(), concept_col="l_returnflag",
                        id_col="l_linenumber", spine=spine)


def a6(spark, sf):
    urgent = _orders(spark, sf).where((F.col("o_orderpriority") == "1-URGENT")).select("o_orderkey")
    lines = _lines(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    lines = lines.join(urgent, "o_orderkey", "left_semi")
    cols = _flag_columns() + [O.PivotColumn("n_lines", None, "l_linenumber", agg="count", cast="long")]
    return O.form_pivot(lines, ["o_orderkey", "l_linenumber"], cols, concept_col="l_returnflag",
                        id_col="l_partkey")


def a7(spark, sf):
    e = _t(spark, sf, "events")
    out = O.conditional_max(["user_id"], e, {
        "max_purchase": (F.col("event_type") == "purchase", F.col("value")),
        "max_click": (F.col("event_type") == "click", F.col("value")),
    })
    errs = e.groupBy("user_id").agg(F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0))
                                    .cast("long").alias("n_errors"))
    return out.join(errs, "user_id")


def a8(spark, sf):
    c = _t(spark, sf, "customer")
    o = _orders(spark, sf)
    j = o.join(c.select("c_custkey", "c_mktsegment"), o["o_custkey"] == c["c_custkey"])
    return O.conditional_sums(j, ["c_mktsegment"], {
        "n_f": F.col("o_orderstatus") == "F",
        "n_o": F.col("o_orderstatus") == "O",
        "n_p": F.col("o_orderstatus") == "P",
    }, all_keys=c)


def a9(spark, sf):
    l = _lines(spark, sf)
    return l.groupBy("l_orderkey").agg(F.min("ship_date").alias("first_ship"), F.max("ship_date").alias("last_ship")) \
        .withColumn("planned_end", H.add_days("first_ship", 30))


def a10(spark, sf):
    return O.concat_group(_t(spark, sf, "events"), ["user_id"], "event_type", "event_types", sep=",")


def a11(spark, sf):
    return O.concat_group(_t(spark, sf, "events"), ["user_id"], "event_type", "event_types", sep=", ",
                          distinct=True)


def a12(spark, sf):
    return O.flags_from_set(_t(spark, sf, "events"), ["user_id"], "event_type",
                            {f"has_{t}": t for t in EVENT_TYPES})


def a13(spark, sf):
    return O.all_of_n_present(_t(spark, sf, "events"), ["user_id"], "event_type", EVENT_TYPES, "all_five")


def a14(spark, sf):
    e = _t(spark, sf, "events")
    return O.exists_flag(e, ["user_id"], (F.col("event_type") == "purchase") & (F.col("value") > 400),
                         "has_big_purchase")


def a15(spark, sf):
    return _lines(spark, sf).groupBy("l_partkey", "l_returnflag").agg(F.min("ship_date").alias("first_ship"))


def a16(spark, sf):
    """Max value and earliest date per visit (customer, day) of events."""
    e = _t(spark, sf, "events").withColumn("event_date", F.to_date("ts"))
    return e.groupBy("user_id", "event_date").agg(F.max("value").alias("max_value"),
                                                  F.max("event_type").alias("max_type"),
                                                  F.min("event_id").alias("first_event_id"))


def a19(spark, sf):
    return O.first_after_last_other(_orders(spark, sf), ["o_custkey"], "order_date", "o_orderstatus", "F",
                                    out="first_f_date")


# ---------------------------------------------------------------- windows

def w1(spark, sf):
    e = _t(spark, sf, "events").where(F.col("ts") <= F.lit(T_EVENT).cast("timestamp_ntz"))
    top = O.top_n_per_key(e, "user_id", [F.col("ts").desc(), F.col("event_id").desc()], 3, "nth")
    return top.select("user_id", F.col("nth").cast("long").alias("nth"), "event_id", "event_type", "value")


def w1_offset(spark, sf):
    """W1 as written: ``ORDER BY ts DESC LIMIT 1 OFFSET 1`` per user."""
    e = _t(spark, sf, "events")
    return O.nth_latest(e, "user_id", "ts", n=1, tiebreak="event_id",
                        as_of=F.lit(T_EVENT).cast("timestamp_ntz")).select("user_id", "event_id", "event_type", "value")


def w2(spark, sf):
    return O.latest_per_key(_orders(spark, sf), "o_custkey", "order_date", "o_orderkey").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "order_date")


def w3(spark, sf):
    c = _t(spark, sf, "customer")
    return O.drop_if_latest_state_not(c, "c_custkey", _orders(spark, sf), "o_custkey", "o_orderstatus",
                                      "order_date", "o_orderkey", "F").select("c_custkey", "c_name")


def w4(spark, sf):
    d = _orders(spark, sf).select("order_date")
    return O.dense_key(d, ["order_date"], "date_id")


def w5(spark, sf):
    o = _orders(spark, sf).select("o_custkey", "o_orderstatus", "o_orderkey", "order_date")
    snap = O.snapshot_latest_per_period(o, ["o_custkey", "o_orderstatus"], "order_date", _quarters(spark))
    return snap.select("o_custkey", "o_orderstatus", "end_date", "o_orderkey", "order_date")


def w6(spark, sf):
    cohort = _t(spark, sf, "customer").where((F.col("c_mktsegment") == "BUILDING")).select(
        F.col("c_custkey").alias("o_custkey"))
    o = _orders(spark, sf).select("o_custkey", "o_orderkey", "o_orderstatus", "order_date")
    snap = O.snapshot_with_blanks(cohort, o, ["o_custkey"], "order_date", "o_orderkey", _quarters(spark),
                                  ["o_orderstatus"])
    return snap.select("o_custkey", "end_date", "order_date", "o_orderkey", "o_orderstatus")


def w7(spark, sf):
    o = _orders(spark, sf).where(F.col("o_orderstatus") == "O")
    first = O.value_at_earliest(o, ["o_custkey"], "order_date", "o_orderkey", ["o_orderkey", "o_orderpriority"],
                                prefix="first_o_")
    return first.select("o_custkey", F.col("first_o_date").alias("first_o_date"),
                        F.col("first_o_o_orderkey").alias("first_o_key"),
                        F.col("first_o_o_orderpriority").alias("first_o_priority"))


def w8(spark, sf):
    iv = _order_intervals(spark, sf)
    cur = O.current_state_at(iv, ["o_custkey"], "order_date", "last_ship", F.lit(T_ORDER).cast("date"),
                             [F.col("o_orderkey").desc()])
    return cur.select("o_custkey", "o_orderkey", "order_date", "last_ship")


# ---------------------------------------------------------------- joins

def j1(spark, sf):
    c = _t(spark, sf, "customer")
    x = O.decode(c, _t(spark, sf, "nation"), "c_nationkey", "n_nationkey", "n_name")
    x = x.join(_t(spark, sf, "nation").select(F.col("n_nationkey").alias("__nk"), "n_regionkey"),
               F.col("c_nationkey") == F.col("__nk"), "left")
    x = O.decode(x, _t(spark, sf, "region"), "n_regionkey", "r_regionkey", "r_name")
    return x.select("c_custkey", "c_name", "n_name", "r_name")


def j2(spark, sf):
    s = _t(spark, sf, "supplier")
    x = O.decode_strict(s, _t(spark, sf, "nation"), "s_nationkey", "n_nationkey", "n_name")
    return x.select("s_suppkey", "s_name", "n_name")


def j4(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_name")
    o = _orders(spark, sf).groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("order_date").alias("last_order_date"))
    e = _t(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_events"), F.max("value").alias("max_event_value"))
    return O.left_merge(O.left_merge(c, o, ["c_custkey"]), e, ["c_custkey"])


def j5(spark, sf):
    e = _t(spark, sf, "events")
    p = e.where(F.col("event_type") == "purchase").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_purchase"))
    r = e.where(F.col("event_type") == "error").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_error"))
    return O.full_merge(p, r, ["user_id"])


def j7(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey")
    return O.cross_params(c, _quarters(spark).select("end_date"))


def j8(spark, sf):
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    o = _orders(spark, sf).select("o_custkey", "order_date")
    out = O.counts_up_to_period(o, ["o_custkey"], "order_date", _quarters(spark), cohort=c, out="n_orders")
    return out.select(F.col("o_custkey").alias("c_custkey"), "end_date", "n_orders")


def _big_purchasers(spark, sf):
    return _t(spark, sf, "events").where((F.col("event_type") == "purchase") & (F.col("value") > 300))


def j9(spark, sf):
    return O.semi_in(_t(spark, sf, "customer"), _big_purchasers(spark, sf), "c_custkey", "user_id").select(
        "c_custkey", "c_name")


def j9_not_in(spark, sf):
    return O.anti_not_in(_t(spark, sf, "customer"), _big_purchasers(spark, sf), "c_custkey", "user_id").select(
        "c_custkey", "c_name")


def j10(spark, sf):
    l = _lines(spark, sf)
    return O.ties_at_extreme(l, ["l_orderkey"], "ship_date").select(
        "l_orderkey", "l_linenumber", "l_partkey", "ship_date", "l_extendedprice")


def j11(spark, sf):
    e = _t(spark, sf, "events")
    clicks = e.where(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    buys = e.where(F.col("event_type") == "purchase").select(
        "user_id", F.col("ts").alias("p_ts"), F.col("event_id").alias("next_purchase_id"),
        F.col("value").alias("next_purchase_value"))
    out = O.asof_join(clicks, buys, ["user_id"], "ts", "p_ts", ["next_purchase_id", "next_purchase_value"],
                      direction="forward", inclusive=True, tiebreak="next_purchase_id", bucket="day")
    return out.select("event_id", "user_id", "next_purchase_id", "next_purchase_value")


def j11_orders(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderstatus", "order_date")
    nxt = o.select("o_custkey", F.col("order_date").alias("n_date"), F.col("o_orderkey").alias("next_orderkey"),
                   F.col("o_orderstatus").alias("next_status"), F.col("order_date").alias("next_date"))
    out = O.asof_join(o, nxt, ["o_custkey"], "order_date", "n_date", ["next_orderkey", "next_status", "next_date"],
                      direction="forward", inclusive=False, tiebreak="next_orderkey", bucket="adaptive")
    return out.select("o_orderkey", "next_orderkey", "next_status", "next_date")


def j12(spark, sf):
    e = _t(spark, sf, "events").where(F.col("event_type") == "purchase")
    last = O.latest_per_key(e, "user_id", "ts", "event_id", as_of=F.lit(T_EVENT).cast("timestamp_ntz"))
    return last.select("user_id", "event_id", "value")


def j12_asof(spark, sf):
    """Backward as-of: for each purchase, the user's latest view at or before it."""
    e = _t(spark, sf, "events")
    buys = e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    views = e.where(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("v_ts"), F.col("event_id").alias("prev_view_id"),
        F.col("value").alias("prev_view_value"))
    out = O.asof_join(buys, views, ["user_id"], "ts", "v_ts", ["prev_view_id", "prev_view_value"],
                      direction="backward", inclusive=True, tiebreak="prev_view_id", bucket="day")
    return out.select("event_id", "user_id", "prev_view_id", "prev_view_value")


def j13(spark, sf):
    e = _t(spark, sf, "events").where(F.col("event_type") == "purchase")
    first = O.earliest_per_key(e, "user_id", "ts", "event_id", as_of=F.lit(T_EVENT).cast("timestamp_ntz"))
    return first.select("user_id", "event_id", "value")


def j14(spark, sf):
    o = _orders(spark, sf).select("o_orderkey")
    return O.correlated_agg(o, _lines(spark, sf), "o_orderkey", "l_orderkey",
                            {"n_lines": F.count(F.lit(1)), "max_partkey": F.max("l_partkey")}, fill={"n_lines": 0})


def j15(spark, sf):
    l = _lines(spark, sf).select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber",
                                 F.lit("supplier").alias("a_role"), F.lit("part").alias("b_role"))
    return O.two_sided_edges(l, "l_partkey", "l_suppkey", "a_role", "b_role", _t(spark, sf, "customer"),
                             "c_custkey", ["l_orderkey", "l_linenumber"])


def j17(spark, sf):
    l = _lines(spark, sf)
    r_min = l.where(F.col("l_returnflag") == "R").groupBy("l_orderkey").agg(F.min("l_extendedprice").alias("m"))
    return O.sibling_in_encounter(l.select("l_orderkey", "l_linenumber", "l_extendedprice"), r_min,
                                  "l_orderkey", {"min_r_price": "m"})


def j18(spark, sf):
    return O.latest_vs_previous(_t(spark, sf, "events"), ["user_id"], "ts", "value", "event_id",
                                last_date=None, prev_date=None)


# ---------------------------------------------------------------- sets

def u1(spark, sf):
    return O.union_distinct([_orders(spark, sf).select(F.col("order_date").alias("d")),
                             _lines(spark, sf).select(F.col("ship_date").alias("d"))])


def u2(spark, sf):
    o = _orders(spark, sf)
    e = _t(spark, sf, "events")
    return O.append_streams([
        (o.where(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("customer"), F.col("order_date").alias("d")), "finished"),
        (o.where(F.col("o_orderstatus") == "O").select(F.col("o_custkey").alias("customer"), F.col("order_date").alias("d")), "open"),
        (e.where(F.col("event_type") == "purchase").select(F.col("user_id").alias("customer"), F.to_date("ts").alias("d")), "purchase"),
    ], "tag")


def u3(spark, sf):
    o = _orders(spark, sf)
    e = _t(spark, sf, "events")
    parts = [
        o.where(F.col("o_orderstatus") == "F").groupBy(F.col("o_custkey").alias("customer")).agg(F.count(F.lit(1)).alias("n_finished")),
        o.where(F.col("o_orderstatus") == "O").groupBy(F.col("o_custkey").alias("customer")).agg(F.max("order_date").alias("last_open_date")),
        e.where(F.col("event_type") == "error").groupBy(F.col("user_id").alias("customer")).agg(F.count(F.lit(1)).alias("n_errors")),
    ]
    return O.upsert_merge(parts, "customer")


def _rules(spark, sf):
    o = _orders(spark, sf)
    e = _t(spark, sf, "events")
    return [
        ("BIG_ORDER", o.where(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("customer"))),
        ("URGENT_OPEN", o.where((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT"))
         .select(F.col("o_custkey").alias("customer"))),
        ("ERROR_EVENT", e.where(F.col("event_type") == "error").select(F.col("user_id").alias("customer"))),
    ]


def u4(spark, sf):
    return O.rule_union(_rules(spark, sf), ["customer"], "label")


# ---------------------------------------------------------------- star

def _all_dates(spark, sf):
    return O.union_distinct([_orders(spark, sf).select(F.col("order_date").alias("full_date")),
                             _lines(spark, sf).select(F.col("ship_date").alias("full_date")),
                             _t(spark, sf, "events").select(F.to_date("ts").alias("full_date"))])


def d_date(spark, sf):
    keyed = O.dense_key(_all_dates(spark, sf), ["full_date"], "date_id")
    return keyed.select("date_id", "full_date", F.year("full_date").alias("year"),
                        F.month("full_date").alias("month"), F.dayofmonth("full_date").alias("day"))


def x_event(spark, sf):
    e = _t(spark, sf, "events").withColumn("event_date", F.to_date("ts"))
    dates = O.dense_key(e.select("event_date"), ["event_date"], "date_id")
    types = O.dense_key(e.select("event_type"), ["event_type"], "event_type_id")
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    f = e.join(dates, "event_date", "left").join(types, "event_type", "left")
    f = f.join(c, f["user_id"] == c["c_custkey"], "left")
    return f.select("event_id", F.col("user_id").alias("patient_id"), "date_id", "event_type_id",
                    F.col("c_nationkey").alias("location_id"), "value")


# ---------------------------------------------------------------- filters

def p3(spark, sf):
    o = _orders(spark, sf)
    flag = F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("boolean")).otherwise(
        F.col("o_orderpriority") == "1-URGENT")
    return O.exclude_flag_null_kept(o, flag).select("o_orderkey", "o_orderstatus", "o_orderpriority")


def p6(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", "o_totalprice")
    big, rest = O.route_by_flag(o, F.col("o_totalprice") > 300000)
    return big.select("o_orderkey", F.lit("big").alias("branch")).unionByName(
        rest.select("o_orderkey", F.lit("rest").alias("branch")))


def p7(spark, sf):
    cohort = _t(spark, sf, "customer").where((F.col("c_mktsegment") == "BUILDING"))
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderpriority")
    return O.retain_cohort(o, "o_custkey", cohort, "c_custkey", "o_orderpriority", ["1-URGENT", "2-HIGH"])


def p8(spark, sf):
    return O.drop_concepts(_t(spark, sf, "events"), "event_type", ["error", "signup"]).select(
        "event_id", "user_id", "event_type")


def p11(spark, sf):
    c = _t(spark, sf, "customer")
    return O.drop_if_latest_state_not(c, "c_custkey", _orders(spark, sf), "o_custkey", "o_orderstatus",
                                      "order_date", "o_orderkey", "O").select("c_custkey")


def p12(spark, sf):
    iv = _order_intervals(spark, sf)
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    iv = iv.join(c, iv["o_custkey"] == c["c_custkey"]).drop("c_custkey")
    act = O.active_on(iv, "last_ship", F.lit(T_ORDER).cast("date"), location_col="c_nationkey", location=7,
                      start_col="order_date")
    return act.select("o_orderkey", "o_custkey")


# ---------------------------------------------------------------- scalar functions

def f1(spark, sf):
    l = _lines(spark, sf).select("l_orderkey", "l_linenumber", "ship_date")
    o = _orders(spark, sf).select("o_orderkey", "order_date")
    j = l.join(o, l["l_orderkey"] == o["o_orderkey"])
    return j.select("l_orderkey", "l_linenumber",
                    H.full_months_between("order_date", "ship_date").alias("months_to_ship"),
                    H.full_years_between("order_date", "ship_date").alias("years_to_ship"))


def f2(spark, sf):
    l = _lines(spark, sf).select("l_orderkey", "l_linenumber", "ship_date")
    o = _orders(spark, sf).select("o_orderkey", "order_date")
    j = l.join(o, l["l_orderkey"] == o["o_orderkey"])
    return j.select("l_orderkey", "l_linenumber", H.days_between("ship_date", "order_date").alias("days_to_ship"))


def f3(spark, sf):
    o = _orders(spark, sf)
    return o.select("o_orderkey", H.add_months("order_date", 3).alias("plus_3_months"),
                    H.add_days("order_date", 45).alias("plus_45_days"),
                    H.add_months("order_date", -1).alias("minus_1_month"))


def f6(spark, sf):
    return _orders(spark, sf).select("o_orderkey", H.quarter_start("order_date").alias("quarter_start"),
                                     H.quarter_end("order_date").alias("quarter_end"))


def f7(spark, sf):
    o = _orders(spark, sf)
    months = H.full_months_between("order_date", F.lit("2002-01-01").cast("date"))
    return o.select("o_orderkey", months.alias("age_months"), H.three_month_bucket(months).alias("age_bucket"))


def f12(spark, sf):
    return _t(spark, sf, "customer").select("c_custkey", H.hash_id("c_custkey").alias("hashed_id"))


def f19(spark, sf):
    c = _t(spark, sf, "customer")
    raw = F.concat_ws(" ", F.substring("c_mktsegment", 1, 3), F.col("c_nationkey").cast("string"),
                      F.col("c_custkey").cast("string"))
    return c.select("c_custkey", H.format_identifier(raw).alias("formatted_id"))


def f20(spark, sf):
    return _t(spark, sf, "customer").select("c_custkey", H.prefix_id("c_custkey", "100").alias("prefixed_id"))


def x1(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "order_date", "o_orderstatus", "o_totalprice")
    return O.anonymise_table(o, id_cols=["o_orderkey", "o_custkey"], date_cols=["order_date"],
                             drop_cols=["o_totalprice"])


# ---------------------------------------------------------------- reports (RP2 shape)

def _register(spark, sf):
    """Per-customer register: enrolled at the first order; completed at the last
    order date when that latest order is finished ('F'), else still open."""
    o = _orders(spark, sf)
    first = o.groupBy("o_custkey").agg(F.min("order_date").alias("enrollment_date"))
    latest = O.latest_per_key(o, "o_custkey", "order_date", "o_orderkey").select(
        "o_custkey", F.when(F.col("o_orderstatus") == "F", F.col("order_date")).alias("completion_date"))
    return first.join(latest, "o_custkey")


def _visits(spark, sf):
    """Visits = orders; the appointment set at a visit = its last ship date."""
    return _order_intervals(spark, sf).withColumnRenamed("last_ship", "appt_date")


def rp2(spark, sf, as_of: str = T_ORDER):
    """Active cohort on the report date with last visit, next appointment and
    days late / days to next.  The register (first order, latest status) and the
    last visit on or before the date come from ONE grouped aggregate over the
    order intervals (conditional latest/earliest picks): orders and lines are
    each scanned once."""
    t = F.lit(as_of).cast("date")
    v = _visits(spark, sf)
    per = O.picks_per_key(v, ["o_custkey"], "order_date", "o_orderkey", {
        "first": (F.lit(True), {"enrollment_date": "order_date"}, "min"),
        "latest": (F.lit(True), {"__latest_date": "order_date", "__latest_status": "o_orderstatus"}),
        "visit": (F.col("order_date") <= t, {"last_visit_date": "order_date", "next_appt_date": "appt_date"}),
    })
    reg = per.withColumn("completion_date", F.when(F.col("__latest_status") == "F", F.col("__latest_date")))
    act = O.active_on(reg, "completion_date", t, start_col="enrollment_date")
    c = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    out = act.join(c, F.col("o_custkey") == F.col("c_custkey"))
    late = F.col("next_appt_date") < t
    return out.select(
        "c_custkey", "c_mktsegment", "enrollment_date", "last_visit_date", "next_appt_date",
        F.when(late, H.days_between(t, "next_appt_date")).alias("days_late"),
        F.when(~late, H.days_between("next_appt_date", t)).alias("days_to_next"))


def rp6(spark, sf, as_of: str = T_ORDER):
    """Trace criteria over the active cohort: a rule union of (customer, criteria)."""
    active = rp2(spark, sf, as_of)
    t = F.lit(as_of).cast("date")
    o = _orders(spark, sf).where(F.col("order_date") <= t)
    lv = O.latest_vs_previous(o, ["o_custkey"], "order_date", "o_totalprice", "o_orderkey",
                              last_date=None, prev_date=None)
    rising = lv.where(F.col("last_value") > F.col("previous_value") * 2).select(F.col("o_custkey").alias("c_custkey"))
    rules = [
        ("LATE_2_WEEKS", active.where(F.col("days_late") >= 14)),
        ("LATE_6_WEEKS", active.where(F.col("days_late") >= 42)),
        ("NO_VISIT", active.where(F.col("last_visit_date").isNull())),
        ("VALUE_DOUBLED", active.join(rising, "c_custkey", "left_semi")),
    ]
    return O.rule_union(rules, ["c_custkey"], "criteria")


def rp7(spark, sf, as_of: str = T_ORDER):
    """Appointment alerts: rules over the active cohort and its order history."""
    active = rp2(spark, sf, as_of)
    t = F.lit(as_of).cast("date")
    o = _orders(spark, sf).where(F.col("order_date") <= t)
    last_urgent = O.latest_per_key(o.where((F.col("o_orderpriority") == "1-URGENT")), "o_custkey", "order_date",
                                   "o_orderkey").select(F.col("o_custkey").alias("c_custkey"),
                                                         F.col("order_date").alias("last_urgent"))
    a = active.join(last_urgent, "c_custkey", "left")
    rules = [
        ("REVIEW_DUE", a.where(F.col("last_visit_date") < F.add_months(t, -12))),
        ("URGENT_FOLLOWUP", a.where(F.col("last_urgent") >= F.add_months(t, -3))),
        ("NO_URGENT_EVER", a.where(F.col("last_urgent").isNull())),
        ("APPT_THIS_MONTH", a.where(F.col("days_to_next") <= 30)),
    ]
    return O.rule_union(rules, ["c_custkey"], "alert")


def rp8(spark, sf):
    """Next appointment per customer: latest visit and the appointment set there."""
    v = _visits(spark, sf)
    last = O.latest_per_key(v, "o_custkey", "order_date", "o_orderkey")
    return last.select(F.col("o_custkey").alias("c_custkey"), F.col("order_date").alias("last_visit_date"),
                       F.col("appt_date").alias("next_appt_date"))



def rp9(spark, sf, start: str = "1998-07-01", end: str = T_ORDER_END):
    """Patients expected (RP9 shape): customers active at ``end`` whose latest
    visit with an appointment set an appointment inside [start, end]."""
    t0, t1 = F.lit(start).cast("date"), F.lit(end).cast("date")
    v = _visits(spark, sf).where(F.col("appt_date").isNotNull())
    last = O.latest_per_key(v, "o_custkey", "order_date", "o_orderkey")
    reg = _register(spark, sf)
    act = O.active_on(reg, "completion_date", t1).select("o_custkey")
    out = last.join(act, "o_custkey", "left_semi").where((F.col("appt_date") >= t0) & (F.col("appt_date") <= t1))
    return out.select(F.col("o_custkey").alias("c_custkey"), F.col("order_date").alias("last_visit_date"),
                      F.col("appt_date").alias("last_appt_date"))


def rp10(spark, sf, as_of: str = T_ORDER):
    """IC3 shape (RP10): several filtered latest / earliest picks per customer
    from ONE grouped aggregate over orders, plus the latest of two dates."""
    t = F.lit(as_of).cast("date")
    o = _orders(spark, sf)
    before = F.col("order_date") <= t
    p = O.picks_per_key(o, ["o_custkey"], "order_date", "o_orderkey", {
        "first_f": ((F.col("o_orderstatus") == "F") & before, {"first_finished": "order_date"}, "min"),
        "last_o": ((F.col("o_orderstatus") == "O") & before, {"last_open": "order_date"}),
        "urgent": ((F.col("o_orderpriority") == "1-URGENT") & before,
                   {"last_urgent_date": "order_date", "last_urgent_price": "o_totalprice"}),
    })
    return p.select(F.col("o_custkey").alias("c_custkey"), "first_finished", "last_open", "last_urgent_date",
                    "last_urgent_price", F.greatest("last_open", "last_urgent_date").alias("latest_activity"))


# ---------------------------------------------------------------- more operator bindings

def p1(spark, sf):
    """The row's own flag and its owner's flag are both off (orders 'P' are
    voided, customers with a negative balance are voided owners)."""
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", (F.col("o_orderstatus") == "P").alias("voided"))
    c = _t(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") < 0).alias("voided"))
    return O.keep_live(o, c, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


def p2(spark, sf):
    o = _orders(spark, sf).select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("prio"),
        F.when(F.col("o_orderstatus") == "P", F.lit(" ")).otherwise(F.col("o_orderstatus")).alias("status"))
    return O.require_not_null(o, ["prio"], non_blank=["status"])


def p9(spark, sf):
    return O.delete_by_key_prefix(_t(spark, sf, "customer").select("c_custkey"), "c_custkey", "1")


def p10(spark, sf):
    e = _t(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "click", F.col("value")).alias("value_numeric"))
    return O.typed_value_filter(e, "value_numeric")


def p13(spark, sf):
    return O.optional_param(_orders(spark, sf), "o_orderpriority", "2-high").select("o_orderkey")


def p13_unset(spark, sf):
    return O.optional_param(_orders(spark, sf), "o_orderpriority", None).select("o_orderkey")


def p14(spark, sf):
    return O.in_list(_t(spark, sf, "events"), "event_type", ["CLICK", "view "]).select("event_id")


def j3(spark, sf):
    """A line's label from the part lookup (large parts only) else the supplier lookup."""
    l = _lines(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parts = _t(spark, sf, "part").where(F.col("p_size") > 25)
    out = O.decode_two_sources(l, (parts, "l_partkey", "p_partkey", "p_name"),
                               (_t(spark, sf, "supplier"), "l_suppkey", "s_suppkey", "s_name"), "label")
    return out.select("l_orderkey", "l_linenumber", "label")


def j6(spark, sf):
    """A fact joined inner on its patient and left on its dimensions."""
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "order_date")
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    dates = O.dense_key(o.select("order_date"), ["order_date"], "date_id")
    f = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    f = O.decode(f, _t(spark, sf, "nation"), "c_nationkey", "n_nationkey", "n_name")
    f = f.join(dates, "order_date", "left")
    return f.select("o_orderkey", "c_custkey", "n_name", "date_id")


def j16(spark, sf):
    """Lines whose parent (order) has the named type."""
    groups = _orders(spark, sf).select("o_orderkey", "o_orderpriority")
    l = _lines(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey")
    return O.child_in_named_group(l, groups, "o_orderkey", "o_orderpriority", "1-URGENT", "l_orderkey")


def j19(spark, sf):
    """Attributes of the row at the latest (date, id) per key."""
    o = _orders(spark, sf)
    out = O.value_at_latest(o, ["o_custkey"], "order_date", "o_orderkey",
                            ["o_orderkey", "o_orderstatus", "o_totalprice"], prefix="last_")
    return out.select("o_custkey", "last_date", F.col("last_o_orderkey").alias("last_orderkey"),
                      F.col("last_o_orderstatus").alias("last_status"), F.col("last_o_totalprice").alias("last_price"))


def a18(spark, sf):
    return _orders(spark, sf).select("o_custkey", "o_orderstatus").distinct()


def a20(spark, sf):
    return _lines(spark, sf).groupBy().agg(F.count(F.lit(1)).alias("n_rows"))


def f4(spark, sf):
    e = _t(spark, sf, "events")
    return e.select("event_id", H.date_part("ts").alias("event_date"), H.time_part("ts").alias("event_time"))


def f5(spark, sf):
    e = _t(spark, sf, "events")
    return e.select("event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.dayofmonth("ts").alias("d"),
                    F.hour("ts").alias("hh"), F.minute("ts").alias("mi"), F.second("ts").alias("ss"))


def f10(spark, sf):
    c = _t(spark, sf, "customer")
    seg = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    return c.select("c_custkey", H.join_nonnull(" ", "c_name", seg).alias("joined"),
                    H.concat_strict("c_name", F.lit("-"), seg).alias("strict"))


def f13(spark, sf):
    return _t(spark, sf, "customer").select("c_custkey", H.substring0("c_name", 1, 5).alias("cut"))


def f14(spark, sf):
    iv = _order_intervals(spark, sf)
    return iv.select("o_orderkey", H.greatest_date("order_date", "last_ship").alias("latest_date"))


def f16(spark, sf):
    j = _order_intervals(spark, sf)
    return j.select("o_orderkey", H.day_gap_mod("last_ship", "order_date", 7).alias("weekday_gap"))


def f17(spark, sf):
    l = _lines(spark, sf)
    disc = F.when(F.col("l_discount") != 0, F.col("l_discount"))
    return l.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") + F.col("l_tax") + disc).alias("total"))


def f18(spark, sf):
    return _t(spark, sf, "events").select("event_id", H.less_than_text("value").alias("below"))


def f22(spark, sf):
    c = _t(spark, sf, "customer")
    n = _t(spark, sf, "nation")
    j = O.decode(c, n, "c_nationkey", "n_nationkey", "n_name")
    return j.select("c_custkey", H.name_fallback(F.when(F.col("c_acctbal") > 0, F.col("c_name")),
                                                 F.when(F.col("c_nationkey") < 5, F.col("n_name"))).alias("display"))


def s11(spark, sf):
    from ..sources import year_slice
    return year_slice(_orders(spark, sf), "order_date", 1998).select("o_orderkey")


def d_time(spark, sf):
    times = _t(spark, sf, "events").select(H.time_part("ts").alias("full_time"))
    keyed = O.dense_key(times, ["full_time"], "time_id")
    parts = F.split(F.col("full_time"), ":")
    return keyed.select("time_id", "full_time", parts[0].cast("int").alias("hour"),
                        parts[1].cast("int").alias("minute"), parts[2].cast("int").alias("second"))


def d_age(spark, sf):
    j = _lines(spark, sf).join(_orders(spark, sf), F.col("l_orderkey") == F.col("o_orderkey"))
    ages = j.select(H.full_years_between("order_date", "ship_date").alias("full_years"),
                    H.full_months_between("order_date", "ship_date").alias("full_months")).distinct()
    return O.dense_key(ages, ["full_years", "full_months"], "age_id")


def d_loc(spark, sf):
    from .star import name_dim
    return name_dim(_t(spark, sf, "nation").select(F.col("n_name").alias("name")), "location_id")


def d_etype(spark, sf):
    from .star import name_dim
    return name_dim(_orders(spark, sf).select(F.col("o_orderpriority").alias("name")), "encounter_type_id")


def r_cvis(spark, sf):
    """R-CVIS: distinct (patient, day) visits with a ``patient-date`` visit key."""
    e = _t(spark, sf, "events").select(F.col("user_id").alias("patient_id"), F.to_date("ts").alias("encounter_date"))
    d = e.distinct()
    return d.select("patient_id", "encounter_date", H.visit_key("patient_id", "encounter_date").alias("visit_id"))


# The priority renaming used to exercise the vocabulary map (R-EAST shape).
PRIORITY_MAP = [("1-URGENT", "URGENT"), ("2-HIGH", "HIGH"), ("5-LOW", "LOW")]


def r_east(spark, sf):
    from .rwanda import remap_values
    m = spark.createDataFrame(PRIORITY_MAP, "source string, target string")
    o = _orders(spark, sf).select("o_orderkey", "o_orderpriority")
    return remap_values(o, "o_orderpriority", m, "source", "target")


def x2(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "order_date", "o_orderstatus")
    return O.anonymise_table(o, id_cols=["o_orderkey", "o_custkey"], keep_dates=True)


def x5(spark, sf):
    """Distinct patient x facility pairs (customer x supplier of their lines)."""
    j = _lines(spark, sf).select("l_orderkey", "l_suppkey").join(
        _orders(spark, sf).select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(F.col("o_custkey").alias("patient_id"), F.col("l_suppkey").alias("fosa_id")).distinct()



# ---------------------------------------------------------------- warehouse jobs over the derived EMR source

def _emr_flat(spark, sf):
    from .flat import FlatConfig, build_flat
    from .testbed_emr import emr_source
    return build_flat(emr_source(spark, sf), FlatConfig(test_patient_attribute=None, phone_attribute=None,
                                                        mothers_name_attribute=None, health_center_attribute=None))


def emr_patient(spark, sf):
    """O-PAT over the derived source (one row per customer)."""
    return _emr_flat(spark, sf)["omrs_patient"]


def emr_encounter(spark, sf):
    """O-ENC over the derived source (one row per order, decoded type and location)."""
    return _emr_flat(spark, sf)["omrs_encounter"]


def emr_obs(spark, sf):
    """O-OBS over the derived source (lines, events and order statuses as observations)."""
    return _emr_flat(spark, sf)["omrs_obs"]


def emr_state(spark, sf):
    """O-PST over the derived source (a state per order, ended by the next order)."""
    return _emr_flat(spark, sf)["omrs_program_state"]


def _emr_written(spark, sf, *names):
    """The derived flat layer with the named tables written when first read: the
    layer edge a refresh has between the flat layer and what is built from it."""
    from ..session import written
    from .lazy import LazyTables
    flat = _emr_flat(spark, sf)
    return LazyTables({k: (lambda t, k=k: written(flat[k], k, **EDGE.get(k, {})) if k in names else flat[k]) for k in flat})


# How tables of the layer edge are written: the large ones compressed more, observations in turns (their shuffles are the widest).
EDGE = {"omrs_program_state": {"compression": "zstd"}, "omrs_encounter": {"compression": "zstd"},
        "omrs_obs": {"compression": "zstd", "parts": 4, "by": ("encounter_id", "obs_id")}}
STAR_INPUT = ("omrs_patient", "omrs_program_enrollment", "omrs_program_state", "omrs_encounter", "omrs_obs")


def _emr_star(spark, sf):
    """The star schema over the written flat layer; a dimension is written when
    first read, so facts join tables whose size the planner knows."""
    from ..session import written
    from .star import build_star
    return build_star(spark, _emr_written(spark, sf, *STAR_INPUT), lambda name, df: written(df, name))


def emr_dim_date(spark, sf):
    """D-DATE over the derived flat layer."""
    from .star import build_star
    return build_star(spark, _emr_written(spark, sf, "omrs_program_state"))["dim_date"]


def emr_fact_numeric(spark, sf):
    """X-NUM over the written flat layer, with the dimensions it joins."""
    return _emr_star(spark, sf)["fact_patient_numeric_value"]


def emr_fact_event(spark, sf):
    """X-EVENT over the written flat layer: births, encounters, enrollments and
    completions with their dimension ids."""
    return _emr_star(spark, sf)["fact_patient_event"]


def emr_urgent_visits(spark, sf):
    """A5 through the form compiler: urgent-order visits pivoted from observations."""
    from .forms import build_form
    from .testbed_emr import URGENT_FORM
    return build_form(_emr_flat(spark, sf), URGENT_FORM)


def emr_last_obs(spark, sf):
    """M-LASTOBS / R-LOBS over the derived observations and quarters."""
    from .rwanda import rw_last_obs_in_period
    return rw_last_obs_in_period(_emr_flat(spark, sf), ["purchase", "R"], _quarters(spark))


def emr_latest_per_period(spark, sf):
    """R-LVL (W6) over the derived source: every BUILDING-programme patient x
    week of January 2024 with the latest purchase on or before the week end, or blanks."""
    from .rwanda import rw_last_vl_include_blanks
    weeks = O.week_periods(spark, "2024-01-01", 5)
    return rw_last_vl_include_blanks(_emr_flat(spark, sf), weeks, programs=["BUILDING"], concept="purchase")


def emr_calculated_visit(spark, sf):
    """R-CVIS over the derived encounters."""
    from .rwanda import rw_calculated_visit
    return rw_calculated_visit(_emr_flat(spark, sf))


def emr_mw_patient(spark, sf):
    """M-PAT over the derived flat layer."""
    from .malawi import mw_patient
    return mw_patient(_emr_flat(spark, sf))


def emr_anonymised_encounter(spark, sf):
    """X1 over the derived encounters: ids hashed, dates to quarter starts, ages
    in months to 3-month buckets, person-identifying columns dropped."""
    from .anonymise import anonymise_warehouse
    flat = _emr_flat(spark, sf)
    return anonymise_warehouse({"omrs_encounter": flat["omrs_encounter"]})["omrs_encounter"]


def emr_active_cohort(spark, sf, as_of: str = T_ORDER):
    """RP2 through the report code: patients with an open-order episode on the
    report date (the derived register), their last visit on or before it and
    the appointment set there, days late / days to next."""
    from .forms import build_form
    from .malawi import state_episodes
    from .reports import active_cohort
    from .testbed_emr import VISITS_FORM
    flat = _emr_written(spark, sf, "omrs_program_state", "omrs_encounter")
    register = state_episodes(flat, None, "order status", "O")
    visits = build_form(flat, VISITS_FORM)
    return active_cohort(register, visits, None, as_of, visit_id="visit_id")


def emr_register(spark, sf):
    """M-RART shape over the derived source: one row per open-order state
    episode, ended by the next order (else enrollment completion), outcome =
    the state starting on or after the episode end (J11 as-of)."""
    from .malawi import state_episodes
    eps = state_episodes(_emr_written(spark, sf, "omrs_program_state"), None, "order status", "O")
    return eps.select(F.col("program_state_id").alias("episode_id"), "program_enrollment_id", "patient_id",
                      "location", "start_date", "end_date", "outcome")


QUERIES = {
    "a1": a1,
    "a2": a2,
    "a3": a3,
    "a4": a4,
    "a5": a5,
    "a6": a6,
    "a7": a7,
    "a8": a8,
    "a9": a9,
    "a10": a10,
    "a11": a11,
    "a12": a12,
    "a13": a13,
    "a14": a14,
    "a15": a15,
    "a16": a16,
    "a19": a19,
    "w1": w1,
    "w1_offset": w1_offset,
    "w2": w2,
    "w3": w3,
    "w4": w4,
    "w5": w5,
    "w6": w6,
    "w7": w7,
    "w8": w8,
    "j1": j1,
    "j2": j2,
    "j4": j4,
    "j5": j5,
    "j7": j7,
    "j8": j8,
    "j9": j9,
    "j9_not_in": j9_not_in,
    "j10": j10,
    "j11": j11,
    "j11_orders": j11_orders,
    "j12": j12,
    "j12_asof": j12_asof,
    "j13": j13,
    "j14": j14,
    "j15": j15,
    "j17": j17,
    "j18": j18,
    "u1": u1,
    "u2": u2,
    "u3": u3,
    "u4": u4,
    "d_date": d_date,
    "x_event": x_event,
    "p3": p3,
    "p6": p6,
    "p7": p7,
    "p8": p8,
    "p11": p11,
    "p12": p12,
    "f1": f1,
    "f2": f2,
    "f3": f3,
    "f6": f6,
    "f7": f7,
    "f12": f12,
    "f19": f19,
    "f20": f20,
    "x1": x1,
    "rp2": rp2,
    "rp6": rp6,
    "rp7": rp7,
    "rp8": rp8,
    "rp9": rp9,
    "rp10": rp10,
    "p1": p1,
    "p2": p2,
    "p9": p9,
    "p10": p10,
    "p13": p13,
    "p13_unset": p13_unset,
    "p14": p14,
    "j3": j3,
    "j6": j6,
    "j16": j16,
    "j19": j19,
    "a18": a18,
    "a20": a20,
    "f4": f4,
    "f5": f5,
    "f10": f10,
    "f13": f13,
    "f14": f14,
    "f16": f16,
    "f17": f17,
    "f18": f18,
    "f22": f22,
    "s11": s11,
    "d_time": d_time,
    "d_age": d_age,
    "d_loc": d_loc,
    "d_etype": d_etype,
    "r_cvis": r_cvis,
    "r_east": r_east,
    "x2": x2,
    "x5": x5,
    "emr_patient": emr_patient,
    "emr_encounter": emr_encounter,
    "emr_obs": emr_obs,
    "emr_state": emr_state,
    "emr_dim_date": emr_dim_date,
    "emr_fact_numeric": emr_fact_numeric,
    "emr_fact_event": emr_fact_event,
    "emr_urgent_visits": emr_urgent_visits,
    "emr_last_obs": emr_last_obs,
    "emr_latest_per_period": emr_latest_per_period,
    "emr_calculated_visit": emr_calculated_visit,
    "emr_mw_patient": emr_mw_patient,
    "emr_anonymised_encounter": emr_anonymised_encounter,
    "emr_active_cohort": emr_active_cohort,
    "emr_register": emr_register,
}

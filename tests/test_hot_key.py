"""One key holding a third of all rows: the operators stay exact (checked
against brute force) while their plans split the key's work (partial group
limits, partial aggregates, time-bucketed as-of windows)."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from hearth import operators as O


def _events(spark, n=3000):
    # patient 0 owns every third row; the rest spread over 200 patients; times over 60 days
    df = spark.range(0, n).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 200 + 1).alias("patient_id"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") +
         F.make_dt_interval(F.lit(0), F.lit(0), ((F.col("id") * 7919) % 86400).cast("int"))
         + F.make_dt_interval((F.col("id") % 60).cast("int"))).alias("ts"),
        F.when(F.col("id") % 5 == 0, F.lit("purchase")).otherwise(F.lit("view")).alias("kind"),
        ((F.col("id") * 37) % 1000).cast("double").alias("value"))
    return df


def test_hot_key_asof_matches_brute_force(spark):
    ev = _events(spark)
    views = ev.where("kind = 'view'").select("event_id", "patient_id", "ts")
    buys = ev.where("kind = 'purchase'").select("patient_id", F.col("ts").alias("bts"),
                                                 F.col("event_id").alias("buy_id"))
    got = {}
    for bucket in ("day", None):
        out = O.asof_join(views, buys, ["patient_id"], "ts", "bts", ["buy_id"], "forward", True, "buy_id", bucket)
        got[bucket] = dict(out.select("event_id", "buy_id").toPandas().itertuples(index=False, name=None))
    p = ev.toPandas()
    b = p[p["kind"] == "purchase"].sort_values(["ts", "event_id"])
    want = {}
    for r in p[p["kind"] == "view"].itertuples():
        cand = b[(b["patient_id"] == r.patient_id) & (b["ts"] >= r.ts)]
        want[r.event_id] = int(cand.iloc[0]["event_id"]) if len(cand) else None
    norm = lambda d: {k: (None if v is None or pd.isna(v) else int(v)) for k, v in d.items()}
    assert norm(got["day"]) == want and norm(got[None]) == want


def test_hot_key_top_n_and_pivot(spark):
    ev = _events(spark)
    top = O.top_n_per_key(ev, "patient_id", [F.col("ts").desc(), F.col("event_id").desc()], 3, "rk")
    p = ev.toPandas().sort_values(["ts", "event_id"], ascending=False)
    want = p.groupby("patient_id").head(3)
    assert sorted(top.select("event_id").toPandas()["event_id"]) == sorted(want["event_id"])
    piv = O.form_pivot(ev.withColumnRenamed("kind", "concept"), ["patient_id"],
                       [O.PivotColumn("max_buy", "purchase", "value", agg="max"),
                        O.PivotColumn("n_view", "view", "value", agg="count", cast="long")],
                       id_col="event_id")
    hot = piv.where("patient_id = 0").collect()[0]
    h = p[p["patient_id"] == 0]
    assert hot["max_buy"] == h[h["kind"] == "purchase"]["value"].max()
    assert hot["n_view"] == (h["kind"] == "view").sum()


def test_hot_key_snapshot(spark):
    ev = _events(spark).withColumn("d", F.to_date("ts"))
    weeks = O.week_periods(spark, "2024-01-01", 9)
    snap = O.snapshot_latest_per_period(ev.select("patient_id", "event_id", "d"), ["patient_id"], "d", weeks)
    got = snap.where("patient_id = 0").groupBy("end_date").agg(F.max("d").alias("m"), F.count("*").alias("n"))
    p = ev.select("patient_id", "d").toPandas()
    h = p[p["patient_id"] == 0]
    for r in got.collect():
        upto = h[h["d"] <= r["end_date"]]
        assert r["m"] == upto["d"].max() and r["n"] == (upto["d"] == upto["d"].max()).sum()

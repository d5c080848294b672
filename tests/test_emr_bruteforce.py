"""Brute-force checks (pandas over the smallest test tables) for the warehouse
jobs over the derived EMR source that have no SQL oracle."""


import pandas as pd
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def pdf(name):
    return pd.read_parquet(f"{SF}/{name}.parquet")


@pytest.fixture(scope="module")
def q(spark):
    return lambda name: E.queries()[name](spark, SF).toPandas()


def test_emr_obs(q):
    obs = q("emr_obs")
    li, ev, o = pdf("lineitem"), pdf("events"), pdf("orders")
    with_lines = li["l_orderkey"].nunique()
    assert len(obs) == len(li) + len(ev) + len(o) + with_lines
    appt = obs[obs["concept"] == "Appointment date"].set_index("encounter_id")["value_date"]
    want = li.groupby("l_orderkey")["l_shipdate"].max().dt.date
    assert appt.sort_index().to_dict() == want.sort_index().to_dict()
    status = obs[obs["concept"] == "order status"].set_index("encounter_id")["value_coded"]
    assert status.sort_index().to_dict() == o.set_index("o_orderkey")["o_orderstatus"].sort_index().to_dict()
    lines = obs[obs["concept"].isin(["A", "N", "R"])]
    assert sorted(lines["value_numeric"]) == sorted(li["l_extendedprice"])
    ev_obs = obs[obs["encounter_id"].isna()]
    assert set(ev_obs["obs_id"]) == set(ev["event_id"])


def test_emr_state_ends_at_next_order(q):
    st = q("emr_state").set_index("program_state_id")
    o = pdf("orders").sort_values(["o_custkey", "o_orderdate", "o_orderkey"])
    for _, g in o.groupby("o_custkey"):
        dates = list(g["o_orderdate"])
        for key, d in zip(g["o_orderkey"], dates):
            later = [x for x in dates if x > d]
            want = min(later).date() if later else None
            got = st.loc[key, "end_date"]
            assert (got if pd.notna(got) else None) == want
            assert st.loc[key, "start_date"] == d.date()


def test_emr_dim_date_numbers_every_date(q):
    dd = q("emr_dim_date").sort_values("date_id", na_position="first")
    o, li, ev, c = pdf("orders"), pdf("lineitem"), pdf("events"), pdf("customer")
    dates = set(o["o_orderdate"].dt.date) | set(li["l_shipdate"].dt.date) | set(ev["ts"].dt.date)
    dates |= {(pd.Timestamp("1940-01-01") + pd.DateOffset(months=int(k) * 13)).date() for k in c["c_nationkey"]}
    done = o[o["o_orderstatus"] == "F"].groupby("o_custkey")["o_orderdate"].max().dt.date
    dates |= set(done)
    got = [d for d in dd["full_date"] if pd.notna(d)]
    assert set(got) == dates
    assert list(dd["date_id"]) == list(range(1, len(dd) + 1))
    assert got == sorted(got)


def test_emr_fact_numeric(q):
    f = q("emr_fact_numeric")
    li, ev = pdf("lineitem"), pdf("events")
    assert len(f) == len(li) + len(ev)
    assert f["date_id"].notna().all() and f["numeric_question_id"].notna().all()
    assert sorted(f["numeric_value"]) == sorted(list(li["l_extendedprice"]) + list(ev["value"]))


def test_emr_last_obs_matches_brute_force(q):
    got = q("emr_last_obs")
    li, ev, o = pdf("lineitem"), pdf("events"), pdf("orders")
    li = li.merge(o[["o_orderkey", "o_custkey"]], left_on="l_orderkey", right_on="o_orderkey")
    rows = [(r.o_custkey, "R", r.l_shipdate.date()) for r in li[li["l_returnflag"] == "R"].itertuples()]
    rows += [(r.user_id, "purchase", r.ts.date()) for r in ev[ev["event_type"] == "purchase"].itertuples()]
    obs = pd.DataFrame(rows, columns=["patient_id", "concept", "d"])
    ends = [(pd.Timestamp("1995-01-01") + pd.DateOffset(months=3 * i + 3) - pd.Timedelta(days=1)).date()
            for i in range(28)]
    want = []
    for (p, c), g in obs.groupby(["patient_id", "concept"]):
        for e in ends:
            upto = g[g["d"] <= e]
            if len(upto):
                m = upto["d"].max()
                want += [(p, c, e, m)] * int((upto["d"] == m).sum())
    assert sorted(want) == sorted(zip(got["patient_id"], got["concept"], got["end_date"], got["last_obs_date"]))


def test_emr_register_outcome_is_state_after_episode(q):
    reg = q("emr_register").set_index("episode_id")
    o = pdf("orders").sort_values(["o_custkey", "o_orderdate", "o_orderkey"])
    n = pdf("nation").set_index("n_nationkey")["n_name"]
    loc = pdf("customer").set_index("c_custkey")["c_nationkey"].map(n)
    checked = 0
    for cust, g in o.groupby("o_custkey"):
        done = g[g["o_orderstatus"] == "F"]["o_orderdate"].max()
        for r in g[g["o_orderstatus"] == "O"].itertuples():
            later = g[g["o_orderdate"] > r.o_orderdate]
            state_end = later["o_orderdate"].min() if len(later) else None
            end = state_end if state_end is not None else (done if pd.notna(done) else None)
            if state_end is not None:
                nxt = g[g["o_orderdate"] >= state_end].sort_values(["o_orderdate", "o_orderkey"]).iloc[0]
                outcome = nxt["o_orderstatus"]
            else:
                outcome = None
            got = reg.loc[r.o_orderkey]
            assert got["start_date"] == r.o_orderdate.date()
            assert (got["end_date"] if pd.notna(got["end_date"]) else None) == (end.date() if end is not None else None)
            assert (got["outcome"] if pd.notna(got["outcome"]) else None) == outcome
            assert got["location"] == loc[cust] and got["patient_id"] == cust
            checked += 1
    assert checked == len(reg)

"""Property tests (random small inputs, brute-force reference) for the custom
operators: as-of join in every direction / inclusivity / bucketing, and the
period snapshots."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hearth import operators as O

BASE = dt.date(2020, 1, 1)
days = st.integers(min_value=0, max_value=120)
rows_l = st.lists(st.tuples(st.integers(1, 3), st.one_of(st.none(), days)), min_size=1, max_size=12)
rows_r = st.lists(st.tuples(st.integers(1, 3), days), min_size=0, max_size=12)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _asof_brute(left, right, fwd, inclusive):
    out = {}
    for lid, (g, t) in enumerate(left):
        if t is None:
            out[lid] = None
            continue
        cands = [(rt, rid) for rid, (rg, rt) in enumerate(right) if rg == g and
                 ((rt >= t if inclusive else rt > t) if fwd else (rt <= t if inclusive else rt < t))]
        if not cands:
            out[lid] = None
        elif fwd:
            out[lid] = min(cands)[1]                        # earliest time, then smallest id
        else:
            out[lid] = max(cands)[1]                        # latest time, then largest id
    return out


@SETTINGS
@given(left=rows_l, right=rows_r, fwd=st.booleans(), inclusive=st.booleans(),
       bucket=st.sampled_from([None, "month", "year"]))
def test_asof_join_matches_brute_force(spark, left, right, fwd, inclusive, bucket):
    lt = [(i, g, None if t is None else BASE + dt.timedelta(days=t)) for i, (g, t) in enumerate(left)]
    rt = [(i, g, BASE + dt.timedelta(days=t)) for i, (g, t) in enumerate(right)]
    ldf = spark.createDataFrame(lt, "lid long, g long, t date")
    rdf = spark.createDataFrame(rt, "rid long, g long, rt date")
    out = O.asof_join(ldf, rdf, ["g"], "t", "rt", ["rid"], "forward" if fwd else "backward", inclusive, "rid", bucket)
    got = {r["lid"]: r["rid"] for r in out.collect()}
    assert got == _asof_brute(left, right, fwd, inclusive)


obs_rows = st.lists(st.tuples(st.integers(1, 3), st.integers(0, 400)), min_size=1, max_size=15)


@SETTINGS
@given(obs=obs_rows)
def test_snapshots_match_brute_force(spark, obs):
    periods = O.quarter_periods(spark, "2020-01-01", "2020-12-31")
    ends = [r["end_date"] for r in periods.orderBy("end_date").collect()]
    rows = [(k, i, BASE + dt.timedelta(days=d)) for i, (k, d) in enumerate(obs)]
    df = spark.createDataFrame(rows, "k long, id long, d date")
    snap = O.snapshot_latest_per_period(df, ["k"], "d", periods)
    got = sorted((r["k"], r["end_date"], r["id"]) for r in snap.collect())
    want = []
    for e in ends:
        for k in {k for k, _, _ in rows}:
            upto = [(d, i) for kk, i, d in rows if kk == k and d <= e]
            if upto:
                m = max(d for d, _ in upto)
                want += [(k, e, i) for d, i in upto if d == m]
    assert got == sorted(want)
    cohort = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k long")
    blanks = O.snapshot_with_blanks(cohort, df, ["k"], "d", "id", periods, [])
    got_b = sorted((r["k"], r["end_date"], r["id"]) for r in blanks.collect())
    want_b = []
    for k in (1, 2, 3, 4):
        for e in ends:
            upto = sorted(((d, -i) for kk, i, d in rows if kk == k and d <= e), reverse=True)
            want_b.append((k, e, -upto[0][1] if upto else None))
    assert sorted(got_b, key=str) == sorted(want_b, key=str)

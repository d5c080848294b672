"""A third of all rows under one key: adaptive as-of buckets, extremes with
ties, levelled numbering, bounded group text and measured broadcasts."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from hearth import operators as O
from hearth.operators import asof
from hearth.plans.testbed_all import DERIVED_QUERIES

from .conftest import rows

D = dt.date


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _brute_asof(left, right, forward, inclusive):
    out = {}
    for i, g, t in left:
        best = None
        for g2, t2, k in right:
            if g is None or g2 != g or t is None or t2 is None:
                continue
            if (t2 > t if forward else t2 < t) or (inclusive and t2 == t):
                key = (t2, k) if forward else (t2, k)
                if best is None or (key < best if forward else key > best):
                    best = key
        out[i] = best[1] if best else None
    return out


@pytest.mark.parametrize("direction,inclusive", [("forward", True), ("forward", False), ("backward", True), ("backward", False)])
def test_adaptive_asof_equals_brute_force(spark, direction, inclusive):
    rng = random.Random(3)
    key = lambda: 0 if rng.random() < 0.35 else rng.choice([None, 1, 2, 3, 4, 5, 6, 7, 8])
    day = lambda: None if rng.random() < 0.05 else D(2020, 1, 1) + dt.timedelta(days=int(rng.random() ** 3 * 400))
    left = [(i, key(), day()) for i in range(400)]
    right = [(key(), day(), i) for i in range(400)]
    lf = spark.createDataFrame(left, "i long, g long, t date")
    r = spark.createDataFrame(right, "g long, u date, k long")
    got = O.asof_join(lf, r, ["g"], "t", "u", ["k"], direction, inclusive, "k", "adaptive", piece_rows=20)
    assert {x["i"]: x["k"] for x in got.collect()} == _brute_asof(left, right, direction == "forward", inclusive)
    assert got.columns == ["i", "g", "t", "k"]


def test_only_hot_groups_are_cut_and_into_even_pieces(spark):
    n = 30_000
    times = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500 + 1).alias("g"),
                                  # uneven in time: most of the hot group's rows within few days
                                  F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(0, 0, cast(sqrt(id) * 1000 as int))").alias(asof._T))
    bounds = asof._adaptive_bounds(times, ["g"], 500)
    found = bounds.collect()
    assert [r["g"] for r in found] == [0] and 15 <= len(found[0]["__bounds"]) <= 20
    pieces = times.join(F.broadcast(bounds), ["g"], "left").withColumn("b", asof._piece(F.col(asof._T)))
    assert pieces.where("g <> 0 and b <> 0").count() == 0
    sizes = [r["count"] for r in pieces.where("g = 0").groupBy("b").count().collect()]
    assert max(sizes) <= 1000 and sum(sizes) == n // 3
    # the piece is the number of bounds before the time
    b = found[0]["__bounds"]
    for r in pieces.where("g = 0").limit(300).collect():
        assert r["b"] == sum(x < r[asof._T] for x in b)


def test_ties_of_a_hot_key(spark):
    # a third of all rows: key 0, all of them at its latest date; null keys are a group
    df = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 20 + 1).alias("k"),
                                 F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 11).alias("v"))
    for largest in (True, False):
        got = rows(O.ties_at_extreme(df, ["k"], "v", largest), "id")
        data = [tuple(r) for r in df.collect()]
        pick = {k: (max if largest else min)(v for _, k2, v in data if k2 == k) for k in {k for _, k, _ in data}}
        assert got == sorted((i,) for i, k, v in data if v == pick[k])
    assert "Window" not in plan(O.ties_at_extreme(df, ["k"], "v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # the final join deals rows by (key, value) and can be split: no aggregate or window needs its partitioning
        assert "SortMergeJoin" in plan(O.ties_at_extreme(df, ["k"], "v"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_snapshot_with_tied_hot_key(spark):
    weeks = O.week_periods(spark, "2024-01-01", 6)
    data = [(i, 0 if i % 3 == 0 else (None if i % 7 == 0 else i % 5), D(2023, 12, 25) + dt.timedelta(days=(i // 3 % 2) * 14 + (i % 9))) for i in range(240)]
    df = spark.createDataFrame(data, "id long, k long, d date")
    got = rows(O.snapshot_latest_per_period(df, ["k"], "d", weeks).select("k", "period_id", "id"))
    want = []
    for p in weeks.collect():
        for k in {x[1] for x in data}:
            upto = [x for x in data if x[1] == k and x[2] <= p["end_date"]]
            if upto:
                last = max(x[2] for x in upto)
                want += [(k, p["period_id"], x[0]) for x in upto if x[2] == last]
    assert got == sorted(want, key=lambda t: tuple((x is not None, x) for x in t))


def test_numbering_of_data_sized_tables(spark):
    rng = random.Random(2)
    data = [(rng.choice([5, 5, 5, None, 1, 2000, 2 ** 24 + 3, 2 ** 40, -7]), rng.choice([None, D(2020, 1, rng.randint(1, 28)), D(2019, 5, 2)]),
             rng.choice(["a", None, "B", "b"])) for _ in range(400)]
    df = spark.createDataFrame(data, "p long, d date, s string")
    got = [tuple(r) for r in O.number_rows(df, ["p", "d", "s"], "n", start=10).collect()]
    want = sorted(set(data), key=lambda t: tuple((x is not None, x) for x in t))
    assert sorted(got, key=lambda r: r[3]) == [(*k, 10 + i) for i, k in enumerate(want)]
    assert rows(O.number_rows(df, ["p"], "n")) == rows(O.dense_key(df, ["p"], "n"))
    with pytest.raises(TypeError):
        O.number_rows(df, ["s"], "n")
    # the one window over everything orders counts of 262,144 neighbouring ids
    windows = [line for line in plan(O.number_rows(df, ["p", "d", "s"], "n")).splitlines() if "Window [" in line]
    everything = [w for w in windows if re.search(r"windowspecdefinition\(\S+ ASC", w)]
    assert len(windows) == 3 and len(everything) == 1 and "(__top" in everything[0]


def test_group_text_has_a_limit(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (1, "ab"), (2, "x" * 50), (None, "z"), (1, None)], "k long, v string")
    assert rows(O.concat_group(df, ["k"], "v", "t")) == [(None, "z"), (1, "a,a,ab,b"), (2, "x" * 50)]
    assert rows(O.concat_group(df, ["k"], "v", "t", sep="; ", distinct=True)) == [(None, "z"), (1, "a; ab; b"), (2, "x" * 50)]
    with pytest.raises(Exception, match="51 characters, more than 40"):
        O.concat_group(df, ["k"], "v", "t", most_chars=40).collect()
    hot = spark.range(3000).select((F.col("id") % 3 > 0).cast("int").alias("k"), F.col("id").cast("string").alias("v"))
    for r in O.concat_group(hot, ["k"], "v", "t").collect():
        assert r["t"] == ",".join(sorted(str(i) for i in range(3000) if int(i % 3 > 0) == r["k"]))
    assert rows(O.concat_group(spark.createDataFrame([(1, 3), (1, 12), (1, 3)], "k long, v long"), ["k"], "v", "t")) == [(1, "3,3,12")]


def test_a_table_beyond_the_bound_is_not_broadcast(spark, tmp_path):
    spark.range(200_000).select(F.col("id").cast("string").alias("concept")).write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    few = spark.createDataFrame([("A",)], "concept string")
    obs = spark.range(100).select(F.col("id").cast("string").alias("concept"))
    assert O.small_enough(few) and not O.small_enough(many, most_bytes=1000)
    rows_only = spark.createDataFrame([(str(i),) for i in range(50)], "concept string")
    assert O.small_enough(rows_only, most_rows=50) and not O.small_enough(rows_only, most_rows=49)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(O.drop_concepts(obs, "concept", few))
        assert "BroadcastHashJoin" in plan(obs.join(O.broadcast_if_small(many), "concept"))
        assert "SortMergeJoin" in plan(obs.join(O.broadcast_if_small(many, most_bytes=1000), "concept"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_without_a_key_do_not_meet_in_one_task(spark):
    left = spark.range(0, 4000).select(F.col("id").alias("o"), F.when(F.col("id") % 4 == 0, F.col("id") % 50).alias("k"))
    right = spark.createDataFrame([(i, f"v{i}") for i in (*range(0, 50, 3), 3)] + [(None, "none")], "e long, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = O.left_join_nulls_apart(left, right, "k", "e", "o")
        assert rows(got) == rows(left.join(right, F.col("k") == F.col("e"), "left"))
        parts = got.where("k is null").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) == 8 and max(r["count"] for r in parts) < 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_observation_groups_part_before_the_wide_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("o_obs", "o_obs_group"):
            p = plan(DERIVED_QUERIES[name](spark, "/root/testdata/sf0.001"))
            joins = [re.search(rf"Join \[[^\]]*\], \[{k}#", p).start() for k in ("__e", "__pp", "__gid")]
            assert joins == sorted(joins)                    # the last join stands first
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

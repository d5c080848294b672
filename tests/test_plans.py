"""Plan-shape tests: the properties the scale design relies on, read from
``explain`` of the physical plan (nothing is executed)."""

import io
import time
from contextlib import redirect_stdout
from pathlib import Path

from pyspark.sql import functions as F

from hearth import operators as O
from hearth.plans.testbed import QUERIES
from hearth.session import written

from .conftest import rows

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_pick_per_key_limits_before_the_shuffle(spark):
    p = plan(QUERIES["w2"](spark, SF))
    assert "WindowGroupLimit" in p and ", Partial" in p and ", Final" in p
    p = plan(QUERIES["j10"](spark, SF))            # rank() == 1 keeps ties but still limits map-side
    assert "rank(" in p and ", Partial" in p


def test_asof_join_partitions_by_group_and_bucket(spark):
    p = plan(QUERIES["j11"](spark, SF))
    assert "hashpartitioning(user_id" in p and "__b" in p
    assert "CartesianProduct" not in p


def test_form_pivot_scans_once_and_prunes(spark):
    p = plan(QUERIES["a5"](spark, SF))
    assert p.count("lineitem.parquet") == 1
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_returnflag:string>" in p
    assert "EqualTo(o_orderpriority,1-URGENT)" in p


def test_periods_never_expand_rows_by_period(spark):
    p = plan(QUERIES["j8"](spark, SF))
    # rows meet their period on the day; the one nested loop makes the keys x periods grid
    assert p.split("== Physical Plan ==")[1].split("\n(1)")[0].count("BroadcastNestedLoopJoin") <= 1
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in plan(QUERIES["w5"](spark, SF))


def test_dense_key_has_no_global_window_over_data(spark):
    p = plan(QUERIES["w4"](spark, SF))
    assert "row_number() windowspecdefinition(__b" in p


def test_dense_key_does_not_depend_on_exchange_reuse(spark):
    df = spark.range(0, 30000, 1, 7).select(F.concat(F.lit("k"), (F.col("id") * 7919 % 40009).cast("string")).alias("v"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        for d, cols in ((df, ["v"]), (df.select(F.substring("v", 2, 9).cast("int").alias("v")), ["v"])):
            got = {r["v"]: r["id"] for r in O.dense_key(d, cols).collect()}
            assert got == {v: i for i, v in enumerate(sorted(got), 1)}
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_concat_group_shuffles_distinct_values_only(spark):
    df = spark.range(0, 1000).select((F.col("id") % 2).alias("k"), (F.col("id") % 3).cast("string").alias("v"))
    out = O.concat_group(df, ["k"], "v", "vs", sep=",")
    rows = {r["k"]: r["vs"] for r in out.collect()}
    assert rows[0].count("0") == 167 and rows[0].split(",") == sorted(rows[0].split(","))
    p = plan(out)
    assert "collect_list" in p and p.index("count(1)") < p.index("collect_list")


def test_exact_comparisons_push_down_when_folding_is_off(spark):
    from hearth import functions as H
    o = spark.read.parquet(f"{SF}/orders.parquet")
    assert "EqualTo(o_orderpriority" not in plan(o.where(H.ci_eq("o_orderpriority", "1-URGENT")))
    with H.exact_text():
        p = plan(o.where(H.ci_eq("o_orderpriority", "1-URGENT")))
        assert "EqualTo(o_orderpriority,1-URGENT)" in p
        li = spark.read.parquet(f"{SF}/lineitem.parquet")
        p2 = plan(O.form_pivot(li, ["l_orderkey"], [O.PivotColumn("a", "A", "l_extendedprice", agg="min")],
                               concept_col="l_returnflag", id_col="l_linenumber"))
        assert "In(l_returnflag, [A])" in p2 or "EqualTo(l_returnflag,A)" in p2


def test_no_registered_query_plans_a_cartesian_product(spark):
    bad = [n for n, fn in QUERIES.items() if "CartesianProduct" in plan(fn(spark, SF))]
    assert not bad, bad


def test_value_fact_moves_its_rows_for_the_patients_only(spark):
    p = plan(QUERIES["emr_fact_numeric"](spark, SF))
    assert "SortMergeJoin" not in p and "Exchange hashpartitioning" not in p     # written dimensions have a known size
    p = plan(QUERIES["emr_fact_event"](spark, SF))
    assert "SortMergeJoin" not in p


def test_written_table_keeps_no_shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    local = [Path(d.getPath()) for d in dirs]

    def held():
        return {f for d in local for f in d.rglob("shuffle_*.data")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = held(), spark.conf.get(setting)
    df = spark.range(2_000).withColumn("k", F.col("id") % 7).repartition(5, "k")
    got = [written(df, "some", **how) for how in ({}, {"parts": 3, "by": ("id",), "compression": "zstd"})]
    time.sleep(1)                                  # files go in the background
    assert not held() - before
    assert spark.conf.get(setting) == was
    assert [x.count() for x in got] == [2_000, 2_000]


def test_turns_of_a_written_table_hold_each_row_once(spark):
    df = spark.createDataFrame([(None, None, "a"), (None, 5, "b"), (None, 5, "b"), (1, 5, "c"), (2, None, "d"), (2, None, "d")],
                               "e long, i long, v string")
    got = written(df, "turns", parts=3, by=("e", "i"))
    assert rows(got) == rows(df)

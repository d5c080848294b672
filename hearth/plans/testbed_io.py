"""Sources and sinks bound to the driver's test tables: what is written to the
shared scratch folder is read back and compared with the tables it came from."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as H
from .. import operators as O
from .. import sources as S
from ..refresh import write_layer
from ..schemas import struct
from ..session import scratch_table_path
from ..sources import warehouse as W
from .anonymise import anonymise
from .testbed import _orders, _t

RELEASE_KEY = b"the secret of one release"


def _csv(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = scratch_table_path(spark, name)
    df.write.option("header", True).csv(path)
    return path


def _customers_csv(spark, sf):
    c = _t(spark, sf, "customer")
    day = F.date_add(F.lit("1990-01-01").cast("date"), (F.col("c_custkey") % 4000).cast("int"))
    return _csv(spark, c.select("c_custkey", F.concat(F.lit("'"), "c_mktsegment", F.lit("'")).alias("segment"), "c_name", F.date_format(day, "M/d/yyyy").alias("since")),
                "customers-csv")


CUSTOMER_CSV = "c_custkey long, segment string, c_name string, since date"


def s2_read_csv(spark, sf):
    """A typed file with dates as month/day/year and values in single quotes."""
    return S.read_csv(spark, _customers_csv(spark, sf), struct(CUSTOMER_CSV), strip_quotes=("segment",))


def s3_literal_rows(spark, sf):
    """S3: a literal table decodes order states (one state has no row)."""
    names = S.literal_rows(spark, [("F", "finished"), ("O", "open")], "code string, label string")
    return O.decode(_t(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), names, "o_orderstatus", "code", "label")


def s4_generate_ids(spark, sf):
    """One padded id for each customer, every third number."""
    return S.generate_ids(spark, 1, 3, _t(spark, sf, "customer").count(), "a", 4)


def s5_append_table(spark, sf):
    """Finished and open orders appended to one table."""
    path, o = scratch_table_path(spark, "appended"), _t(spark, sf, "orders")
    for status in ("F", "O"):
        S.append_table(o.where(F.col("o_orderstatus") == status).select("o_orderkey", "o_orderstatus"), path)
    return S.read_table(spark, path)


def s6_overwrite_table(spark, sf):
    """A table replaced by another one with a declared column list."""
    path, o = scratch_table_path(spark, "replaced"), _t(spark, sf, "orders")
    S.overwrite_table(o, path)
    S.overwrite_table(o.where(F.col("o_orderstatus") == "P"), path, ["o_orderkey", "o_custkey"])
    return S.read_table(spark, path)


def s7_rebuild_layer(spark, sf):
    """A layer of two tables written twice and read back."""
    root = scratch_table_path(spark, "layer")
    tables = {"orders": _t(spark, sf, "orders").select("o_orderkey", "o_custkey"), "customer": _t(spark, sf, "customer").select("c_custkey", "c_name")}
    write_layer(spark, tables, root)
    layer = write_layer(spark, tables, root)
    return layer["orders"].join(layer["customer"], F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


def s9_append_sites(spark, sf):
    """Two sites in one warehouse by prefix; the second one's load is repeated,
    a third one's load never ends and is not read."""
    out, o = scratch_table_path(spark, "warehouse"), _orders(spark, sf)
    path = os.path.join(out, "flat", "omrs_visit")
    schema = "visit_id long, date_started date"
    for prefix, status, append, ends in (("10", "F", False, True), ("11", "P", True, False), ("11", "O", True, True), ("12", "F", True, False)):
        W.begin_load(spark, out, f"site {prefix}", prefix, append)
        rows = o.where(F.col("o_orderstatus") == status).select(H.prefix_id("o_orderkey", prefix).alias("visit_id"), F.col("order_date").alias("date_started"))
        W.write_site_table(rows, path, prefix, "date_started")
        if ends:
            W.finish_load(spark, out, f"site {prefix}", prefix)
    return W.read_warehouse_table(spark, out, "flat", "omrs_visit", struct(schema))


def s10_audit_row(spark, sf):
    """The audit row of a load with its row counts (without the day)."""
    counts = _t(spark, sf, "orders").agg(F.count(F.lit(1)).alias("n_orders"))
    return S.import_audit_row(spark, "10", "test tables", "count", counts).drop("import_date")


def s12_csv_to_table(spark, sf):
    """A file imported into a table."""
    path = scratch_table_path(spark, "imported")
    S.append_table(S.read_csv(spark, _customers_csv(spark, sf), struct(CUSTOMER_CSV), strip_quotes=("segment",)), path)
    return S.read_table(spark, path, ["c_custkey", "since"], F.col("segment") == "BUILDING")


def o1_sink_order(spark, sf):
    """O1: the order used when a table is written."""
    return O.sink_order(_t(spark, sf, "customer").select("c_mktsegment", "c_name", "c_custkey"), ["c_mktsegment", "c_name"])


def f11_concat(spark, sf):
    """parts joined without a separator, missing ones skipped."""
    c = _t(spark, sf, "customer")
    part = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))
    return c.select("c_custkey", H.join_nonnull("", part, "c_name").alias("joined"))


def x1_keyed(spark, sf):
    """X1 under a release's key: ids as keyed hashes of their kind."""
    o = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("encounter_id"), F.col("o_custkey").alias("patient_id"), F.to_date("o_orderdate").alias("encounter_date"))
    return anonymise(o, key=RELEASE_KEY)


QUERIES = {f.__name__: f for f in (s2_read_csv, s3_literal_rows, s4_generate_ids, s5_append_table, s6_overwrite_table, s7_rebuild_layer, s9_append_sites, s10_audit_row,
                                   s12_csv_to_table, o1_sink_order, f11_concat, x1_keyed)}


def _hmac(kind: str, column: str) -> str:
    """HMAC-SHA256 written out for DuckDB."""
    block = RELEASE_KEY.ljust(64, b"\0")
    inner, outer = (bytes(b ^ x for b in block).hex() for x in (0x36, 0x5C))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || CAST('{kind}:' || CAST({column} AS VARCHAR) AS BLOB))))"


SQL = {
    "s2_read_csv": "SELECT c_custkey, c_mktsegment AS segment, c_name, DATE '1990-01-01' + CAST(c_custkey % 4000 AS INTEGER) AS since FROM customer",
    "s3_literal_rows": "SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS label FROM orders",
    "s4_generate_ids": "SELECT 'a' || CASE WHEN length(CAST(1 + 3 * i AS VARCHAR)) < 4 THEN lpad(CAST(1 + 3 * i AS VARCHAR), 4, '0') ELSE CAST(1 + 3 * i AS VARCHAR) END AS site "
                       "FROM (SELECT row_number() OVER () - 1 AS i FROM customer)",
    "s5_append_table": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O')",
    "s6_overwrite_table": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P'",
    "s7_rebuild_layer": "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
    "s9_append_sites": "SELECT CAST(CASE o_orderstatus WHEN 'F' THEN '10' ELSE '11' END || CAST(o_orderkey AS VARCHAR) AS BIGINT) AS visit_id, CAST(o_orderdate AS DATE) AS date_started "
                       "FROM orders WHERE o_orderstatus IN ('F', 'O')",
    "s10_audit_row": "SELECT '10' AS id_prefix, 'test tables' AS source, 'count' AS comment, count(*) AS n_orders FROM orders",
    "s12_csv_to_table": "SELECT c_custkey, DATE '1990-01-01' + CAST(c_custkey % 4000 AS INTEGER) AS since FROM customer WHERE c_mktsegment = 'BUILDING'",
    "o1_sink_order": "SELECT c_mktsegment, c_name, c_custkey FROM customer",
    "f11_concat": "SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment ELSE '' END || c_name AS joined FROM customer",
    "x1_keyed": f"SELECT {_hmac('encounter_id', 'o_orderkey')} AS encounter_id, {_hmac('patient_id', 'o_custkey')} AS patient_id, "
                "CAST(date_trunc('quarter', o_orderdate) AS DATE) AS encounter_date FROM orders",
}

"""The queries over derived inputs and their oracles: sources and sinks, source to flat layer, flat layer to marts, mart tables to reports."""

from . import testbed_flat, testbed_flat_sql, testbed_io, testbed_mart, testbed_mart_sql, testbed_source, testbed_source_sql

DERIVED_QUERIES = testbed_mart.QUERIES | testbed_flat.QUERIES | testbed_source.QUERIES | testbed_io.QUERIES
DERIVED_SQL = testbed_mart_sql.SQL | testbed_flat_sql.SQL | testbed_source_sql.SQL | testbed_io.SQL

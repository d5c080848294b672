"""Replica copies of the flat layer (S6): each table overwritten at a second
location with its declared column list -- the observation copy leaves out
form, free text and comments, the form name stays only on encounters, and
dates become datetimes as in the replica's schema.  Each table is one narrow
projection and one parallel write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ..sources import overwrite_table

FLAT_TABLES = ["omrs_patient", "omrs_patient_identifier", "omrs_relationship", "omrs_encounter_provider",
               "omrs_encounter", "omrs_visit", "omrs_obs_group", "omrs_obs", "omrs_program_enrollment",
               "omrs_program_state"]
# Columns the replica does not carry.
DROP = {"omrs_obs": ("form", "value_text", "comments")}


def replica_table(name: str, df: DataFrame) -> DataFrame:
    drop = set(DROP.get(name, ()))
    if name != "omrs_encounter":
        drop.add("form")
    cols = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        c = F.col(f.name)
        cols.append(c.cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, DateType) else c)
    return df.select(*cols)


def replica_tables(flat) -> dict[str, DataFrame]:
    return {n: replica_table(n, flat[n]) for n in FLAT_TABLES}


def write_replica(flat, root: str) -> list[str]:
    """Overwrite every replica table under ``root`` (one folder per table)."""
    paths = []
    for name, df in replica_tables(flat).items():
        path = f"{root.rstrip('/')}/{name}"
        overwrite_table(df, path)
        paths.append(path)
    return paths

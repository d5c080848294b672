"""De-identification.

Every id becomes a hash of its text, every date the first day of its quarter,
every age in months the first month of its 3-month bucket; names, phones,
addresses below district and free text are dropped.  Each table is one
narrow projection (no shuffle); the concept blacklist is a broadcast anti join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from ..functions import hash_id, keyed_hash, quarter_start, three_month_bucket


def anonymise_table(df: DataFrame, id_cols: Sequence[str] = (), date_cols: Sequence[str] | None = None,
                    age_month_cols: Sequence[str] = (), drop_cols: Sequence[str] = (), keep_dates: bool = False,
                    salt: str | None = None, key: bytes | None = None, kinds: dict[str, str] | None = None) -> DataFrame:
    """Project one table to its de-identified form.

    With ``key`` ids are keyed hashes, each of the kind ``kinds`` gives for its
    column (default: the column's name).

    ``date_cols=None`` coarsens every date/timestamp column.  ``keep_dates``
    (the unified variant X2) leaves dates exact.
    """
    if date_cols is None:
        date_cols = [f.name for f in df.schema.fields
                     if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType))]
    out = []
    for f in df.schema.fields:
        c = f.name
        if c in drop_cols:
            continue
        if c in id_cols:
            out.append((keyed_hash(c, key, (kinds or {}).get(c, c)) if key else hash_id(c, salt)).alias(c))
        elif c in date_cols and not keep_dates:
            out.append(quarter_start(c).alias(c))
        elif c in age_month_cols:
            out.append(three_month_bucket(c).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)

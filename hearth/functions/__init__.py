"""Column expressions and comparison helpers."""

from .dates import (add_days, add_months, date_part, day_gap_mod, days_between, full_months_between,
                    full_years_between, greatest_date, quarter_end, quarter_start, three_month_bucket,
                    time_part)
from .keys import check_prefixes, hash_id, keyed_hash, packed_uuid, prefix_id, prefix_id_text, stable_key, unpacked_uuid
from .text import (blank_to_null, ci_eq, ci_in, concat_strict, exact_text, fold, format_identifier, gender_code,
                   join_nonnull, less_than_text, name_fallback, number_text, substring0, visit_key)
from .util import as_col

__all__ = [
    "add_days", "add_months", "as_col", "blank_to_null", "check_prefixes", "ci_eq", "ci_in", "concat_strict",
    "date_part", "day_gap_mod", "days_between", "fold", "format_identifier", "full_months_between",
    "full_years_between", "gender_code", "greatest_date", "hash_id", "join_nonnull", "keyed_hash", "less_than_text",
    "name_fallback", "number_text", "packed_uuid", "prefix_id", "prefix_id_text", "quarter_end", "quarter_start",
    "stable_key", "substring0", "three_month_bucket", "time_part", "unpacked_uuid", "visit_key", "exact_text",
]

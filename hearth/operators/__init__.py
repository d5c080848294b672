"""Reusable DataFrame operators.  Each is a pure function of
DataFrames and parameters; none collects data to the driver."""

from .asof import asof_join, first_after_last_other
from .filters import (active_on, delete_by_key_prefix, drop_concepts, drop_if_latest_state_not,
                      exclude_flag_null_kept, in_list, keep_live, optional_param, require_not_null, retain_cohort,
                      typed_value_filter)
from .joins import (anti_not_in, assert_unique, broadcast_if_small, child_in_named_group, correlated_agg, decode, decode_or_abort,
                    decode_strict, decode_two_sources, full_merge, left_join_nulls_apart, left_merge, semi_in, sibling_in_encounter,
                    small_enough, two_sided_edges)
from .keys import attach_key, dense_key, number_rows
from .latest import (any_per_key, best_per_key, current_state_at, earliest_per_key, latest_per_key, picks_per_key,
                     latest_vs_previous, nth_latest, nth_per_key, ties_at_extreme, top_n_per_key, value_at_earliest,
                     value_at_latest)
from .periods import (assign_period, counts_up_to_period, cross_params, quarter_periods, snapshot_latest_per_period,
                      snapshot_with_blanks, week_periods)
from .pivot import (PivotColumn, all_of_n_present, concat_group, conditional_max, conditional_sums, exists_flag,
                    flags_from_set, form_pivot, left_join_keys, pivot_aggregates, pivot_attributes)
from .privacy import anonymise_table
from .sets import append_streams, route_by_flag, rule_union, sink_order, union_distinct, union_sites, upsert_merge

__all__ = [n for n in dir() if not n.startswith("_")]

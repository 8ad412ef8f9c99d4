"""Relational operators Spark lacks as one call, built from DataFrame ops."""

from quill.operators.aggs import cond_count, cond_sum, keep_last, keep_last_key
from quill.operators.audit import check_rules, dependences, duplicate_keys, null_counts, orphan_keys, orphans, write_rules
from quill.operators.intervals import interval_audit, interval_join
from quill.operators.joins import band_audit, band_join, filtered_left_join
from quill.operators.keys import assign_keys, block_keys
from quill.operators.mutate import update_from_aggregate, update_where
from quill.operators.sets import intersect_distinct
from quill.operators.skew import salted_join
from quill.operators.windows import latest_per_key

__all__ = [
    "assign_keys", "band_audit", "band_join", "block_keys", "check_rules", "cond_count",
    "cond_sum", "dependences", "duplicate_keys", "filtered_left_join", "interval_audit", "interval_join", "intersect_distinct", "keep_last",
    "keep_last_key", "latest_per_key", "null_counts", "orphan_keys", "orphans", "salted_join", "update_from_aggregate",
    "update_where", "write_rules",
]

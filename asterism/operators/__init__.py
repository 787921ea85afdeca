"""Table operators: mapping, joins, aggregates, keys, profiling and validation."""

from .aggregates import distinct_values, pick_one
from .joins import frequent_keys, left_join_measures, left_lookup, lookup_key, lookup_roles, with_date_id
from .keys import assign_ids, with_dense_id, with_hash_id
from .mapping import apply_mapping, map_columns, tag
from .profile import persist_profile, persist_profiles, profile, profile_all, profile_document, sample_values, tag_profile
from .validation import Castable, ForeignKey, NotNull, land_split, split_valid, tag_violations, validation_report

__all__ = [
    "frequent_keys",
    "Castable",
    "ForeignKey",
    "NotNull",
    "apply_mapping",
    "assign_ids",
    "distinct_values",
    "land_split",
    "left_join_measures",
    "left_lookup",
    "lookup_key",
    "lookup_roles",
    "map_columns",
    "persist_profile",
    "persist_profiles",
    "pick_one",
    "profile",
    "profile_all",
    "profile_document",
    "sample_values",
    "split_valid",
    "tag",
    "tag_profile",
    "tag_violations",
    "validation_report",
    "with_date_id",
    "with_dense_id",
    "with_hash_id",
]

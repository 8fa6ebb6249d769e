"""Generic DataFrame operators; column names are parameters."""

from .aggregates import count_by, mean_by_key, sum_by
from .checks import (
    distinct_ratio,
    duplicate_groups,
    fixed_sample,
    look_up,
    merge_samples,
    null_counts,
    profile,
    require_unique,
    sample_points,
)
from .grid import grid_pyramid
from .joins import by_shuffle, join_spread, match_keys
from .ranks import complete_rank, positions
from .sets import IdSets, id_sets, set_members, set_sizes, set_union
from .topn import best_wide, top_ranked, top_rows, top_with_rest

__all__ = [
    "IdSets",
    "best_wide",
    "by_shuffle",
    "complete_rank",
    "count_by",
    "distinct_ratio",
    "duplicate_groups",
    "fixed_sample",
    "grid_pyramid",
    "id_sets",
    "join_spread",
    "look_up",
    "match_keys",
    "mean_by_key",
    "merge_samples",
    "null_counts",
    "positions",
    "profile",
    "require_unique",
    "sample_points",
    "set_members",
    "set_sizes",
    "set_union",
    "sum_by",
    "top_ranked",
    "top_rows",
    "top_with_rest",
]

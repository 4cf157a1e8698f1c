"""Reusable relational blocks (DataFrame in, DataFrame out)."""

from quarry.operators.aggregates import (
    distinct_count,
    distinct_count_with_null,
    distinct_totals,
    finish_avg,
    merge_partials,
    partial_sums,
    pivot_avg,
)
from quarry.operators.joins import (
    ORDER,
    anti_join_words,
    dedup_last,
    lookup_inner,
    lookup_with_default,
    unique_dimension,
)
from quarry.operators.ranking import argmax_row, global_rank, nested_top_k, top_k_per_group
from quarry.operators.sets import spread, tagged_union, union_all

__all__ = [
    "ORDER", "anti_join_words", "argmax_row", "dedup_last",
    "distinct_count", "distinct_count_with_null", "distinct_totals", "finish_avg", "global_rank", "lookup_inner",
    "lookup_with_default", "merge_partials", "nested_top_k", "partial_sums",
    "pivot_avg", "spread", "tagged_union", "top_k_per_group", "union_all", "unique_dimension",
]

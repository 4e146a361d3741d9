"""Shared building blocks: schema care, skew-safe windows, exact quantiles, lookups."""

from .chunks import asof_backward, asof_backward_unbounded, chunk_window, chunked, own_rows, rows_before
from .frames import (
    any_null, cut_left, cut_right, ensure_columns, epoch_hour, epoch_second, join_small, keep_first, keep_last,
    nan_to_null, null_safe_join, safe_div, weighted_mean,
)
from .quantiles import group_quantiles

__all__ = [
    "any_null", "asof_backward", "asof_backward_unbounded", "chunk_window", "chunked", "cut_left", "cut_right",
    "ensure_columns", "epoch_hour", "epoch_second", "group_quantiles", "join_small", "keep_first", "keep_last",
    "nan_to_null", "null_safe_join", "own_rows", "rows_before", "safe_div", "weighted_mean",
]

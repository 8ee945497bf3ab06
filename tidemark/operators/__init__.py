from tidemark.operators.changes import SIGN_COLUMN, pending_changes, signed_rows, snapshot_changes
from tidemark.operators.delta import (
    batch_stats,
    in_range,
    newer_than,
    read_cut,
    strict_batch,
    tie_safe_batch,
)
from tidemark.operators.digests import range_digests, rows_of_ranges, uneven_digests
from tidemark.operators.frontier import contiguous_frontier
from tidemark.operators.intervals import (
    done_intervals,
    interval_frontier,
    interval_gaps,
    unite_intervals,
    whole_intervals,
)
from tidemark.operators.merge import (
    collapsing_merge,
    replacing_merge,
    summing_merge,
    versioned_collapse,
)
from tidemark.operators.missing import missing_rows, row_digest, same_rows, surplus_rows, tail_by_count
from tidemark.operators.ordering import batch_ledger, key_positions, page, tie_safe_batches
from tidemark.operators.profile import profile_lines
from tidemark.operators.projection import kept_columns, parse_exclusions, project, select_tables
from tidemark.operators.reconcile import reconcile_counts, row_counts, uneven_ranges
from tidemark.operators.sketch import difference_sketch, missing_by_sketch, surplus_by_sketch, uneven_hashes
from tidemark.operators.watermark import (
    choose,
    choose_from_catalog,
    column_catalog,
    max_watermark,
    max_watermarks,
    read_max,
    watermark_profile,
)

__all__ = [
    "batch_ledger",
    "batch_stats",
    "choose",
    "choose_from_catalog",
    "collapsing_merge",
    "column_catalog",
    "contiguous_frontier",
    "difference_sketch",
    "done_intervals",
    "in_range",
    "interval_frontier",
    "interval_gaps",
    "kept_columns",
    "key_positions",
    "max_watermark",
    "max_watermarks",
    "missing_by_sketch",
    "missing_rows",
    "newer_than",
    "page",
    "parse_exclusions",
    "pending_changes",
    "profile_lines",
    "project",
    "range_digests",
    "read_cut",
    "read_max",
    "reconcile_counts",
    "replacing_merge",
    "row_counts",
    "row_digest",
    "rows_of_ranges",
    "same_rows",
    "select_tables",
    "SIGN_COLUMN",
    "signed_rows",
    "snapshot_changes",
    "strict_batch",
    "summing_merge",
    "surplus_by_sketch",
    "surplus_rows",
    "tail_by_count",
    "tie_safe_batch",
    "tie_safe_batches",
    "uneven_digests",
    "uneven_hashes",
    "uneven_ranges",
    "unite_intervals",
    "versioned_collapse",
    "watermark_profile",
    "whole_intervals",
]

from tidemark.plans.incremental import add_late_rows, catch_up, drain, late_rows, poll_once, poll_table, recover, store
from tidemark.plans.late import add_late_ranges, late_in_ranges, uneven_ranges_of
from tidemark.plans.mirror import fold_mirror, mirror_table, read_changes
from tidemark.plans.replicate import (
    claim_tables,
    copy_tables,
    drain_cycle,
    poll_cycle,
    read_mirrored,
    read_synced,
    state_path,
    sync_tables,
    target_path,
)
from tidemark.plans.snapshot import (
    CopyResult,
    fold_target,
    snapshot_in_parts,
    snapshot_plus_delta,
    snapshot_rows,
    snapshot_table,
    table_watermark,
)

__all__ = [
    "add_late_ranges",
    "add_late_rows",
    "catch_up",
    "claim_tables",
    "copy_tables",
    "CopyResult",
    "drain",
    "drain_cycle",
    "fold_mirror",
    "fold_target",
    "late_in_ranges",
    "late_rows",
    "mirror_table",
    "poll_cycle",
    "poll_once",
    "poll_table",
    "read_changes",
    "read_mirrored",
    "read_synced",
    "recover",
    "snapshot_in_parts",
    "snapshot_plus_delta",
    "snapshot_rows",
    "snapshot_table",
    "state_path",
    "store",
    "sync_tables",
    "table_watermark",
    "target_path",
    "uneven_ranges_of",
]

from tidemark.streaming.follow import derived_errors, drop_repeats, follow, follow_in_batches, read_stream
from tidemark.streaming.latest import OP_COLUMN, latest_versions, use_disk_state

__all__ = [
    "OP_COLUMN",
    "derived_errors",
    "drop_repeats",
    "follow",
    "follow_in_batches",
    "latest_versions",
    "read_stream",
    "use_disk_state",
]

from tidemark.sources.jsonlines import (
    count_bad_lines,
    read_json_lines,
    read_with_bad_lines,
    write_json_lines,
)
from tidemark.sources.ledger import discard_digests, ledger_path, read_digests, record_digests, write_digests
from tidemark.sources.progress import compact_intervals, read_intervals, record_intervals
from tidemark.sources.state import (
    STATE_SCHEMA,
    append_state,
    append_state_rows,
    compact_state_log,
    fold_state,
    latest_per_key,
    load_state,
    pending_batches,
    read_state_log,
    state_of,
)
from tidemark.sources.tables import file_reader, list_tables, table_reader
from tidemark.sources.target import (
    check_schema,
    check_target,
    discard_uncommitted,
    month_layout,
    read_target,
    target_schema,
    write_batch,
    write_batches,
    write_derived,
)
from tidemark.sources.writer import StaleWriterError, check_writer, claim_writer

__all__ = [
    "STATE_SCHEMA",
    "StaleWriterError",
    "append_state",
    "append_state_rows",
    "check_schema",
    "check_target",
    "check_writer",
    "claim_writer",
    "compact_intervals",
    "compact_state_log",
    "count_bad_lines",
    "discard_digests",
    "discard_uncommitted",
    "file_reader",
    "fold_state",
    "latest_per_key",
    "ledger_path",
    "list_tables",
    "load_state",
    "month_layout",
    "pending_batches",
    "read_digests",
    "read_intervals",
    "read_json_lines",
    "read_state_log",
    "read_target",
    "read_with_bad_lines",
    "record_digests",
    "record_intervals",
    "state_of",
    "table_reader",
    "target_schema",
    "write_batch",
    "write_batches",
    "write_derived",
    "write_digests",
    "write_json_lines",
]

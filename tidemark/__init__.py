"""Table replication on Spark: snapshot, incremental follow-up, reconciliation."""

from tidemark.types import TableSpec, TableState, Watermark

__all__ = ["TableSpec", "TableState", "Watermark"]

"""Table writers."""

from postmill.sinks.batches import BATCH, append_batch
from postmill.sinks.tables import ensure_database, materialize_view, write_table
from postmill.sinks.upsert import upsert_table

__all__ = ["BATCH", "append_batch", "ensure_database", "materialize_view", "upsert_table", "write_table"]

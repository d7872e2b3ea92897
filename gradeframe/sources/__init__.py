"""Sources and sinks: table derivation from the inputs, parquet snapshots."""

from gradeframe.sources.model import Tables, load
from gradeframe.sources.store import CommitConflict, StoredTables, materialize, read_table, table_path, with_retries, write_snapshot
from gradeframe.sources.typed import SchemaMismatch

__all__ = ["CommitConflict", "SchemaMismatch", "StoredTables", "Tables", "load", "materialize", "read_table", "table_path", "with_retries",
           "write_snapshot"]

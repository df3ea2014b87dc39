"""Where results go."""

from meterline.sinks.batches import BatchFolder, BatchTable, attempts_of
from meterline.sinks.billing import new_run, publish_tables, read_published, record_run, run_path
from meterline.sinks.segments import SegmentFolder, compact, vacuum
from meterline.sinks.tables import export_csv, write_documents, write_table

__all__ = [
    "BatchFolder",
    "BatchTable",
    "SegmentFolder",
    "attempts_of",
    "compact",
    "export_csv",
    "new_run",
    "publish_tables",
    "read_published",
    "record_run",
    "run_path",
    "vacuum",
    "write_documents",
    "write_table",
]

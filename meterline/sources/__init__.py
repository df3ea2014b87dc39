"""Where records and tables come from; addresses and credentials are options, never code."""

from meterline.sources.raw import read_mediated, read_raw, stream_clean, stream_raw
from meterline.sources.tables import (
    jdbc_options,
    read_balances,
    read_batches,
    read_clients,
    read_consumption,
    read_published_table,
    read_segments,
    read_table,
)

__all__ = [
    "jdbc_options",
    "read_balances",
    "read_batches",
    "read_clients",
    "read_consumption",
    "read_mediated",
    "read_published_table",
    "read_raw",
    "read_segments",
    "read_table",
    "stream_clean",
    "stream_raw",
]

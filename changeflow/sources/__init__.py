"""Sources: table scans, fixture views derived from them, and stream readers."""

from changeflow.sources.tables import read_table, jdbc_table, TABLES
from changeflow.sources.fixtures import order_lines, cdc_base, cdc_raw, envelope_raw, flat_raw
from changeflow.sources.streams import kafka_stream, kafka_options, file_stream

__all__ = ["read_table", "jdbc_table", "TABLES", "order_lines", "cdc_base", "cdc_raw",
           "envelope_raw", "flat_raw", "kafka_stream", "kafka_options", "file_stream"]

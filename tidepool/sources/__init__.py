"""Sources: driver tables, text lines, streaming text and Kafka adapters."""

from tidepool.sources.tables import load_table, load_events, TABLES
from tidepool.sources.text import read_lines, stream_lines, stream_lines_with_origin, from_rows

__all__ = ["load_table", "load_events", "TABLES", "read_lines", "stream_lines",
           "stream_lines_with_origin", "from_rows"]

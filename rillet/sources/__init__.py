"""Sources: parquet tables, literal rows, text/CSV files, JSON streams."""

from rillet.sources.tables import (
    load, register_views, role_bits, role_lines, role_payments, role_signal, role_teams,
)
from rillet.sources.files import from_rows, read_csv_lines, read_text_lines, read_text_stream
from rillet.sources.json_stream import (
    decode_json, kafka_options, kafka_options_from_connector, read_json_stream, read_segments, split_quarantine,
    with_event_time,
)

__all__ = [
    "load", "register_views", "role_bits", "role_lines", "role_payments", "role_signal", "role_teams",
    "from_rows", "read_csv_lines", "read_text_lines", "read_text_stream",
    "decode_json", "kafka_options", "kafka_options_from_connector", "read_json_stream", "read_segments", "split_quarantine", "with_event_time",
]

"""Column expressions shared by the layers."""

from tidemark.functions.hashing import row_hash
from tidemark.functions.text import decode_path, name_from_path, safe_name, split_location
from tidemark.functions.times import clock_text, date_key, month_text, wall_time_text
from tidemark.functions.typed import split_typed

__all__ = [
    "clock_text",
    "date_key",
    "decode_path",
    "month_text",
    "name_from_path",
    "row_hash",
    "safe_name",
    "split_location",
    "split_typed",
    "wall_time_text",
]

from starloom.functions.temporal import calendar_parts, date_key, epoch_ms_to_seconds
from starloom.functions.text import parse_text

__all__ = ["calendar_parts", "date_key", "epoch_ms_to_seconds", "parse_text"]

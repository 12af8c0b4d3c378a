from .keys import (
    OPEN_END,
    date_key,
    day_start,
    id_key,
    open_end,
    render_timestamp,
    version_key,
)
from .parse import malformed, parse

__all__ = [
    "OPEN_END",
    "date_key",
    "day_start",
    "id_key",
    "malformed",
    "open_end",
    "parse",
    "render_timestamp",
    "version_key",
]

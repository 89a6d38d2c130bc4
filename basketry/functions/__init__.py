from .text import (
    LOG_MARKER,
    after_marker,
    has_marker,
    log_line,
    parse_rating_fields,
    parse_recent_entry,
    recent_entry,
    split_list,
)
from .values import epoch_seconds, java_string_hash, log_gain, normalise_score, year_month

__all__ = [
    "LOG_MARKER",
    "after_marker",
    "epoch_seconds",
    "has_marker",
    "java_string_hash",
    "log_gain",
    "log_line",
    "normalise_score",
    "parse_rating_fields",
    "parse_recent_entry",
    "recent_entry",
    "split_list",
    "year_month",
]

"""Scalar column helpers (FN-*)."""

from tidepool.functions.text import normalize_int, tokenize, tokenize_jvm
from tidepool.functions.timecols import next_midnight, parse_log_time, render_ms

__all__ = ["next_midnight", "render_ms", "parse_log_time", "tokenize", "tokenize_jvm", "normalize_int"]

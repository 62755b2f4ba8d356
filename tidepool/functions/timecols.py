"""Event-time helpers (FN-7, FN-8). All JVM-side expressions; times are UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def next_midnight(ts) -> Column:
    """FN-8: the next UTC midnight after ``ts`` (a midnight's is a day later)."""
    return F.date_trunc("day", _c(ts)) + F.expr("INTERVAL 1 DAY")


def render_ms(ms) -> Column:
    """FN-7: epoch milliseconds as ``yyyy-MM-dd HH:mm:ss.S``; the fraction has no
    zeros at its end, but one digit at least."""
    ms = _c(ms)
    part = F.rtrim(F.lpad(F.pmod(ms, F.lit(1000)).cast("string"), 3, "0"), F.lit("0"))
    text = F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss")
    return F.concat(text, F.lit("."), F.when(part == "", "0").otherwise(part))


def parse_log_time(s) -> Column:
    """FN-7: access-log time ``dd/MM/yyyy:HH:mm:ss`` -> TIMESTAMP (NULL if malformed)."""
    return F.try_to_timestamp(_c(s), F.lit("dd/MM/yyyy:HH:mm:ss"))

"""Text helpers (PRJ-6, PRJ-8, FN-1..4). Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ASCII whitespace class shared with the SQL oracle (space, \t, \n, \v, \f, \r).
ASCII_SPACE = "[ \\t\\n\\x0B\\f\\r]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(df: DataFrame, text_col: str = "value", pattern: str = ASCII_SPACE,
             drop_empty: bool = True, out: str = "word") -> DataFrame:
    """PRJ-6: one row per token of ``text_col`` split by the regex ``pattern``.

    With ``drop_empty=False`` empty tokens stay as the JVM's ``split`` keeps them:
    one before a separator at the beginning, none after one at the end, one for
    an empty text, none for a text of separators alone.
    """
    text = _c(text_col)
    if drop_empty:
        return df.select(F.explode(F.split(text, pattern)).alias(out)).where(F.length(out) > 0)
    cut = F.regexp_replace(text, f"(?:{pattern})$", "")
    return (df.select(text.alias("_all"), cut.alias("_cut")).where((F.col("_cut") != "") | (F.col("_all") == ""))
              .select(F.explode(F.split("_cut", pattern)).alias(out)))


def tokenize_jvm(df: DataFrame, text_col: str = "value", sep: str = " ",
                 out: str = "word") -> DataFrame:
    """PRJ-6 variant: literal single-character split with JVM semantics.

    Interior empty tokens are kept, trailing empty tokens are dropped; a text
    made only of separators yields no tokens.
    """
    trimmed = F.rtrim(_c(text_col), F.lit(sep))
    esc = "\\" + sep if sep in ".$|()[]{}^?*+\\" else sep
    return (df.select(trimmed.alias("_t"))
              .where(F.col("_t") != "")
              .select(F.explode(F.split("_t", esc)).alias(out)))


def normalize_int(col, lenient: bool = True) -> Column:
    """PRJ-8: integer text normalisation ("007" -> "7"). Text that is no 64-bit
    integer gives NULL when ``lenient``, else an error (an ANSI cast)."""
    t = F.trim(_c(col))
    return (t.try_cast("bigint") if lenient else t.cast("bigint")).cast("string")

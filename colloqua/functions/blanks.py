"""What counts as blank: every separator, control, format or otherwise invisible code point."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Body of a character class, the same in Java's and RE2's dialect.
INVISIBLE = (
    r"\p{Z}\p{Cc}\p{Cf}\x{034F}\x{115F}\x{1160}\x{17B4}\x{17B5}"
    r"\x{180B}-\x{180D}\x{2800}\x{3164}\x{FE00}-\x{FE0F}\x{FFA0}"
)


def strip_blanks(c: Column) -> Column:
    """``c`` without blanks at either end; null stays null."""
    return F.regexp_replace(c, f"^[{INVISIBLE}]+|[{INVISIBLE}]+$", "")


def has_visible(c: Column) -> Column:
    """True if ``c`` holds a visible character; false for null."""
    return F.coalesce(c.rlike(f"[^{INVISIBLE}]"), F.lit(False))

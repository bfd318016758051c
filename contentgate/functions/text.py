"""Text measures and predicates shared by the gates and the extractors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a trim removes (ECMAScript white space and line
# terminators). Spark's own trim() strips blanks only.
BLANK_CHARS = (
    r"\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
)


def is_blank(text: Column) -> Column:
    """True when nothing but white space remains; stops at the first other character."""
    return ~text.rlike(f"[^{BLANK_CHARS}]")


def utf16_units(text: Column) -> Column:
    """Length in UTF-16 code units, the unit the size limit is stated in. NULL counts 0."""
    encoded = F.octet_length(F.encode(text, "UTF-16BE"))
    return F.coalesce(F.shiftright(encoded, 1), F.lit(0)).cast("bigint")


def non_empty(text: Column) -> Column:
    """NULL for the empty string, so coalesce() can pick a fallback."""
    return F.nullif(text, F.lit(""))


def epoch_ms(ts: Column) -> Column:
    """Whole milliseconds since the epoch, floored. Accepts zoned and local timestamps."""
    return F.unix_millis(ts.cast("timestamp"))

"""Column helpers for text and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The characters with Unicode's White_Space property.
WHITE_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def _visible(text: Column) -> Column:
    """Whether a text starts with a visible character of ASCII, none of which is white space."""
    return (text >= F.lit("!")) & (text < F.lit("\x7f"))


def stripped(col: Column | str) -> Column:
    """Text without white space at its ends: tabs and line breaks as well as spaces.

    Nearly every value starts and ends with a visible character of ASCII, which
    two comparisons tell; only the others are searched for the whole set. The last
    byte is such a character or part of another one, and needs no count of characters.
    """
    text = F.col(col) if isinstance(col, str) else col
    last = F.substring(text.cast("binary"), -1, 1)
    clean = _visible(text) & (last >= F.lit(b"!")) & (last < F.lit(b"\x7f"))
    return F.when(clean, text).otherwise(F.trim(text, F.lit(WHITE_SPACE)))


def trimmed(name: str) -> Column:
    return stripped(name).alias(name)


def lower_text(name: str) -> Column:
    return F.lower(stripped(name)).alias(name)


def upper_code(name: str) -> Column:
    return F.upper(stripped(name)).alias(name)


def blank_to_null(col: Column | str) -> Column:
    """Trimmed text, with an empty result turned into null."""
    return F.nullif(stripped(col), F.lit(""))


def or_unknown(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("unknown"))


def place_label(city: str, state: str, separator: str = " / ") -> Column:
    return F.concat(F.col(city), F.lit(separator), F.col(state))


def label_tail(col: Column | str, separator: str = " / ") -> Column:
    """Text after the last separator."""
    return F.substring_index(col, separator, -1)


def label_head(col: Column | str, separator: str = " / ") -> Column:
    """Text before the last separator; the whole text if there is none."""
    tail = label_tail(col, separator)
    text = F.col(col) if isinstance(col, str) else col
    cut = F.length(text) - F.length(tail) - F.lit(len(separator))
    return F.when(cut >= 0, F.substring(text, F.lit(1), cut)).otherwise(text)

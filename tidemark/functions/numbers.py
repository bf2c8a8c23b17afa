"""Numbers in response texts.

A cast alone accepts more than the feeds mean (Java reads "1.5d" and "0x1p3"),
so the text is matched first and what does not match counts as unreadable. The
patterns are possessive, which Java matches in a loop however long a text is.
Digits and blanks of any script count.
"""

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = r"\d++(?:_\d++)*+"
REAL_TEXT = (
    rf"^\s*+[+-]?+(?:(?:{DIGITS}(?:\.(?:{DIGITS})?+)?+|\.{DIGITS})(?:[eE][+-]?+{DIGITS})?+"
    r"|(?i:inf|infinity|nan))\s*+$"
)
INTEGER_TEXT = rf"^\s*+[+-]?+{DIGITS}\s*+$"

_BEYOND = [chr(c) for c in range(0x80, sys.maxunicode + 1)]
_DIGITS = "".join(c for c in _BEYOND if c.isdecimal())
_BLANKS = "".join(c for c in _BEYOND if c.isspace())
_PLAIN = "".join(str(unicodedata.decimal(c)) for c in _DIGITS) + " " * len(_BLANKS)


def _plain(text: Column) -> Column:
    """The text with digits and blanks of other scripts as those of ASCII."""
    other = F.octet_length(text) > F.length(text)
    return F.when(other, F.translate(text, _DIGITS + _BLANKS, _PLAIN)).otherwise(text)


def _without_marks(text: Column) -> Column:
    return F.replace(_plain(text), F.lit("_"), F.lit(""))


def real_value(text: Column) -> Column:
    """Number as a float, NULL where the text is not one."""
    return F.when(_plain(text).rlike(REAL_TEXT), _without_marks(text).try_cast("double").cast("float"))


def integer_accepted(text: Column) -> Column:
    """Whether the text is a whole number, however large."""
    return F.coalesce(_plain(text).rlike(INTEGER_TEXT), F.lit(False))


def integer_value(text: Column) -> Column:
    """Whole number as a 32-bit integer; NULL when unreadable or out of range."""
    return F.when(_plain(text).rlike(INTEGER_TEXT), _without_marks(text).try_cast("int"))

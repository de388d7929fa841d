"""Text expressions: trimming, comparison keys, digit and code tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the characters that text trimming removes, blanks of all scripts and the four separator controls
BLANKS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# (?U): blanks and digits of all scripts
_BLANK_RUN = r"(?U)[\s\x1c-\x1f]+"
_SEPARATORS = r"[.\-_/]+"
_DIGITS_ONLY = r"(?U)\A\d+\z"


def name(column: str) -> Column:
    """Column reference that survives dots, slashes and backticks in the name."""
    return F.col("`" + column.replace("`", "``") + "`")


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def strip_upper(c: Column) -> Column:
    return F.upper(strip(c))


def comparison_key(c: Column) -> Column:
    """Key shared by the spelling variants of one name: case, separators and blank runs do not count."""
    spaced = F.regexp_replace(strip_upper(c), _SEPARATORS, " ")
    return strip(F.regexp_replace(spaced, _BLANK_RUN, " "))


def is_digits(c: Column) -> Column:
    """True where the stripped text is digits only; missing text is not."""
    return F.coalesce(strip(c).rlike(_DIGITS_ONLY), F.lit(False))


def is_code_like(c: Column) -> Column:
    """A digit together with a letter or a separator."""
    text = strip(c)
    return text.rlike(r"(?U)\d") & (text.rlike(r"[-_*./]") | text.rlike(r"[A-Za-z]"))

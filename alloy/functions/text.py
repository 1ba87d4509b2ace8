"""Text normalisation columns (SC1-SC3).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accent map used for city names. Each character of
# ACCENTED becomes the character at the same place in PLAIN; every other
# character (for example ñ, ü, ä) is left as it is.
ACCENTED = "áàâãéèêíìîóòôõúùûç"
PLAIN = "aaaaeeeiiioooouuuc"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """``trim``: removes spaces (0x20) at both ends; tabs and newlines stay."""
    return F.trim(_col(c))


def normalise(c: str | Column) -> Column:
    """``lower(trim(x))``: the rule for codes such as status or state."""
    return F.lower(F.trim(_col(c)))


def fold_accents(c: str | Column) -> Column:
    """Replace the mapped accented lower-case letters by plain ones."""
    return F.translate(_col(c), ACCENTED, PLAIN)


def text_rule(c: str | Column, *, trim: bool = False, lower: bool = False,
              fold: bool = False) -> Column:
    """Apply trim, then lower, then accent folding, each when asked for."""
    out = _col(c)
    if trim:
        out = F.trim(out)
    if lower:
        out = F.lower(out)
    if fold:
        out = fold_accents(out)
    return out

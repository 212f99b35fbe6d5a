"""Text cleaning and safe casting of scraped board fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

BOARD_DECIMAL = DecimalType(20, 6)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_token(c, token: str) -> Column:
    """Remove every occurrence of ``token`` (not only a suffix)."""
    return F.replace(_col(c), F.lit(token), F.lit(""))


def clean_text(c, strip: tuple[str, ...] = (",",)) -> Column:
    """Trim surrounding spaces, then delete each character sequence in ``strip``.

    Order matters only for overlapping tokens; percent signs are stripped
    before thousands separators, as on the board's change columns.
    """
    out = F.trim(_col(c))
    for tok in strip:
        out = strip_token(out, tok)
    return out


def safe_cast(c, dtype: DataType = BOARD_DECIMAL, mode: str = "safe") -> Column:
    """Blank -> NULL, then cast.  ``safe`` yields NULL on bad text, ``strict`` raises."""
    blanked = F.nullif(_col(c), F.lit(""))
    if mode == "safe":
        return blanked.try_cast(dtype)
    if mode == "strict":
        return blanked.cast(dtype)
    raise ValueError(f"unknown cast mode {mode!r}")


def clean_numeric(c, strip: tuple[str, ...] = (",",), mode: str = "safe",
                  dtype: DataType = BOARD_DECIMAL) -> Column:
    return safe_cast(clean_text(c, strip), dtype, mode)

"""Report number formatting.

The report renders Python format specs (``+.0f``, ``.0f``, ``.1f``, ``.2f``),
which round half-to-even on the decimal value; Java's format_string rounds
HALF_UP, so values are ``bround``-ed on Decimal first and then printed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Colours and placeholder of the daily report.
GAIN_COLOR = "#0a7d2c"
LOSS_COLOR = "#c02626"
MISSING = "n/a"

_WIDE = DecimalType(38, 10)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _digits(c, n: int) -> Column:
    """|c| rounded half-to-even to n places, printed plainly."""
    return F.bround(F.abs(_col(c)).cast(_WIDE), n).cast(DecimalType(38, n)).cast("string")


def _fixed(c, n: int, plus: bool = False) -> Column:
    # The sign follows the unrounded value, so -0.3 prints as "-0" like
    # Python's formatter does.
    neg = F.when(_col(c) < 0, F.lit("-")).otherwise(F.lit("+" if plus else ""))
    return F.concat(neg, _digits(c, n))


def fmt_signed_pct(c) -> Column:
    """``+3%`` / ``-1%``; NULL -> ``n/a``."""
    return F.coalesce(F.concat(_fixed(c, 0, plus=True), F.lit("%")), F.lit(MISSING))


def fmt_int(c) -> Column:
    return F.coalesce(_fixed(c, 0), F.lit(MISSING))


def fmt_ratio(c) -> Column:
    return F.coalesce(F.concat(_fixed(c, 1), F.lit("x")), F.lit(MISSING))


def fmt_money(c, n: int = 2) -> Column:
    """Fixed n decimals, no thousands separator; NULL -> ``n/a``."""
    return F.coalesce(_fixed(c, n), F.lit(MISSING))


def sign_color(c) -> Column:
    """Green for >= 0, red for negative or NULL."""
    return F.when(_col(c) >= 0, F.lit(GAIN_COLOR)).otherwise(F.lit(LOSS_COLOR))

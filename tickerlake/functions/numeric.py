"""Exact-decimal arithmetic helpers.

Rounding is HALF_UP (half away from zero) on DecimalType, which is the
numeric rounding the marts are specified with.  Doubles are never rounded:
callers cast to Decimal first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 4)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, n: int) -> Column:
    return F.round(_col(c), n)


# Operands of a quotient are narrowed to this type: with 18 integer digits on
# both sides Spark keeps 12 fractional digits in the quotient (instead of
# falling back to 6 for wide sums), so a later round to <= 4 places is not
# double-rounded.  Values beyond 1e18 raise (ANSI) rather than lose digits.
QUOTIENT_OPERAND = DecimalType(26, 8)


def ratio(num, den) -> Column:
    """num / den as DECIMAL(38,12); NULL when den is 0 or NULL (never raises)."""
    d = F.nullif(_col(den), F.lit(0)).cast(QUOTIENT_OPERAND)
    return F.try_divide(_col(num).cast(QUOTIENT_OPERAND), d)


def pct_of(num, den, n: int | None = 2) -> Column:
    """100 * num / den rounded to n places; NULL on a zero denominator.

    The quotient is taken first: 100 * num of a large total would not fit the operand type.
    """
    out = F.lit(100) * ratio(num, den).cast(DecimalType(34, 12))
    return out if n is None else F.round(out, n)


def gated(c, count, n: int) -> Column:
    """Value only when the frame behind it held exactly ``n`` observations."""
    return F.when(_col(count) == n, _col(c))


def coalesce0(*cols) -> Column:
    """Null-safe sum of columns: each NULL counts as 0."""
    out = None
    for c in cols:
        term = F.coalesce(_col(c), F.lit(0))
        out = term if out is None else out + term
    return out

"""Column -> Column helpers (all built-in Spark SQL expressions, no UDFs)."""

from tickerlake.functions.cleaning import clean_numeric, clean_text, safe_cast, strip_token
from tickerlake.functions.numeric import coalesce0, gated, pct_of, ratio, round_half_up
from tickerlake.functions.formatting import (
    fmt_int,
    fmt_money,
    fmt_ratio,
    fmt_signed_pct,
    sign_color,
)

__all__ = [
    "clean_numeric", "clean_text", "safe_cast", "strip_token",
    "coalesce0", "gated", "pct_of", "ratio", "round_half_up",
    "fmt_int", "fmt_money", "fmt_ratio", "fmt_signed_pct", "sign_color",
]

"""Silver layer: clean, type and de-duplicate the raw board; type the bars."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlake.functions.cleaning import BOARD_DECIMAL, clean_text, safe_cast, strip_token

# Placeholder rows the board publishes that are not real quotes,
# as (symbol, cleaned ldcp text, cleaned current text).
DEFAULT_EXCLUSIONS: tuple[tuple[str, str, str], ...] = (
    ("ENGRO", "285.50", "287.00"),
    ("LUCK", "920.00", "915.00"),
    ("HBL", "145.00", "146.50"),
    ("PSO", "310.00", "308.00"),
    ("TRG", "98.50", "99.00"),
)

# Fixed value: the ex-dividend marker the board appends to symbols.
XD_MARKER = " XD"

# Output column -> (raw column, tokens stripped after trimming)
_BOARD_NUMERIC = (
    ("ldcp", "ldcp", (",",)),
    ("current_price", "current", (",",)),
    ("change_amount", "change", (",",)),
    ("change_pct", "change_1", ("%", ",")),
    ("idx_weight", "idx_wtg", ("%", ",")),
    ("idx_point", "idx_point", (",",)),
    ("volume", "volume", (",",)),
    ("shares_m", "shares_m", (",",)),
    ("market_cap_m", "market_cap_m", (",",)),
)

BOARD_COLUMNS = ("id", "fetched_at", "symbol", "name") + tuple(o for o, _, _ in _BOARD_NUMERIC)

BARS_COLUMNS = ("id", "symbol", "price_date", "open", "high", "low", "close", "volume",
                "dividends", "stock_splits", "fetched_at")


def exclusion_predicate(exclusions: Iterable[tuple[str, str, str]]) -> Column | None:
    """AND of NOT(symbol = s AND ldcp = a AND current = b) over the list.

    Three-valued on purpose: a row whose comparison is NULL (e.g. the symbol
    matches and ldcp is NULL) makes the predicate NULL and is dropped, which
    an anti-join would not do.
    """
    pred = None
    for sym, ldcp, cur in exclusions:
        term = ~((F.col("symbol") == F.lit(sym))
                 & (F.col("ldcp_clean") == F.lit(ldcp))
                 & (F.col("current_price_clean") == F.lit(cur)))
        pred = term if pred is None else pred & term
    return pred


def stage_board(raw: DataFrame, exclusions: Iterable[tuple[str, str, str]] = DEFAULT_EXCLUSIONS,
                grain: str = "fetched_at", mode: str = "safe") -> DataFrame:
    """Clean + type + keep the latest row (highest id) per (snapshot, symbol).

    ``grain="fetched_at"`` de-duplicates per raw snapshot timestamp (the
    specified behaviour); ``grain="day"`` per calendar day of it.

    Plan: the ``row_number() = 1`` filter is rewritten by Catalyst into a
    WindowGroupLimit that runs *before* the shuffle, so each map task sends at
    most one row per key; a hot key cannot flood one reducer.
    """
    symbol = F.trim(strip_token("symbol", XD_MARKER))
    raw_cols = [src for _, src, _ in _BOARD_NUMERIC]
    keyed = raw.select("id", "fetched_at", symbol.alias("symbol"), "name", *raw_cols)
    if grain == "fetched_at":
        key = [F.col("fetched_at"), F.col("symbol")]
    elif grain == "day":
        key = [F.to_date("fetched_at"), F.col("symbol")]
    else:
        raise ValueError(f"unknown grain {grain!r}")
    w = Window.partitionBy(*key).orderBy(F.col("id").desc_nulls_first())
    latest = keyed.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1)
    # Text cleaning is per row, so it is applied after the latest-row filter:
    # only surviving rows pay for it.
    latest = latest.select(
        "id", "fetched_at", "symbol", "name",
        *[clean_text(src, toks).alias(f"{out}_clean") for out, src, toks in _BOARD_NUMERIC],
    )
    excl = list(exclusions)
    if excl:
        latest = latest.where(exclusion_predicate(excl))
    return latest.select(
        "id", "fetched_at", "symbol", "name",
        *[safe_cast(f"{out}_clean", BOARD_DECIMAL, mode).alias(out) for out, _, _ in _BOARD_NUMERIC],
    )


def stage_bars(raw: DataFrame) -> DataFrame:
    """Typed pass-through of the OHLCV history (11 columns)."""
    return raw.select(*BARS_COLUMNS)

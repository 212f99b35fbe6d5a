"""Board cleaning landmines: casts, symbols, de-duplication, exclusion logic."""

import datetime as dt
from decimal import Decimal

import pytest

from tickerlake.functions.cleaning import clean_numeric
from tickerlake.operators.staging import stage_board
from tickerlake.schemas import BOARD_RAW


def test_clean_numeric_safe(spark):
    df = spark.createDataFrame([(" 1,234.50 ",), ("",), (" % ",), ("-",), ("1.5 %",), (None,)], "s string")
    got = [r[0] for r in df.select(clean_numeric("s", ("%", ","))).collect()]
    # "1.5 %" -> "1.5 ": trailing blanks are accepted by the numeric cast
    assert got == [Decimal("1234.500000"), None, None, None, Decimal("1.500000"), None]


def test_clean_numeric_strict_raises(spark):
    df = spark.createDataFrame([("-",)], "s string")
    with pytest.raises(Exception):
        df.select(clean_numeric("s", mode="strict")).collect()


def _row(i, sym, ldcp="1.00", cur="2.00", ts=dt.datetime(2024, 1, 1, 9, 0)):
    return (i, ts, sym, "N", ldcp, cur, "0.5", "1.25%", "1%", "1", "1,000", "1", "10")


def test_symbol_cleanup_and_dedupe(spark):
    rows = [_row(1, "ABC XD"), _row(2, " ABC"), _row(3, "ABC XDX"), _row(None, "ZZZ"), _row(9, "ZZZ")]
    out = stage_board(spark.createDataFrame(rows, BOARD_RAW), exclusions=())
    got = {(r.symbol, r.id) for r in out.collect()}
    # ' XD' is removed everywhere (ABC XDX -> ABCX); ABC and 'ABC XD' collapse
    # to the higher id; a NULL id sorts first under descending order.
    assert got == {("ABC", 2), ("ABCX", 3), ("ZZZ", None)}


def test_exclusion_is_three_valued(spark):
    ex = (("ABC", "285.50", "287.00"),)
    rows = [
        _row(1, "ABC", "285.50", "287.00"),   # full match -> dropped
        _row(2, "DEF", None, None),           # other symbol with NULLs -> kept
        _row(3, "GHI", None, "287.00", ts=dt.datetime(2024, 1, 2)),
        _row(4, "ABC", None, "287.00", ts=dt.datetime(2024, 1, 3)),  # NULL -> dropped
    ]
    out = stage_board(spark.createDataFrame(rows, BOARD_RAW), exclusions=ex)
    assert sorted(r.id for r in out.collect()) == [2, 3]


def test_excluded_latest_hides_older_duplicate(spark):
    ex = (("ABC", "285.50", "287.00"),)
    rows = [_row(1, "ABC", "1.00", "2.00"), _row(2, "ABC", "285.50", "287.00")]
    out = stage_board(spark.createDataFrame(rows, BOARD_RAW), exclusions=ex)
    assert out.count() == 0


def test_dedupe_grain_day(spark):
    rows = [_row(1, "ABC", ts=dt.datetime(2024, 1, 1, 9)), _row(2, "ABC", ts=dt.datetime(2024, 1, 1, 15))]
    df = spark.createDataFrame(rows, BOARD_RAW)
    assert stage_board(df, exclusions=()).count() == 2
    assert [r.id for r in stage_board(df, exclusions=(), grain="day").collect()] == [2]


def test_dedupe_uses_group_limit(spark, capsys):
    stage_board(spark.createDataFrame([], BOARD_RAW)).explain()
    assert "WindowGroupLimit" in capsys.readouterr().out

"""Property tests (hypothesis): each example is one Spark job over a generated batch."""

import datetime as dt
from decimal import Decimal, InvalidOperation

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickerlake.functions.cleaning import clean_numeric
from tickerlake.operators.staging import stage_board
from tickerlake.schemas import BOARD_RAW
from tickerlake.sources import ingest as ing

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

board_text = st.text(alphabet=" 0123456789,.%-", max_size=12)


def py_clean(s, strip):
    """Literal reading: trim spaces, drop tokens, blank -> NULL, numeric cast or NULL."""
    if s is None:
        return None
    t = s.strip(" ")
    for tok in strip:
        t = t.replace(tok, "")
    if t == "":
        return None
    try:
        v = Decimal(t.strip(" "))
    except InvalidOperation:
        return None
    if not v.is_finite() or "e" in t.lower():
        return None
    return v.quantize(Decimal("0.000001"))


@SETTINGS
@given(st.lists(st.one_of(st.none(), board_text), min_size=1, max_size=40))
def test_clean_numeric_matches_literal_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(clean_numeric("s", ("%", ","))).collect()]
    want = []
    for v in values:
        try:
            w = py_clean(v, ("%", ","))
        except Exception:
            w = None
        if w is not None and len(w.as_tuple().digits) - max(0, -w.as_tuple().exponent) > 14:
            w = None  # beyond DECIMAL(20,6)
        want.append(w)
    assert got == want


keys = st.tuples(st.sampled_from("ABC"), st.integers(0, 5))


@SETTINGS
@given(st.lists(keys, max_size=10), st.lists(st.lists(keys, max_size=8), min_size=1, max_size=3))
def test_insert_only_equals_sequential_first_write(spark, existing, batches):
    schema = "sym string, d int, v int, arrival int"
    state = {}
    for k in existing:
        state.setdefault(k, -1)
    target_rows = [(s, d, v, 0) for (s, d), v in state.items()]
    target = spark.createDataFrame(target_rows, schema)
    for bi, batch in enumerate(batches):
        rows = [(s, d, bi * 100 + i, i) for i, (s, d) in enumerate(batch)]
        new = ing.insert_only(target, spark.createDataFrame(rows, schema), ["sym", "d"], ["arrival"])
        for (s, d), v in [((r.sym, r.d), r.v) for r in new.collect()]:
            assert (s, d) not in state
            state[(s, d)] = v
        # python: the first row per key of this batch, unless the key exists
        for i, (s, d) in enumerate(batch):
            assert (s, d) in state
        target = target.unionByName(new)
    # keys in the final target are unique and are exactly existing + all batch keys
    final = [(r.sym, r.d) for r in target.collect()]
    assert len(final) == len(set(final)) == len(set(existing) | {k for b in batches for k in b})


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 60), st.sampled_from(["AB", "AB XD", " AB", "CD"]),
                          st.integers(1, 3)), min_size=1, max_size=30, unique_by=lambda t: t[0]))
def test_dedupe_leaves_latest_row_per_key(spark, rows):
    raw = [(i, dt.datetime(2024, 1, day), sym, "n", "1", "2", "0", "1%", "1%", "1", "1", "1", "1")
           for i, sym, day in rows]
    out = [(r.fetched_at.day, r.symbol, r.id) for r in stage_board(spark.createDataFrame(raw, BOARD_RAW),
                                                                     exclusions=()).collect()]
    want = {}
    for i, sym, day in rows:
        k = (day, sym.replace(" XD", "").strip())
        want[k] = max(want.get(k, 0), i)
    assert sorted(out) == sorted((d, s, i) for (d, s), i in want.items())


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.decimals(min_value=-10**6, max_value=10**6, places=4,
                                                 allow_nan=False, allow_infinity=False)),
                min_size=1, max_size=40))
def test_report_formats_equal_python_format_specs(spark, values):
    from tickerlake.functions.formatting import fmt_int, fmt_money, fmt_ratio, fmt_signed_pct

    # no negative zero in Spark or in the reference's numeric values
    values = [None if v is None else v + 0 for v in values]
    df = spark.createDataFrame([(v,) for v in values], "x decimal(20,4)")
    got = [tuple(r) for r in df.select(fmt_signed_pct("x"), fmt_int("x"), fmt_ratio("x"), fmt_money("x")).collect()]
    want = [("n/a",) * 4 if v is None else (f"{v:+.0f}%", f"{v:.0f}", f"{v:.1f}x", f"{v:.2f}") for v in values]
    assert got == want

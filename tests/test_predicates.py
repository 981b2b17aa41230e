"""ANSI-safe row predicates: integral text, numeric text, quoting."""

import pytest

from assay.functions.predicates import is_integral_text, is_non_positive, is_zero, quote

# (text, reads as a whole number that fits in 64 bits)
INTEGRAL_CASES = [
    ("12", True), ("-7", True), ("+3", True), (" 42 ", True), ("12.0", True), ("12.000", True), ("0", True),
    ("12.5", False), ("abc", False), ("", False), ("1e3", False), ("12.", True), (".5", False),
    ("9223372036854775807", True), ("-9223372036854775808", True), ("9223372036854775808", False),
    ("99999999999999999999", False), (None, False),
]


def test_integral_text(frame):
    df = frame([(t,) for t, _ in INTEGRAL_CASES], "v string")
    got = [r[0] for r in df.selectExpr(f"coalesce({is_integral_text('v')}, false)").collect()]
    assert got == [want for _, want in INTEGRAL_CASES]


def test_numeric_text_never_raises(frame):
    df = frame([("0",), ("0.00",), ("-3.5",), ("abc",), ("7",), (None,)], "v string")
    zero = df.selectExpr(f"count_if({is_zero('v')})").first()[0]
    nonpos = df.selectExpr(f"count_if({is_non_positive('v')})").first()[0]
    assert (zero, nonpos) == (2, 3)


@pytest.mark.parametrize("name", ["plain", "with space", "a.b", "x-y", "back`tick"])
def test_quote_round_trips(frame, name):
    df = frame([(1,)], f"{quote(name)} int")
    assert df.columns == [name]
    assert df.selectExpr(quote(name)).first()[0] == 1

"""Scalar functions: each accepted value has a refused twin."""

import hashlib
import hmac
import random
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyproof.functions import money as M
from tallyproof.functions import privacy as P
from tallyproof.functions import text as X
from tallyproof.functions import timestamps as T


def one(spark, column, *values):
    rows = spark.createDataFrame([(v,) for v in values], "v string").select(column(F.col("v")).alias("r")).collect()
    return [r[0] for r in rows]


def test_overpunch(spark):
    assert one(spark, M.overpunch_decode, "00000001234E", "00000001234M", "00000000000}", "0000000123", "12A4{", "", None) == [Decimal("123.45"), Decimal("-123.44"), Decimal("0.00"), None, None, None, None]


def test_overpunch_goes_round(spark):
    cents = [0, 1, -1, 99, -12345, 10**12, -(10**14), *[random.Random(3).randint(-(10**10), 10**10) for _ in range(50)]]
    df = spark.createDataFrame([(Decimal(c) / 100,) for c in cents], "a decimal(18,2)")
    got = df.select("a", M.overpunch_decode(M.overpunch_encode(F.col("a"), 17)).alias("b")).collect()
    assert all(r.a == r.b for r in got)
    assert df.select(M.overpunch_encode(F.col("a"), 3).alias("x")).collect()[6].x is None


def test_money_grammars(spark):
    assert one(spark, M.brl_money, "        1.621,00", "1621,00", "-12,30", "1.62,00", "1,5", "") == [Decimal("1621.00"), None, Decimal("-12.30"), None, None, None]
    assert one(spark, lambda c: M.locale_decimal(c, 3, 9), "1,235", "01,235", "1,23", "1.235") == [Decimal("1.235"), None, None, None]
    assert one(spark, M.implied_decimal, "00012345", "12a", "") == [Decimal("123.45"), None, None]


def test_rounding_modes(spark):
    df = spark.range(1)
    for amount, percent, want in (("1.00", "0.500", "0.01"), ("2.50", "1.000", "0.03"), ("67.00", "1.500", "1.01")):
        got = df.select(M.half_up(F.lit(amount).cast("decimal(18,2)"), F.lit(percent).cast("decimal(9,3)"))).first()[0]
        assert got == Decimal(want)
    assert df.select(M.half_even(F.lit("1.005").cast("decimal(18,3)"))).first()[0] == Decimal("1.00")
    assert df.select(M.two_places(F.lit("1.005").cast("decimal(18,3)"))).first()[0] is None


def test_canonical(spark):
    assert one(spark, lambda c: M.canonical(c, True), "10.00", "-0.00", " 7.10 ", None, "100") == ["10", "0", "7.1", "", "100"]


@pytest.mark.parametrize("key", [b"k", b"x" * 64, b"y" * 200])
def test_hmac(spark, key):
    got = one(spark, lambda c: P.hmac_sha256(c, key), "4111111111111111", "", "é")
    assert got == [hmac.new(key, v.encode(), hashlib.sha256).hexdigest() for v in ("4111111111111111", "", "é")]
    with pytest.raises(ValueError):
        P.hmac_sha256(F.lit("x"), b"")


def test_documents(spark):
    assert one(spark, P.valid_cpf, "12345678909", "12345678900", "11111111111", "1234567890") == [True, False, False, False]
    assert one(spark, lambda c: P.valid_cpf(c, False), "11111111111") == [True]
    assert one(spark, P.valid_cnpj, "12345678000195", "12345678000194", "98765432000198") == [True, False, True]


def test_safe_text(spark):
    assert one(spark, P.safe_text, "Invoice 1001", "=1+1", "card 4111111111111111", "a‮b", "", "x" * 81) == [True, False, False, False, False, False]


def test_lexers(spark):
    assert one(spark, X.escaped_fields, r"D|a\|b|c\\|", r"a\x|b") == [["D", "a|b", "c\\", ""], None]
    got = one(spark, X.quoted_fields, 'A;"Tarifa ""VIP""; x";1', 'A;"open;1', 'A;b"c;1')
    assert [tuple(f) for f in got[0]] == [("A", False), ('Tarifa "VIP"; x', True), ("1", False)]
    assert got[1:] == [None, None]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab|\;é ", max_size=6), min_size=1, max_size=5))
def test_escaping_goes_round(spark, fields):
    line = "|".join(f.replace("\\", "\\\\").replace("|", "\\|") for f in fields)
    assert one(spark, X.escaped_fields, line) == [fields]


def test_times(spark):
    df = spark.createDataFrame([("20260723", "091530"), ("20260230", "091530"), ("2026072", "091530")], "d string, t string")
    assert [r[0] for r in df.select(T.local_iso(F.col("d"), F.col("t"))).collect()] == ["2026-07-23T09:15:30-03:00", None, None]
    assert [x is None for x in one(spark, T.strict_offset, "2026-07-23T09:00:00-03:00", "2026-07-23T09:00:00Z", "2026-07-23T09:00:00+00:00", "2026-02-30T09:00:00Z")] == [False, False, True, True]
    assert [x is None for x in one(spark, T.strict_date, "29/02/2000", "29/02/2001", "1/02/2000")] == [False, True, True]


def test_keyword_score(spark):
    assert one(spark, lambda c: X.keyword_score(c, "net total"), "The Net Total", "total net", "none") == [14, 6, 0]

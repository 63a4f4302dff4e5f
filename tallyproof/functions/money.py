"""Exact-decimal money: Column -> Column, no floats, refusal (null) instead of repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the overpunch code: the last digit and the sign in one character.
POSITIVE, NEGATIVE = "{ABCDEFGHI", "}JKLMNOPQR"
DIGITS = "0123456789"


def money(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(18,2)")


def overpunch_decode(raw: Column, scale: int = 2) -> Column:
    """Signed zoned decimal with implied places; null if it isn't one."""
    last = F.substring(raw, -1, 1)
    digits = F.concat(raw.substr(F.lit(1), F.length(raw) - 1), F.translate(last, POSITIVE + NEGATIVE, DIGITS * 2))
    value = (F.when(raw.rlike(r"^[0-9]{0,17}[{}A-R]\z"), digits).try_cast("decimal(18,0)") * F.lit(f"{10**-scale:.{scale}f}").cast(f"decimal({scale + 1},{scale})")).cast("decimal(18,2)")
    return F.when(last.isin(*NEGATIVE), -value).otherwise(value).cast("decimal(18,2)")


def overpunch_encode(amount: Column, width: int, scale: int = 2) -> Column:
    """The inverse: ``width`` characters, the last of which holds the sign; null if the amount does not fit."""
    minor = F.abs(amount.cast("decimal(18,2)") * F.lit(10**scale)).cast("decimal(20,0)").cast("string")
    padded = F.lpad(minor, width, "0")
    last = F.substring(padded, -1, 1)
    sign = F.when(amount < 0, F.translate(last, DIGITS, NEGATIVE)).otherwise(F.translate(last, DIGITS, POSITIVE))
    return F.when(F.length(minor) <= width, F.concat(padded.substr(F.lit(1), F.length(padded) - 1), sign))


def brl_money(raw: Column, precision: int = 18, scale: int = 2) -> Column:
    """``1.621,00`` as a decimal, null where the grammar is not met."""
    text = F.trim(raw)
    plain = F.translate(F.translate(text, ".", ""), ",", ".")
    return F.when(text.rlike(rf"^-?\d{{1,3}}(\.\d{{3}})*,\d{{{scale}}}\z"), plain).try_cast(f"decimal({precision},{scale})")


def locale_decimal(raw: Column, places: int, precision: int = 18) -> Column:
    """``12,34`` with exactly ``places`` places, no grouping."""
    return F.when(raw.rlike(rf"^(0|[1-9][0-9]*),[0-9]{{{places}}}\z"), F.translate(raw, ",", ".")).try_cast(f"decimal({precision},{places})")


def implied_decimal(digits: Column) -> Column:
    """Digits with two implied places."""
    return F.when(digits.rlike(r"^[0-9]+\z"), digits.try_cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")


def signed_implied(sign: Column, digits: Column) -> Column:
    """A sign and digits with two implied places; minus zero is not a number."""
    value = implied_decimal(digits)
    return F.when(sign == "+", value).when((sign == "-") & (value != 0), (-value).cast("decimal(18,2)"))


def signed_by(direction: Column, amount: Column, credit: str = "C") -> Column:
    return F.when(direction == credit, amount).otherwise(-amount).cast("decimal(18,2)")


def half_up(amount: Column, rate_percent: Column) -> Column:
    """amount * rate / 100 rounded once, halves away from zero."""
    return F.round(amount.cast("decimal(18,2)") * rate_percent.cast("decimal(9,3)") * F.lit("0.01").cast("decimal(3,2)"), 2).cast("decimal(18,2)")


def half_even(total: Column, places: int = 2) -> Column:
    return F.bround(total, places).cast(f"decimal(38,{places})")


def two_places(value: Column) -> Column:
    """Text with exactly two places; null where the value would have to be rounded."""
    exact = value.cast("decimal(30,2)")
    return F.when(exact == value, exact.cast("string"))


def canonical(value: Column, is_money: bool = False) -> Column:
    """Text for comparison: null is empty, text is trimmed, money loses trailing zeros."""
    text = F.trim(F.coalesce(value.cast("string"), F.lit("")))
    if not is_money:
        return text
    short = F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)
    return F.when(short.isin("-0", ""), F.when(text == "", "").otherwise("0")).otherwise(short)


def at_scale(value: Column, reference: Column) -> Column:
    """The amount as text with as many places as the reference text has, ties to even."""
    places = F.when(F.instr(reference, ".") > 0, F.length(F.substring_index(reference, ".", -1))).otherwise(0)
    exact = value.cast("decimal(28,10)")
    by_places = [F.when(places == n, F.bround(exact, n).cast(f"decimal(28,{n})").cast("string")) for n in range(11)]
    return F.coalesce(*by_places)

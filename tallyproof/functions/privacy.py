"""Masks, keyed tokens, tax-document check digits and scans for clear identifiers, all as columns."""

from __future__ import annotations

import hashlib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType


def hmac_sha256(value: Column, key: bytes) -> Column:
    """Hex HMAC-SHA256 by two nested digests; keys over a block are hashed first, none is refused."""
    if not key:
        raise ValueError("a tokenization key is needed")
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    pad = lambda x: F.unhex(F.lit(bytes(b ^ x for b in block).hex()))
    inner = F.sha2(F.concat(pad(0x36), F.encode(value, "UTF-8")), 256)
    return F.sha2(F.concat(pad(0x5C), F.unhex(inner)), 256)


def token(value: Column, key: bytes, prefix: str = "tok_") -> Column:
    return F.concat(F.lit(prefix), F.substring(hmac_sha256(value, key), 1, 24))


def mask_last4(value: Column, stars: int) -> Column:
    """Stars and the last four characters: 7 stars for a person's document, 10 for a company's."""
    return F.concat(F.lit("*" * stars), F.substring(value, -4, 4))


def composite_key(*parts: Column) -> Column:
    return F.concat_ws(":", *parts)


def _check_digit(digits: Column, weights: list[int]) -> Column:
    total = F.lit(0)
    for i, w in enumerate(weights):
        total = total + digits.substr(i + 1, 1).cast("int") * w
    rest = total % 11
    return F.when(rest < 2, 0).otherwise(11 - rest)


def valid_cpf(value: Column, refuse_repeated: bool = True) -> Column:
    """Eleven digits whose last two check the rest."""
    shape = value.rlike(r"^[0-9]{11}\z")
    ok = (_check_digit(value, list(range(10, 1, -1))) == value.substr(10, 1).cast("int")) & (_check_digit(value, list(range(11, 1, -1))) == value.substr(11, 1).cast("int"))
    if refuse_repeated:
        ok = ok & ~value.rlike(r"^(\d)\1{10}$")
    return F.when(shape, ok).otherwise(False)


def valid_cnpj(value: Column, refuse_repeated: bool = True) -> Column:
    """Fourteen digits whose last two check the rest."""
    shape, weights = value.rlike(r"^[0-9]{14}\z"), [5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2]
    ok = (_check_digit(value, weights) == value.substr(13, 1).cast("int")) & (_check_digit(value, [6, *weights]) == value.substr(14, 1).cast("int"))
    if refuse_repeated:
        ok = ok & ~value.rlike(r"^(\d)\1{13}$")
    return F.when(shape, ok).otherwise(False)


def tagged_tax_id(value: Column) -> Column:
    """(kind, document) of a 14-character field in which a person's document is led by 000."""
    person = value.startswith("000") & valid_cpf(F.substring(value, 4, 11))
    return F.struct(F.when(person, "CPF").when(valid_cnpj(value), "CNPJ").alias("kind"), F.when(person, F.substring(value, 4, 11)).otherwise(value).alias("document"))


def clear_digits(text: Column, n: int) -> Column:
    """Whether a run of exactly ``n`` digits stands in the text."""
    return text.rlike(rf"(?<!\d)\d{{{n}}}(?!\d)")


def safe_text(text: Column, most: int = 80) -> Column:
    """1 to ``most`` characters, no control or bidirectional marks, no formula start, no run of 11 to 19 digits."""
    return (
        F.length(text).between(1, most)
        & ~text.rlike("[\\u0000-\\u001F\\u007F-\\u009F\\u061C\\u200E\\u200F\\u202A-\\u202E\\u2066-\\u2069]")
        & ~text.rlike(r"^[=+\-@]")
        & ~text.rlike(r"(?<!\d)\d{11,19}(?!\d)")
    )


@F.pandas_udf(BooleanType())
def composed(text: pd.Series) -> pd.Series:
    """Whether text is in normal form C; Spark has no function for it, so Arrow batches are asked."""
    return text.map(lambda v: None if v is None else unicodedata.is_normalized("NFC", v))

"""Small text helpers that return Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchpath.config import WHITE_SPACE


def trim_field(value: Column) -> Column:
    """Strip all Unicode white space, not only spaces."""
    return F.btrim(value, F.lit(WHITE_SPACE))


def is_blank(value: Column, ignore_case: bool = False) -> Column:
    """Empty, NULL or the word ``null``. Jobs differ in whether ``NULL`` counts as well."""
    value = F.coalesce(value, F.lit(""))
    if ignore_case:
        value = F.lower(value)
    return value.isin("", "null")


def to_long(value: Column) -> Column:
    return value.try_cast("bigint")


def sign(value: Column) -> Column:
    """Signature of a value: Base64 of its MD5 hex digest."""
    return F.base64(F.md5(value).cast("binary"))


def sign_matches(value: Column, signature: Column) -> Column:
    return sign(value) == signature


def encode_base64(value: Column) -> Column:
    """Base64 on one line (Spark breaks lines every 76 characters)."""
    return F.translate(F.base64(value.cast("binary")), "\r\n", "")


def decode_base64(value: Column) -> Column:
    return F.unbase64(value).cast("string")

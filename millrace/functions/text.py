"""Text built from, or read out of, record keys and values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for an absent key and an absent value.
NO_KEY = "<no-key>"
NO_VALUE = "<no-val>"


def utf8(payload: Column | str) -> Column:
    """Bytes as text, each malformed sequence replaced by the replacement character."""
    payload = F.col(payload) if isinstance(payload, str) else payload
    return F.make_valid_utf8(payload.cast("string"))


def key_text(key: Column | str) -> Column:
    return F.coalesce(utf8(key), F.lit(NO_KEY))


def value_text(value: Column | str) -> Column:
    return F.coalesce(utf8(value), F.lit(NO_VALUE))


def zero_padded(number: Column | str, width: int) -> Column:
    """A number as ``%0<width>d`` prints it: longer numbers keep their digits, a sign counts as one.

    Padding is much cheaper than formatting, which is left for the numbers padding gets wrong.
    """
    number = F.col(number) if isinstance(number, str) else number
    formatted = F.format_string(f"%0{width}d", number)
    padded = F.lpad(number.cast("string"), width, "0")
    # No bigint has more than 19 digits.
    unpaddable = (number < 0) | (number >= 10**width) if width < 19 else number < 0
    return F.when(unpaddable, formatted).otherwise(padded)


def user_name(user_id: Column | str) -> Column:
    """``user-name-`` and the id padded to nine digits."""
    return F.concat(F.lit("user-name-"), zero_padded(user_id, 9))


def id_json(record_id: Column | str) -> Column:
    """``{"id": 7}``, with the space that the consumers of these messages expect."""
    return F.concat(F.lit('{"id": '), message_body(record_id), F.lit("}"))


def message_body(record_id: Column | str) -> Column:
    record_id = F.col(record_id) if isinstance(record_id, str) else record_id
    return record_id.cast("string")


def from_json_text(payload: Column | str, schema: str) -> Column:
    """A struct of the given DDL schema; malformed text and missing fields give null fields."""
    payload = F.col(payload) if isinstance(payload, str) else payload
    return F.from_json(payload.cast("string"), schema)

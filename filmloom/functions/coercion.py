"""Text to typed values; anything that does not parse becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters a full strip removes, beyond the plain space of ``trim``.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0         　"

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def coerce_numeric(text: Column) -> Column:
    """Number or null. The pattern keeps out Java-only spellings such as ``1d``."""
    bare = strip(text.cast("string"))
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def coerce_id(text: Column) -> Column:
    """Whole-number key or null: ``1.0`` is 1, ``1997-08-20`` is null.

    Whole text is cast directly so that keys beyond 2**53 keep every digit.
    """
    whole = strip(text.cast("string")).try_cast("bigint")
    return F.coalesce(whole, coerce_numeric(text).try_cast("bigint"))


def zero_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(0))


def range_to_null(value: Column, low: float, high: float) -> Column:
    return F.when(value.between(low, high), value)


def text_to_boolean(text: Column) -> Column:
    word = F.lower(strip(text.cast("string")))
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))


def clean_text(text: Column, max_chars: int | None = None) -> Column:
    bare = strip(text)
    return F.substring(bare, 1, max_chars) if max_chars else bare


def parse_release(text: Column) -> Column:
    bare = strip(text)
    return F.when(bare.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), bare.try_cast("date"))


def epoch_to_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(coerce_numeric(seconds))


def imdb_number(text: Column) -> Column:
    """``tt0114709`` -> 114709: leading ``t`` and ``0`` characters are dropped."""
    return coerce_id(F.regexp_replace(text, "^[t0]+", ""))


def digits_to_id(text: Column) -> Column:
    """Digits of a text as a key, -1 when there are none."""
    digits = F.regexp_replace(text, r"[^0-9]", "")
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("bigint"), F.lit(-1).cast("bigint"))

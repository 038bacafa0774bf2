"""Lists of objects stored as JSON or Python-literal text."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _to_json(text: str | None) -> str | None:
    if text is None:
        return None
    try:
        value = json.loads(text)
    except ValueError:
        try:
            value = ast.literal_eval(text)
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            return "[]"
    if not isinstance(value, list):
        return "[]"
    return json.dumps([item for item in value if isinstance(item, dict)], default=str)


@F.pandas_udf(T.StringType())
def _literal_as_json(texts: pd.Series) -> pd.Series:
    return texts.map(_to_json)


def parse_literal_list(text: Column, schema: T.ArrayType) -> Column:
    """Array of objects; empty for null, blank, garbage or a single object.

    The JVM JSON reader handles JSON and single-quoted text. Only rows it
    cannot read, and rows with backslash escapes that it would garble, carry
    their text to the Python fallback.
    """
    bare = F.trim(text)
    empty = text.isNull() | bare.isin("", "[]", "{}") | bare.startswith("{")
    readable = bare
    for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):
        readable = F.regexp_replace(readable, rf"(['\"])\s*:\s*{word}(?=\s*[,}}])", f"$1: {json_word}")
    native = F.from_json(F.when(~empty & ~bare.contains("\\"), readable), schema)
    fallback = F.from_json(_literal_as_json(F.when(~empty & native.isNull(), bare)), schema)
    parsed = F.coalesce(native, fallback, F.from_json(F.lit("[]"), schema))
    return F.filter(parsed, lambda item: item.isNotNull())


def extract_names(items: Column, key: str = "name") -> Column:
    """Values of ``key`` over the objects that have it."""
    return F.transform(F.filter(items, lambda item: item[key].isNotNull()), lambda item: item[key])


def extract_first(items: Column, key: str = "name") -> Column:
    return F.try_element_at(extract_names(items, key), F.lit(1))

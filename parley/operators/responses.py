"""Structured content of model responses: envelopes judged by kind, JSON objects found in fenced or chatty text."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: A string with its escapes, one left open at the end, or a bracket; nothing else moves the scan.
_MARK = re.compile(r'"(?:[^"\\]|\\.)*+(?:"|\Z)|[{}\[\]]', re.S)
_OPEN = {"}": "{", "]": "["}


def balanced(text: str, begin: int) -> int:
    """The end of the object or array that opens at ``begin``, or -1: brackets in strings don't count, and the others must pair."""
    open_: list[str] = []
    for m in _MARK.finditer(text, begin):
        mark = m[0]
        if mark in "{[":
            open_.append(mark)
        elif mark in "}]":
            if open_.pop() != _OPEN[mark]:
                return -1
            if not open_:
                return m.end()
    return -1


def first_object(text: str | None) -> str | None:
    """The first JSON object in a text, whatever stands around it, such as fences or words.

    A stretch that is balanced but no JSON is passed over from its next brace on.
    """
    if text is None:
        return None
    at = text.find("{")
    while at >= 0:
        end = balanced(text, at)
        if end > 0:
            try:
                if isinstance(json.loads(text[at:end], parse_constant=_refused), dict):
                    return text[at:end]
            except ValueError:
                pass
        at = text.find("{", at + 1)
    return None


def _refused(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


@F.pandas_udf(StringType())
def object_text(text: pd.Series) -> pd.Series:
    """:func:`first_object` of each text."""
    return text.map(first_object)


def _kind(v: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0), F.lit(""))


def _at(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _usage(v: Column, name: str) -> tuple[Column, Column]:
    """A count, 0 where it is missing, and whether it is a whole number of at least 0."""
    x = _at(v, f"$.usage.{name}")
    missing = x.isNull() | (_kind(x) == "VOID")
    return F.when(missing, 0).otherwise(_at(x, "$", "bigint")), missing | (_kind(x) == "BIGINT") & (_at(x, "$", "bigint") >= 0)


def unwrapped(responses: DataFrame, keys: list[str], text: str = "response") -> DataFrame:
    """keys, content (the JSON text of the answer's object), in_tokens, out_tokens, total_tokens, cost_usd and error.

    An answer is the one choice's message, which ended of itself and refuses nothing; its content
    is an object, a text, or a list of one text part. A text may hold its object in fences or
    between words. Errors are, in this order: response, choices, choice, truncated, filtered,
    incomplete, message, refused, missing (no text), not_json, usage. Where there is one, the other
    columns are null. Null and empty responses are ``response``.
    """
    rows = responses.select(*keys, F.try_parse_json(F.col(text).cast("string")).alias("v"))
    v = F.col("v")
    choices, choice, message = _at(v, "$.choices"), _at(v, "$.choices[0]"), _at(v, "$.choices[0].message")
    finish = _at(v, "$.choices[0].finish_reason")
    stop = F.when(_kind(finish).isin("", "VOID"), "stop").when(_kind(finish) == "STRING", _at(finish, "$", "string")).otherwise("")
    refusal = _at(message, "$.refusal")
    refused = ~_kind(refusal).isin("", "VOID") & ~F.to_json(refusal).isin("null", "false", '""', "0", "[]", "{}")
    content = _at(message, "$.content")
    part = _at(content, "$[0]")
    single = (_kind(content) == "ARRAY") & (F.size(_at(content, "$", "array<variant>")) == 1) & (_kind(part) == "OBJECT") & _at(part, "$.type", "string").isin("text", "output_text")
    words = F.when(_kind(content) == "STRING", _at(content, "$", "string")).when(single & (_kind(_at(part, "$.text")) == "STRING"), _at(part, "$.text", "string"))
    counts = {out: _usage(v, name) for out, name in (("in_tokens", "prompt_tokens"), ("out_tokens", "completion_tokens"), ("total_tokens", "total_tokens"))}
    cost = _at(v, "$.usage.cost")
    free = _kind(cost).isin("", "VOID")
    price = F.when(free, 0.0).otherwise(_at(cost, "$", "double"))
    usage_kind = _kind(_at(v, "$.usage"))
    usage_ok = usage_kind.isin("", "VOID", "OBJECT") & counts["in_tokens"][1] & counts["out_tokens"][1] & counts["total_tokens"][1] & (free | _kind(cost).isin("BIGINT", "DECIMAL", "DOUBLE") & (price >= 0))
    envelope = (
        F.when(_kind(v) != "OBJECT", "response")
        .when((_kind(choices) != "ARRAY") | (F.size(_at(choices, "$", "array<variant>")) != 1), "choices")
        .when(_kind(choice) != "OBJECT", "choice")
        .when(stop == "length", "truncated")
        .when(stop == "content_filter", "filtered")
        .when(stop != "stop", "incomplete")
        .when(_kind(message) != "OBJECT", "message")
        .when(refused, "refused")
        .when((_kind(content) != "OBJECT") & words.isNull(), "missing")
    )
    told = rows.select(*keys, envelope.alias("first"), F.when(_kind(content) == "OBJECT", F.to_json(content)).alias("own"), words.alias("words"), usage_ok.alias("usage_ok"), *(c[0].alias(n) for n, c in counts.items()), price.alias("cost_usd"))
    found = told.withColumn("object", F.coalesce("own", object_text("words")))
    error = F.coalesce("first", F.when(F.col("object").isNull(), "not_json").when(~F.coalesce("usage_ok", F.lit(False)), "usage"))
    sound = lambda c: F.when(F.col("error").isNull(), F.col(c)).alias(c)
    return found.withColumn("error", error).select(*keys, F.when(F.col("error").isNull(), F.col("object")).alias("content"), *(sound(c) for c in (*counts, "cost_usd")), "error")

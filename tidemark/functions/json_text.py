"""Operations on JSON documents held as text."""

from __future__ import annotations

import json
import math
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A member whose text contains one of these is dropped.
URL_SCHEMES = ("http://", "https://")


_TOKEN = re.compile(
    r'[ \t\n\r]*(?:([{}\[\],:])|("(?:[^"\\\x00-\x1f]|\\["\\/bfnrt]|\\u[0-9a-fA-F]{4})*")|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null))'
)
_BLANK = re.compile(r"[ \t\n\r]*\Z")


def _text_of(token: str) -> tuple[str, bool]:
    """A JSON string written plainly, and whether it holds a link; escapes that have no character stay escapes."""
    value = json.loads(token)
    link = any(scheme in value for scheme in URL_SCHEMES)
    plain = json.dumps(value, ensure_ascii=False)
    return (json.dumps(value) if any("\ud800" <= c <= "\udfff" for c in plain) else plain), link


def _number(token: str) -> str:
    """A number in its shortest form; one that no double can hold stays as written."""
    if not any(c in token for c in ".eE"):
        return token
    value = float(token)
    return json.dumps(value) if math.isfinite(value) else token


class _Open:
    """An object or array that is being read: its text so far, and what may come next."""

    def __init__(self, bracket: str) -> None:
        self.bracket, self.parts, self.members, self.key = bracket, [], 0, ""
        self.wants = "key" if bracket == "{" else "value"


def _rewritten(text: str) -> str | None:
    """``text`` pruned token by token; None when it is not JSON.  Nesting has no limit."""
    stack: list[_Open] = []
    result, at = None, 0
    while True:
        token = _TOKEN.match(text, at)
        if token is None:
            return result if result is not None and _BLANK.match(text, at) else None
        at = token.end()
        if result is not None:
            return None
        mark, string, value = token[1], token[2], token[3]
        top = stack[-1] if stack else None
        wants = top.wants if top else "value"
        noise = False
        if mark in ("{", "["):
            if wants != "value":
                return None
            stack.append(_Open(mark))
            continue
        if mark in ("}", "]"):
            fits = top is not None and mark == {"{": "}", "[": "]"}[top.bracket]
            first = top is not None and top.members == 0 and wants in ("key", "value")
            if not fits or not (wants == "comma" or first):
                return None
            stack.pop()
            value, noise = top.bracket + ",".join(top.parts) + mark, top.members == 0
        elif mark == ":":
            if wants != "colon":
                return None
            top.wants = "value"
            continue
        elif mark == ",":
            if wants != "comma":
                return None
            top.wants = "key" if top.bracket == "{" else "value"
            continue
        elif string is not None:
            string, noise = _text_of(string)
            if wants == "key":
                top.key, top.wants = string, "colon"
                continue
            if wants != "value":
                return None
            value = string
        elif wants != "value":
            return None
        elif value[0] in "-0123456789":
            value = _number(value)
        top = stack[-1] if stack else None
        if top is None:
            result = value
            continue
        top.members += 1
        top.wants = "comma"
        if top.bracket == "[":
            top.parts.append(value)
        elif not noise:
            top.parts.append(f"{top.key}:{value}")


def prune_text(text: str | None) -> str | None:
    """Drop URL-valued and empty object members at every depth.

    Only object members are dropped, never list elements, and emptiness is
    judged before the children are pruned, so an object that loses all its
    members stays as ``{}``.  Equal keys all stay.  Text
    that is not JSON gives NULL.
    """
    return None if text is None else _rewritten(text)


@F.pandas_udf(T.StringType())
def _prune_batch(texts: pd.Series) -> pd.Series:
    return texts.map(prune_text, na_action="ignore")


def prune_json(text: Column) -> Column:
    """Arrow-batched :func:`prune_text`.

    A fixed ``from_json`` schema cannot tell a pruned member from an explicit
    null, and payload depth has no bound, so this one step runs in Python.
    """
    return _prune_batch(text)


def payload_as_text(line: Column) -> Column:
    """Record with its ``payload`` object replaced by that object's JSON text.

    The other members keep their types; NULL when the line is not a JSON object.
    """
    members = F.try_parse_json(line).try_cast("map<string,variant>")
    swapped = F.transform_values(
        members, lambda key, value: F.when(key == "payload", F.to_json(value).cast("variant")).otherwise(value)
    )
    return F.to_json(F.to_variant_object(swapped))

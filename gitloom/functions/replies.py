"""Recover values from model replies that may be fenced, cut short or malformed."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from gitloom.functions.text import let, rstrip, strip

# --- fixed values ---
FENCE_OPEN = r"\A```(?:json)?\s*\n?"
FENCE_CLOSE = r"\n?```\s*\z"
ERROR_PREVIEW = 200
# --- end of fixed values ---


def _json_string(text: Column, key: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.try_parse_json(text), f"$.{key}", kind)


def unfence(reply: Column) -> Column:
    text = F.regexp_replace(strip(reply), FENCE_OPEN, "")
    return strip(F.regexp_replace(text, FENCE_CLOSE, ""))


def close_json(text: Column) -> Column:
    """Close an open string and the object of a reply that stops early."""

    def close(body: Column) -> Column:
        ends = F.concat(body, F.when(_open_string(body), '"').otherwise(""), F.lit("}"))
        return F.when(F.endswith(body, F.lit("}")), body).otherwise(ends)

    return let(rstrip(text), close)


def _open_string(body: Column) -> Column:
    """An odd number of quotes, those after a backslash left out."""
    odd = lambda bare: (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))) % 2 == 1
    return let(F.regexp_replace(body, r"(?s)\\.", ""), odd)


def close_list(text: Column) -> Column:
    """Close an open string, the list and the object of a reply that stops early.

    A comma that nothing follows is left out.
    """

    def close(body: Column) -> Column:
        inside = _open_string(body)
        whole = F.concat(F.regexp_replace(body, r",\z", ""), F.when(F.endswith(body, F.lit("]")), "}").otherwise("]}"))
        return F.when(inside, F.concat(body, F.lit('"]}'))).otherwise(whole)

    return let(rstrip(text), close)


def recover_value(reply: Column, key: str) -> Column:
    """Struct ``value, method, error``: the first of four readings that yields ``key``."""
    # Possessive (``*+``): the same match, but Java walks it without recursion, so a
    # value of any length is safe.
    pattern = '(?s)"' + re.escape(key) + r'"\s*:\s*"((?:[^"\\]|\\.)*+)'
    scanned = F.regexp_extract(reply, pattern, 1)
    for escaped, plain in ((r"\"", '"'), (r"\n", "\n"), ("\\\\", "\\")):
        scanned = F.replace(scanned, F.lit(escaped), F.lit(plain))

    def without_fences(unfenced: Column) -> Column:
        return F.coalesce(
            _found(_json_string(unfenced, key), "fenced"),
            _found(_json_string(close_json(unfenced), key), "repaired"),
        )

    # Each reading is tried only where those before it found nothing.
    readings = [
        _found(_json_string(reply, key), "json"),
        let(unfence(reply), without_fences),
        _found(F.when(reply.rlike(pattern), scanned), "regex"),
    ]
    nothing = F.struct(
        F.lit(None).cast("string").alias("value"),
        F.lit(None).cast("string").alias("method"),
        F.concat(
            F.lit(f"no value for '{key}' in reply: "),
            F.left(F.coalesce(reply, F.lit("")), F.lit(ERROR_PREVIEW)),
        ).alias("error"),
    )
    return F.coalesce(*readings, nothing)


def _found(value: Column, method: str) -> Column:
    """The result struct of one reading, null when it yields nothing."""

    def wrap(v: Column) -> Column:
        return F.when(
            v.isNotNull(),
            F.struct(
                v.alias("value"),
                F.lit(method).alias("method"),
                F.lit(None).cast("string").alias("error"),
            ),
        )

    return let(value, wrap)


def read_reply(reply: Column, key: str) -> Column:
    """As :func:`recover_value`, on the stripped reply; an empty reply is an error."""
    empty = F.struct(
        F.lit(None).cast("string").alias("value"),
        F.lit(None).cast("string").alias("method"),
        F.lit("empty reply").alias("error"),
    )

    def read(text: Column) -> Column:
        return F.when(text == "", empty).otherwise(recover_value(text, key))

    return let(strip(F.coalesce(reply, F.lit(""))), read)


def read_typed(reply: Column, key: str, kind: str) -> Column:
    """Struct ``value, error`` for structured output such as ``array<string>``.

    A reply in fences is read without them, one that stops early with its ends added.
    """

    def without_fences(unfenced: Column) -> Column:
        return F.coalesce(
            _json_string(unfenced, key, kind), _json_string(close_list(unfenced), key, kind)
        )

    problem = F.concat(
        F.lit(f"no {kind} under '{key}' in reply: "),
        F.left(F.coalesce(reply, F.lit("")), F.lit(ERROR_PREVIEW)),
    )
    value = F.coalesce(_json_string(reply, key, kind), let(unfence(reply), without_fences))
    return let(
        value, lambda v: F.struct(v.alias("value"), F.when(v.isNull(), problem).alias("error"))
    )

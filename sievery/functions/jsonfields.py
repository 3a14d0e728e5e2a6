"""Top-level JSON array fields of raw messages (J-1..J-3) and mentions (X-3).

A field counts as present only when it sits at the top level of the message
and is an array; an empty array is present, a nested field or text that does
not parse is absent.  The text is parsed once into a VARIANT and every field
is read from that value, all inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the user-mention token of the chat wire format,
# ``<@U123>`` or ``<@U123|name>``; group 1 is the user id.  Extracting
# mentions from the text is our rule (X-3): the original took them from a
# library that is not available.
MENTION_PATTERN = r"<@([UW][A-Z0-9]+)(?:\|[^>]*)?>"


def parse(raw: Column) -> Column:
    """Parse JSON text to a VARIANT; NULL when the text is not JSON."""
    return F.try_parse_json(raw)


def whole_json_sql(raw: str = "raw") -> str:
    """SQL: the whole text is one JSON value.  ``try_parse_json`` stops behind the
    first value, so the text is read as one member of an object between two names
    that it cannot hold, as they come from its own hash; text behind the value
    breaks the object or adds members."""
    name = f"md5({raw})"
    return (f"coalesce(size(try_variant_get(try_parse_json(concat('{{\"a', {name}, '\":', {raw}, "
            f"',\"b', {name}, '\":0}}')), '$', 'map<string,variant>')) = 2, false)")


def array_field(parsed: Column, name: str) -> Column:
    """The top-level field ``name`` if it is an array, else NULL."""
    return F.try_variant_get(parsed, f"$.{name}", "array<variant>")


def reactions_field(parsed: Column) -> Column:
    """J-1."""
    return array_field(parsed, "reactions")


def replies_field(parsed: Column) -> Column:
    """J-2."""
    return array_field(parsed, "replies")


def mentions_field(parsed: Column) -> Column:
    """J-3."""
    return array_field(parsed, "mentions")


def nonempty(arr: Column) -> Column:
    """True for an array with elements; NULL and empty give False."""
    return F.coalesce(F.size(arr) > 0, F.lit(False))


def extract_mentions(text: Column) -> Column:
    """X-3: user ids of the mention tokens in ``text``, in text order."""
    return F.regexp_extract_all(text, F.lit(MENTION_PATTERN), 1)

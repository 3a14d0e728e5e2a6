"""JSON encoders of messages and listings (E-1..E-7) and the URL template (STR-1).

The delivered records mix two null policies in one object: some keys are
always written (``null`` when absent) and others are left out when absent or
empty.  ``to_json`` has one policy per call, so each record is assembled from
per-key fragments instead: a fragment is the text ``"key":<json>``, and
``concat_ws`` skips the fragments a rule leaves out (NULL).  Key order is the
order of the fragments and nested structs keep their field order.

Each fragment is computed once, as its own column, and the per-category
records only concatenate fragment columns.  This keeps the generated code of
the stage small (one ``to_json`` per key and row instead of one per key,
record kind and reference) so the whole projection stays in whole-stage
codegen.  The rules are SQL expressions (one JVM call per step).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import TEMPLATE_PLACEHOLDER
from . import classify as C

_KEEP_NULLS = {"ignoreNullFields": "false"}
_KEEP_NULLS_SQL = "map('ignoreNullFields', 'false')"

# Message keys that are encoded from a typed column.
MESSAGE_KEYS = ["type", "subtype", "text", "ts", "user", "username", "bot_id",
                "file", "comments", "comment", "reactions", "replies", "mentions"]

EMPTY_COMMENTS = "array<struct<id:string,timestamp:bigint,user:string>>"
EMPTY_REACTIONS = "array<struct<name:string,users:array<string>,count:bigint>>"

# Values behind the fragments: empty lists stand in for NULL lists.
MESSAGE_SOURCES = {
    "comments": f"coalesce(`comments`, cast(array() AS {EMPTY_COMMENTS}))",
    "reactions": f"coalesce(`reactions`, cast(array() AS {EMPTY_REACTIONS}))",
    "mentions": "coalesce(`mentions`, cast(array() AS array<string>))",
}


def q(name: str) -> str:
    return f"`{name}`"


def frag(key: str) -> str:
    return f"_f_{key}"


def add_fragments(df: DataFrame, keys: list[str] = MESSAGE_KEYS,
                  source: dict[str, str] | None = None,
                  when: dict[str, str] | None = None) -> DataFrame:
    """Add one ``_f_<key>`` column per key holding ``"key":<json>``
    (``null`` written for a NULL value).  ``source`` maps a key to the SQL
    expression of its value (default: the column of that name); ``when``
    maps a key to the condition under which its fragment is needed (NULL
    elsewhere, and no ``to_json`` is run for that row)."""
    source, when = source or {}, when or {}
    cols = [q(c) for c in df.columns]

    def json_of(k: str) -> str:
        j = f"to_json(named_struct('{k}', {source.get(k, q(k))}), {_KEEP_NULLS_SQL})"
        return f"CASE WHEN {when[k]} THEN {j} END" if k in when else j

    with_json = df.selectExpr(*cols, *[f"{json_of(k)} AS _j_{k}" for k in keys])
    return with_json.selectExpr(*cols, *[
        f"substr(_j_{k}, 2, length(_j_{k}) - 2) AS {frag(k)}" for k in keys])


def drop_fragments(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_f_")])


# --- fragment rules (SQL) ---------------------------------------------------

def always(key: str) -> str:
    """Key always present, ``null`` when the value is NULL."""
    return frag(key)


def if_present(key: str) -> str:
    """Key left out when the value is NULL."""
    return f"CASE WHEN {q(key)} IS NOT NULL THEN {frag(key)} END"


def if_nonempty(key: str) -> str:
    """Key left out when the array is NULL or empty."""
    return f"CASE WHEN size({q(key)}) > 0 THEN {frag(key)} END"


def if_nonempty_text(key: str) -> str:
    return f"CASE WHEN {q(key)} <> '' THEN {frag(key)} END"


def raw_if_present(key: str, raw: str) -> str:
    """Key whose value is already JSON text; left out when NULL."""
    return f"CASE WHEN {q(raw)} IS NOT NULL THEN concat('\"{key}\":', {q(raw)}) END"


def raw_if_nonempty(key: str, raw: str) -> str:
    """Raw JSON array text; left out when NULL or an empty array."""
    return (f"CASE WHEN coalesce(json_array_length({q(raw)}) > 0, false) "
            f"THEN concat('\"{key}\":', {q(raw)}) END")


def json_object_sql(*fragments: str) -> str:
    return "concat('{', concat_ws(',', " + ", ".join(fragments) + "), '}')"


# --- record kinds ------------------------------------------------------------
#
# Each delivered record kind is a list of (key, rule) in key order.  Rules:
# "always" (null written when absent), "present" (left out when NULL),
# "nonempty" (left out when NULL or an empty list), "text" (left out when
# NULL or empty text), "raw" / "raw_nonempty" (value is JSON text already).
# The record SQL and the condition under which each key's fragment is
# computed both come from this table.

RECORDS: dict[str, list[tuple[str, str]]] = {
    # E-1 user file share
    C.FILE_SHARE: [("type", "always"), ("subtype", "always"), ("text", "always"),
                   ("file", "always"), ("comments", "always"), ("ts", "always"),
                   ("comment", "text"), ("user", "always"), ("bot_id", "always"),
                   ("mentions", "nonempty")],
    # E-2 bot attachment message
    C.BOT: [("type", "always"), ("subtype", "always"), ("text", "always"), ("ts", "always"),
            ("bot_id", "present"), ("username", "present"), ("attachments", "raw"),
            ("reactions", "nonempty"), ("replies", "nonempty"), ("mentions", "nonempty")],
    # E-3 user attachment message (no subtype)
    C.USER_ATTACHMENT: [("type", "always"), ("text", "always"), ("ts", "always"),
                        ("user", "present"), ("attachments", "raw_nonempty"),
                        ("reactions", "nonempty"), ("replies", "nonempty"),
                        ("mentions", "nonempty")],
    # E-4 file comment: every field
    C.FILE_COMMENT: [("type", "always"), ("subtype", "always"), ("text", "always"),
                     ("user", "always"), ("comment", "always"), ("mentions", "always"),
                     ("reactions", "always"), ("ts", "always")],
}

_RULE_SQL = {"always": always, "present": if_present, "nonempty": if_nonempty,
             "text": if_nonempty_text}


def _rule_condition(key: str, rule: str) -> str:
    """SQL: the rule writes the key for this row."""
    return {"always": "true", "present": f"{q(key)} IS NOT NULL",
            "nonempty": f"size({q(key)}) > 0", "text": f"{q(key)} <> ''"}[rule]


def record_sql(kind: str) -> str:
    """The JSON object of one record kind, from its fragments."""
    parts = []
    for key, rule in RECORDS[kind]:
        if rule == "raw":
            parts.append(raw_if_present(key, key))
        elif rule == "raw_nonempty":
            parts.append(raw_if_nonempty(key, key))
        else:
            parts.append(_RULE_SQL[rule](key))
    return json_object_sql(*parts)


def fragment_conditions(kinds: list[str] | None = None) -> dict[str, str]:
    """Per typed key: SQL condition under which some record kind writes it
    (the fragment is computed only then)."""
    conds: dict[str, list[str]] = {}
    for kind in kinds or list(RECORDS):
        for key, rule in RECORDS[kind]:
            if rule.startswith("raw"):
                continue
            c = _rule_condition(key, rule)
            kind_c = f"`category` = '{kind}'" if kinds is None else "true"
            conds.setdefault(key, []).append(kind_c if c == "true" else f"({kind_c} AND {c})")
    return {k: " OR ".join(v) for k, v in conds.items()}


def encode_file_share_sql() -> str:
    """E-1: type, subtype, text, file, comments, ts; comment when non-empty;
    user and bot_id always (null when absent); mentions when non-empty."""
    return record_sql(C.FILE_SHARE)


def encode_bot_sql() -> str:
    """E-2: type, subtype, text, ts; bot_id, username, attachments when
    present; reactions, replies, mentions when non-empty."""
    return record_sql(C.BOT)


def encode_user_attachment_sql() -> str:
    """E-3: type, text, ts; user when present; attachments, reactions,
    replies, mentions when non-empty.  No subtype."""
    return record_sql(C.USER_ATTACHMENT)


def encode_file_comment_sql() -> str:
    """E-4: every field, null when absent, ``[]`` for empty lists."""
    return record_sql(C.FILE_COMMENT)


def encode_message_sql() -> str:
    """The delivered JSON of one message, by category; whitelisted messages
    are passed through as their raw text.  Needs ``add_fragments``."""
    whens = " ".join(f"WHEN '{kind}' THEN {record_sql(kind)}" for kind in RECORDS)
    return f"CASE `category` {whens} ELSE `raw` END"


# Column forms (need ``add_fragments`` on the frame).
def encode_file_share() -> Column:
    return F.expr(encode_file_share_sql())


def encode_bot() -> Column:
    return F.expr(encode_bot_sql())


def encode_user_attachment() -> Column:
    return F.expr(encode_user_attachment_sql())


def encode_file_comment() -> Column:
    return F.expr(encode_file_comment_sql())


def encode_message() -> Column:
    return F.expr(encode_message_sql())


def _with_record(df: DataFrame, record: str, name: str, when: dict[str, str]) -> DataFrame:
    cols = [q(c) for c in df.columns]
    keys = [k for k in MESSAGE_KEYS if k in when]
    framed = add_fragments(df, keys, source=MESSAGE_SOURCES, when=when)
    return framed.selectExpr(*cols, f"{record} AS {q(name)}")


def with_message_json(df: DataFrame, name: str = "json") -> DataFrame:
    """Add the delivered JSON text of every message as ``name``.  A key's
    fragment is computed only for rows whose record writes that key."""
    return _with_record(df, encode_message_sql(), name, fragment_conditions())


def with_encoded(df: DataFrame, kind: str, name: str = "json") -> DataFrame:
    """Add the JSON of one fixed record kind (E-1..E-4, by category name),
    whatever the rows' category."""
    return _with_record(df, record_sql(kind), name, fragment_conditions([kind]))


def encode_record(*cols: str | Column) -> Column:
    """E-7: a listing record with all its fields, nulls written."""
    return F.to_json(F.struct(*cols), _KEEP_NULLS)


def json_array(items: Column) -> Column:
    """``[a,b,...]`` from an array of JSON texts (order kept)."""
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def fill_template(template: str | Column, **values: Column) -> Column:
    """STR-1: replace ``<name>`` placeholders literally (no regex, so ``$``
    and ``\\`` in values are safe)."""
    out = F.lit(template) if isinstance(template, str) else template
    for name, value in values.items():
        out = F.replace(out, F.lit(TEMPLATE_PLACEHOLDER.format(name=name)), value)
    return out

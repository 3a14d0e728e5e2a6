"""The notable-message sieve (F-1..F-9).

One predicate over the tall ``messages`` table replaces five typed list
filters: the row's category selects its rule.  Typed categories look at the
typed list columns; whitelisted messages are judged on their raw JSON text.
The predicate is a plain expression, so it runs inside whole-stage codegen
and is applied before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions.jsonfields import whole_json_sql


def _has(col: str) -> str:
    """SQL: the array column has elements (NULL and empty are false)."""
    return f"coalesce(size({col}) > 0, false)"


# The rules as SQL expressions over the canonical columns.
KEEP_BOT = f"({_has('reactions')} OR {_has('mentions')})"
KEEP_USER_ATTACHMENT = KEEP_BOT
KEEP_FILE_SHARE = f"({_has('mentions')} OR {_has('comments')})"
KEEP_FILE_COMMENT = f"({_has('mentions')} OR {_has('reactions')})"


def keep_whitelisted_sql(raw: str = "raw") -> str:
    """F-4 as SQL.  The text is parsed once and its top-level object read
    as a map; the three keys are tested inside one ``map_filter``, so the
    raw text is referenced (and parsed) once per row even where Catalyst
    inlines the expression that produced it.  Same results as J-1..J-3:
    text that is not a JSON object keeps nothing.  Of a repeated key the last
    value counts where the session sets
    ``spark.sql.variant.allowDuplicateKeys`` (``build_session`` does); else
    such a text keeps nothing and is logged as a reject.  A text with more behind
    its object is not JSON as a whole and would spoil the array it is delivered
    in: it keeps nothing either."""
    return ("(coalesce(size(map_filter("
            f"try_variant_get(try_parse_json({raw}), '$', 'map<string,variant>'), "
            "(k, v) -> k IN ('reactions', 'mentions', 'replies') AND "
            "coalesce(size(try_variant_get(v, '$', 'array<variant>')) > 0, false))) > 0, false)"
            f" AND {whole_json_sql(raw)})")


NOTABLE = (f"CASE WHEN category IN ('{C.BOT}', '{C.USER_ATTACHMENT}', '{C.FILE_COMMENT}') "
           f"THEN {KEEP_BOT} "
           f"WHEN category = '{C.FILE_SHARE}' THEN {KEEP_FILE_SHARE} "
           f"WHEN category = '{C.WHITELISTED}' THEN {keep_whitelisted_sql()} "
           "ELSE false END")


def keep_bot() -> Column:
    """F-1: reactions or mentions."""
    return F.expr(KEEP_BOT)


def keep_user_attachment() -> Column:
    """F-2: reactions or mentions."""
    return F.expr(KEEP_USER_ATTACHMENT)


def keep_file_share() -> Column:
    """F-3: mentions or comments (reactions are not looked at)."""
    return F.expr(KEEP_FILE_SHARE)


def keep_whitelisted(raw: str = "raw") -> Column:
    """F-4: a top-level reactions, mentions or replies array with elements."""
    return F.expr(keep_whitelisted_sql(raw))


def keep_file_comment() -> Column:
    """F-5: mentions or reactions."""
    return F.expr(KEEP_FILE_COMMENT)


def is_notable() -> Column:
    """F-6: the rule of the row's category; unknown categories are dropped.
    F-1, F-2 and F-5 share one rule, so each list is referenced once per
    branch kind; this keeps the predicate small when Catalyst pushes it
    below the projections that build the lists."""
    return F.expr(NOTABLE)


def sieve(messages: DataFrame) -> DataFrame:
    """F-6 applied: only notable messages remain (a subset; idempotent)."""
    return messages.filter(is_notable())


def with_notable(messages: DataFrame, name: str = "notable") -> DataFrame:
    return messages.withColumn(name, is_notable())


def unparsable_rejects(messages: DataFrame) -> DataFrame:
    """Whitelisted messages whose raw text cannot be read as JSON (dropped by
    F-4): broken text, text behind the object, or a repeated key where the session
    does not allow it."""
    return (messages.filter((F.col("category") == C.WHITELISTED) & ~F.expr(whole_json_sql()))
            .select(F.lit("whitelisted").alias("source"),
                    F.concat_ws("/", "channel", "ts").alias("key"),
                    F.lit("raw message is not readable JSON").alias("reason")))


def skipped_channels(channels: DataFrame, notable: DataFrame,
                     id_col: str = "id") -> DataFrame:
    """F-7: listed channels with no notable message (nothing to deliver).

    A left-anti join against the distinct channels of the sieved messages;
    the right side is reduced to one row per channel before the shuffle.
    """
    present = notable.select(F.col("channel").alias("_ch")).distinct()
    return channels.join(present, F.col(id_col) == F.col("_ch"), "left_anti")


def nonempty_listing(df: DataFrame) -> DataFrame:
    """F-8 for team records: drop a team with an empty id."""
    return df.filter(F.col("id").isNotNull() & (F.col("id") != ""))

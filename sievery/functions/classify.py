"""Message categories, classification (X-1) and the subtype blacklist (X-2).

The classifier of the original tool lives in a library that is not
available, so the rule below is ours; it reproduces the outcome on every
message kind of the API fixtures (plain bot post, bot post with attachments
and no subtype, user post with attachments, file share, file comment).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The five category names and the two list orders that must
# equal the original's.  Order B is the order of the delivered post payload,
# order A the order of the encoded sieved record.
BOT = "bot"
USER_ATTACHMENT = "user_attachment"
FILE_SHARE = "file_share"
FILE_COMMENT = "file_comment"
WHITELISTED = "whitelisted"

ORDER_B = [BOT, USER_ATTACHMENT, FILE_SHARE, FILE_COMMENT, WHITELISTED]
ORDER_A = [BOT, FILE_SHARE, USER_ATTACHMENT, FILE_COMMENT, WHITELISTED]

CATEGORIES = ORDER_B


def category_rank(category: Column | str, order: list[str] = ORDER_B) -> Column:
    """1-based position of ``category`` in ``order`` (an int column)."""
    col = F.col(category) if isinstance(category, str) else category
    expr = None
    for pos, name in enumerate(order, start=1):
        expr = (F.when(col == name, F.lit(pos)) if expr is None
                else expr.when(col == name, F.lit(pos)))
    return expr.cast("int")


def category_rank_sql(category: str = "category", order: list[str] = ORDER_B) -> str:
    """``category_rank`` as a SQL expression over the column ``category``."""
    whens = " ".join(f"WHEN {category} = '{name}' THEN {pos}" for pos, name in enumerate(order, 1))
    return f"CAST(CASE {whens} END AS INT)"


def classify_sql(subtype: str = "subtype", bot_id: str = "bot_id",
                 attachments: str = "attachments") -> str:
    """X-1 as a SQL expression over the named columns (same rule as
    ``classify``)."""
    return (f"CASE WHEN {subtype} = 'file_share' THEN '{FILE_SHARE}' "
            f"WHEN {subtype} = 'file_comment' THEN '{FILE_COMMENT}' "
            f"WHEN {bot_id} IS NOT NULL OR {subtype} = 'bot_message' THEN '{BOT}' "
            f"WHEN coalesce(json_array_length({attachments}) > 0, false) THEN '{USER_ATTACHMENT}' "
            f"ELSE '{WHITELISTED}' END")


def attachments_nonempty(attachments: Column) -> Column:
    """True when the raw attachments text is a JSON array with elements."""
    return F.coalesce(F.json_array_length(attachments) > 0, F.lit(False))


def classify(subtype: Column, bot_id: Column, attachments: Column) -> Column:
    """X-1: the category of a message from its wire fields."""
    return (
        F.when(subtype == "file_share", F.lit(FILE_SHARE))
        .when(subtype == "file_comment", F.lit(FILE_COMMENT))
        .when(bot_id.isNotNull() | (subtype == "bot_message"), F.lit(BOT))
        .when(attachments_nonempty(attachments), F.lit(USER_ATTACHMENT))
        .otherwise(F.lit(WHITELISTED))
    )


def with_category(df: DataFrame) -> DataFrame:
    """Add ``category`` and its delivery rank ``category_ord``."""
    return (df.withColumn("category", classify(F.col("subtype"), F.col("bot_id"),
                                               F.col("attachments")))
              .withColumn("category_ord", category_rank("category")))


def drop_blacklisted(df: DataFrame, subtypes: Iterable[str]) -> DataFrame:
    """X-2 (our rule): remove messages whose subtype is configured as
    blacklisted, before classification.

    The blacklist is a short configuration list, so it is applied as an
    ``IN`` predicate on the scan side (no join, no shuffle).  A message
    without a subtype is never blacklisted.
    """
    subtypes = sorted(set(subtypes))
    if not subtypes:
        return df
    return df.filter(F.col("subtype").isNull() | ~F.col("subtype").isin(subtypes))


def blacklisted_rejects(df: DataFrame, subtypes: Iterable[str]) -> DataFrame:
    """The rows ``drop_blacklisted`` removes, in the rejects shape."""
    subtypes = sorted(set(subtypes))
    return (df.filter(F.col("subtype").isin(subtypes) if subtypes else F.lit(False))
              .select(F.lit("blacklist").alias("source"),
                      F.concat_ws("/", "channel", "ts").alias("key"),
                      F.concat(F.lit("blacklisted subtype "), F.col("subtype")).alias("reason")))

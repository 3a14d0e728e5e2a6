"""Emoji alias resolution (X-4, our rule).

An emoji value is either a URL or ``alias:<name>``.  An alias is resolved
one level, within its team, by an equi-join on (team_id, name); the join
key includes the emoji name, so one large team does not make a hot key.
An alias whose target is itself an alias (a chain) or does not exist stays
unresolved and is reported in ``status``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIRECT = "direct"
ALIAS = "alias"
CHAIN = "unresolved_chain"
MISSING = "missing_target"


def resolve_aliases(emojis: DataFrame) -> DataFrame:
    target = emojis.select(F.col("team_id").alias("_t_team"), F.col("name").alias("_t_name"),
                           F.col("url").alias("_t_url"), F.col("alias_of").alias("_t_alias"))
    joined = emojis.join(
        target,
        (F.col("alias_of").isNotNull()) & (F.col("team_id") == F.col("_t_team"))
        & (F.col("alias_of") == F.col("_t_name")),
        "left")
    status = (F.when(F.col("alias_of").isNull(), F.lit(DIRECT))
               .when(F.col("_t_name").isNull(), F.lit(MISSING))
               .when(F.col("_t_url").isNull(), F.lit(CHAIN))
               .otherwise(F.lit(ALIAS)))
    return joined.select("team_id", "name", "alias_of",
                         F.coalesce("url", "_t_url").alias("resolved_url"),
                         status.alias("status"))


def alias_rejects(resolved: DataFrame) -> DataFrame:
    return (resolved.filter(F.col("status").isin(CHAIN, MISSING))
            .select(F.lit("emoji").alias("source"),
                    F.concat_ws("/", "team_id", "name").alias("key"),
                    F.concat(F.col("status"), F.lit(": "), F.col("alias_of")).alias("reason")))

"""Counts (AGG-3, AGG-5) and run metrics (AGG-4).

Counts are ordinary grouped aggregates: Spark computes them partially in
each task before the shuffle, so a channel holding a third of all messages
costs one partial row per task, not a hot reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import classify as C
from . import sieve as S


def sieve_counts(messages: DataFrame) -> DataFrame:
    """AGG-3 per (channel, category): messages seen and notable ones kept."""
    return (S.with_notable(messages)
            .groupBy("channel", "category")
            .agg(F.count("*").alias("n_seen"),
                 F.count_if(F.col("notable")).alias("n_kept")))


def channel_totals(notable: DataFrame) -> DataFrame:
    """AGG-3 summed over categories, plus one column per category (pivot
    with the fixed category list, so no extra pass to find the values)."""
    per_cat = (notable.groupBy("channel").pivot("category", C.ORDER_B).count()
               .fillna(0, subset=C.ORDER_B))
    total = sum((F.col(c) for c in C.ORDER_B), F.lit(0))
    return per_cat.select("channel", *[F.col(c).cast("bigint").alias(f"n_{c}") for c in C.ORDER_B],
                          total.cast("bigint").alias("n_messages"))


def listing_total(df: DataFrame) -> int:
    """AGG-5: number of records in a listing (a driver-side scalar)."""
    return df.count()


def observe_metrics(df: DataFrame, name: str, **exprs) -> tuple[DataFrame, Observation]:
    """AGG-4: attach named counters to a DataFrame.

    The counters are filled by the next action on the returned DataFrame in
    the same pass (no extra job).  Example:
    ``observe_metrics(msgs, "mapper", posts=F.count("*"))``.  Observed
    metrics take no DISTINCT aggregates; count channels on the per-channel
    frame (one row per channel) instead.
    """
    obs = Observation(name)
    return df.observe(obs, *[e.alias(k) for k, e in exprs.items()]), obs


def _metric_rows(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("bigint").alias("value")) for n in names])))


def run_metrics(channels: DataFrame, notable: DataFrame, receipts: DataFrame) -> DataFrame:
    """The counters of a run as (metric, value) rows: listed channels tried and
    notable posts found by the mapper, and what each sink delivered.

    Sink counters come from OK receipts only (decision D7): posts, channels and
    users are the records of accepted payloads, teams the teams with one.  Each
    input is reduced by one aggregate; the results are stacked, not joined."""
    tried = channels.agg(F.count("*").alias("mapper_channels"))
    found = notable.agg(F.count("*").alias("mapper_posts"))
    return (_metric_rows(tried, ["mapper_channels"])
            .unionByName(_metric_rows(found, ["mapper_posts"]))
            .unionByName(delivered_metrics(receipts)))


def delivered_metrics(receipts: DataFrame) -> DataFrame:
    """Sink counters, counted only after an OK response (decision D7), and the
    payloads refused."""
    ok = F.col("status") == "OK"

    def records(kind: str):
        return F.coalesce(F.sum(F.when(ok & (F.col("kind") == kind), F.col("n_items"))), F.lit(0))
    agg = receipts.agg(
        records("posts").alias("sink_posts"), records("channels").alias("sink_channels"),
        records("users").alias("sink_users"),
        F.count_distinct(F.when(ok & (F.col("kind") == "team"), F.col("team_id"))).alias("sink_teams"),
        F.count_if(~ok).alias("refused_payloads"))
    return _metric_rows(agg, ["sink_posts", "sink_channels", "sink_users", "sink_teams",
                              "refused_payloads"])

"""Two-way routing of channels (RT-1) and sliding event-time windows per
route (WIN-1, WM-1).

The original split its stream into two tagged sides and ran one ungrouped
(parallelism-1) window per side.  Here the route is a column and both sides
share one grouped window aggregate, so every window/route pair is a separate
group and the aggregation is partial before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GTE = "gte"
LT = "lt"


def route(predicate: Column, yes: str = GTE, no: str = LT) -> Column:
    """RT-1: label rows by a predicate; a NULL predicate goes to ``no``."""
    return F.when(predicate, F.lit(yes)).otherwise(F.lit(no))


def route_channels(channels: DataFrame, min_members: int = 5,
                   name: str = "route") -> DataFrame:
    """RT-1 with the size predicate ``num_members >= min_members``."""
    return channels.withColumn(name, route(F.col("num_members") >= min_members))


def split(df: DataFrame, route_col: str = "route", yes: str = GTE, no: str = LT):
    """The two sides of a routed frame (``select(tag)`` of the original)."""
    return df.filter(F.col(route_col) == yes), df.filter(F.col(route_col) == no)


def routed_windows(events: DataFrame, ts: str, size: str, slide: str,
                   route_col: str = "route", item: str = "channel",
                   watermark: str | None = None) -> DataFrame:
    """WIN-1: per (sliding window, route): row count and the number of
    distinct items (e.g. channels) seen in the window.

    Every row belongs to size/slide windows, so a 1 s / 100 ms window
    multiplies the rows by 10 before the partial aggregation.  The list of
    items itself is ``window_members`` (tall), so no row holds a list that
    grows with the data.  With ``watermark`` the same code runs on a stream
    (WM-1): rows later than the watermark are dropped and a window is
    emitted once the watermark passes its end.  Streams take no exact
    distinct aggregates, so there ``n_items`` is a HyperLogLog estimate.
    """
    src = events.withWatermark(ts, watermark) if watermark else events
    w = F.window(ts, size, slide)
    distinct = (F.approx_count_distinct(item) if events.isStreaming
                else F.count_distinct(item))
    return (src.groupBy(w.alias("window"), F.col(route_col))
            .agg(F.count("*").alias("n"), distinct.alias("n_items")))


UNITS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
         "hour": 3_600_000_000, "day": 86_400_000_000}


def micros(duration: str) -> int:
    """Microseconds of a duration such as ``"100 milliseconds"`` or ``"1 hour"``."""
    number, unit = duration.split()
    return int(number) * UNITS[unit.rstrip("s")]


def pane_counts(events: DataFrame, ts: str, slide: str, item: str = "channel") -> DataFrame:
    """Rows per (pane, item): panes are tumbling windows as long as the slide.
    Columns ``pane`` (start, microseconds since the epoch), the item and ``n``."""
    step = micros(slide)
    pane = F.expr(f"unix_micros({ts}) - pmod(unix_micros({ts}), {step})")
    return events.groupBy(pane.alias("pane"), F.col(item)).agg(F.count("*").alias("n"))


def _expand(panes: DataFrame, size: str, slide: str) -> DataFrame:
    """Every pane in each of the size/slide windows that hold it."""
    length, step = micros(size), micros(slide)
    if length % step:
        raise ValueError("the slide must divide the window size")
    start = F.explode(F.sequence(F.col("pane") - (length - step), F.col("pane"), F.lit(step)))
    return panes.withColumn("_start", start).withColumn("window", F.struct(
        F.timestamp_micros("_start").alias("start"),
        F.timestamp_micros(F.col("_start") + length).alias("end"))).drop("_start", "pane")


def routed_pane_windows(events: DataFrame, routes: DataFrame, ts: str, size: str, slide: str,
                        route_col: str = "route", item: str = "channel") -> DataFrame:
    """WIN-1 in batch: as ``routed_windows``, but rows are counted per (pane, item)
    first, then routed, and only these few counts go into the windows.  Exact,
    since the slide divides the size; nothing is multiplied before an aggregate."""
    panes = pane_counts(events, ts, slide, item).join(routes, item)
    return (_expand(panes, size, slide).groupBy("window", route_col)
            .agg(F.sum("n").alias("n"), F.count_distinct(item).alias("n_items")))


def pane_window_members(events: DataFrame, routes: DataFrame, ts: str, size: str, slide: str,
                        route_col: str = "route", item: str = "channel") -> DataFrame:
    """``window_members`` in batch by way of panes."""
    panes = pane_counts(events, ts, slide, item).join(routes, item)
    return _expand(panes, size, slide).select("window", route_col, item).distinct()


def window_members(events: DataFrame, ts: str, size: str, slide: str,
                   route_col: str = "route", item: str = "channel") -> DataFrame:
    """AGG-1 for windows, as rows: each distinct (window, route, item).

    The original gathered the records of a window into one list; here the
    list is a tall table (one row per member), which a consumer can read in
    item order, and which never puts a whole window into one row."""
    return (events.select(F.window(ts, size, slide).alias("window"), route_col, item)
            .distinct())

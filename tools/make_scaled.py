"""Derive a larger copy of the supplied tables for scaling runs.

Usage: python tools/make_scaled.py SRC_SF_DIR OUT_DIR FACTOR
``events`` is replicated FACTOR times with unique event ids and timestamps
shifted by whole seconds (the same users, hence the same 25 channels: every
channel becomes FACTOR times hotter); the other tables are linked unchanged.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from sievery.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def main() -> None:
    src, out, factor = sys.argv[1], sys.argv[2], int(sys.argv[3])
    os.makedirs(out, exist_ok=True)
    spark = build_session()
    events = spark.read.parquet(f"{src}/events.parquet")
    span = events.agg(F.max("event_id") + 1).first()[0]
    copies = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))))
    scaled = copies.select(
        (F.col("event_id") + F.col("copy") * span).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(secs=F.col("copy").cast("decimal(18,6)"))).alias("ts"),
        "user_id", "event_type", "value", "props")
    scaled.repartition(max(8, factor // 4)).write.mode("overwrite").parquet(f"{out}/events.parquet")
    for t in TABLES:
        link = f"{out}/{t}.parquet"
        if t != "events" and not os.path.exists(link):
            os.symlink(f"{src}/{t}.parquet", link)


if __name__ == "__main__":
    main()

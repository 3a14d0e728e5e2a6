"""The scaling tool derives a larger copy with unique ids and the same users."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_make_scaled_doubles_events(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="sievery-scaled-"), "sf")
    subprocess.run([sys.executable, os.path.join(ROOT, "tools", "make_scaled.py"),
                    "/root/testdata/sf0.001", out, "2"], check=True,
                   stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL, timeout=600)
    src = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    big = spark.read.parquet(os.path.join(out, "events.parquet"))
    assert big.count() == 2 * src.count()
    assert big.select("event_id").distinct().count() == big.count()
    assert big.select("user_id").distinct().count() == src.select("user_id").distinct().count()
    assert os.path.islink(os.path.join(out, "customer.parquet"))

"""Build an N-times copy of the driver's ``events`` table for scale probes.

Every row is repeated N times with shifted ids, users and times (30 days
per copy), so keys stay distinct and the data grows along the time axis,
as a longer history would.  The other tables are copied unchanged.

Usage: python tools/scale_copy.py SRC_SF_DIR DEST_DIR [N=50]
"""

from __future__ import annotations

import os
import shutil
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    src, dest = argv[1].rstrip("/"), argv[2].rstrip("/")
    rep = int(argv[3]) if len(argv) > 3 else 50
    from pyspark.sql import functions as F

    from gridlake.session import build_session
    spark = build_session("local[8]", app_name="gridlake-scale-copy", shuffle_partitions=8)
    ev = spark.read.parquet(f"{src}/events.parquet")
    n = ev.count()
    users = ev.agg(F.max("user_id")).first()[0] + 1
    out = (ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(rep - 1))).alias("r"))
           .select((F.col("event_id") + F.col("r") * n).alias("event_id"),
                   (F.col("ts") + F.make_interval(days=(F.col("r") * 30).cast("int"))).alias("ts"),
                   (F.col("user_id") + F.col("r") * users).alias("user_id"), "event_type", "value", "props"))
    out.repartition(16).write.parquet(f"{dest}/events.parquet")
    for name in os.listdir(src):
        if name.endswith(".parquet") and name != "events.parquet":
            shutil.copy(f"{src}/{name}", f"{dest}/{name}")
    print(spark.read.parquet(f"{dest}/events.parquet").count(), "events")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)

"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

Steps
1. ``inputs``: derive the canonical input tables from the driver's parquet tables once
   (written with reliable checkpoints, as a production job would read its input tables).
2. Each headline query is fully executed (written to Spark's ``noop`` sink, which needs every
   column, so no join is optimised away) and timed.

``value`` is the total wall-clock of inputs + all queries; ``queries`` holds each part.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["conversion_report", "conversion_daily", "ab_bucket_report", "rec_by_seed", "rec_by_tag",
            "rec_by_liked"]

INPUT_VIEWS = ["clicklog", "active", "visited", "impressions", "pair_block", "user_seed", "seed_item", "play",
               "subscriptions", "item_sim", "user_tag", "tag_item", "quality", "profile", "history", "blocklist",
               "first_block", "gated", "segment", "user_max_age", "new_song_weight", "item_features",
               "user_features", "user_affinity", "item_affinity", "rate_by_seed", "rate_by_tag", "rate_by_liked",
               "pay"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from recsmith.session import build_session, remove_stage_tables
    from recsmith import catalog
    from recsmith.sources.views import Tables

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(cpus) * 2)))
    t = Tables(spark, sf_dir)
    times = {}
    t0 = time.time()
    # independent input tables are derived as concurrent Spark jobs
    from concurrent.futures import ThreadPoolExecutor
    jobs = [lambda v=v: getattr(t, v)() for v in INPUT_VIEWS] + [lambda: t.item_sim(alt=True)]
    with ThreadPoolExecutor(max_workers=4) as pool:
        for f in [pool.submit(j) for j in jobs]:
            f.result()
    times["inputs"] = round(time.time() - t0, 3)
    for n in names:
        t0 = time.time()
        catalog.QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": int(cpus)}
    print(json.dumps(out))
    remove_stage_tables(spark)
    spark.stop()


if __name__ == "__main__":
    main()

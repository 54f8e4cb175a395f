"""Times the headline queries, cold and warm; prints one JSON line with the warm times and the cold ones beside them."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cueforge.plans import registry  # noqa: E402
from cueforge.session import session  # noqa: E402

HEADLINE = ["tfidf_weights", "window_similarity", "segment_keywords", "volume_packing", "volume_index", "rollup_strip", "upsert_listing", "merge_placeholders", "smart_sync_cutoff", "asr_clean", "status_by_channel", "article_block"]


def main() -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session(f"local[{cpus}]", "bench", **{"spark.sql.shuffle.partitions": str(2 * int(cpus) if cpus.isdigit() else 16), "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g")})
    spark.sparkContext.setLogLevel("ERROR")
    found, times, cold = registry.queries(), {}, {}
    found["status_by_channel"](spark, sf).write.format("noop").mode("overwrite").save()  # starts the session
    for name in HEADLINE:
        for kept in (cold, times):
            started = time.time()
            found[name](spark, sf).write.format("noop").mode("overwrite").save()
            kept[name] = round(time.time() - started, 3)
            spark.catalog.clearCache()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "cold": cold, "sf": sf.rstrip("/").rpartition("sf")[2]}))


if __name__ == "__main__":
    main()

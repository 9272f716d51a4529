"""Times every registered query over whole tables and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from docops.plans.registry import registered
from docops.session import local_session


def run(frame) -> None:
    """Computes every row and column without keeping them."""
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = local_session(cores, int(cores) if cores.isdigit() else 8, os.environ.get("BENCH_MEMORY", "12g"))
    queries = {name: query for name, query in registered().items() if not only or name in only}
    for name in ("bulk_apply", "bulk_chunk_by_volume", "scroll_pages"):  # start the workers before timing
        run(registered()[name](spark, directory))
    seconds = {}
    for name, query in queries.items():
        start = time.perf_counter()
        run(query(spark, directory))
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

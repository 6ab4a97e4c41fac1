"""Time the registered queries and print one JSON line.

Every query runs once to warm up and once on the clock, on all rows of its result
(written to the no-op sink, so no result travels to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dossier.plans import matching, queries, round_trips  # noqa: E402
from dossier.session import build_session, remove_work  # noqa: E402


QUERIES = queries.QUERIES | round_trips.QUERIES | matching.QUERIES


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name, query in QUERIES.items():
        if only and not any(name.startswith(o) for o in only):
            continue
        for _ in range(2):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        if only:
            print(name, times[name], file=sys.stderr)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    remove_work(spark)
    spark.stop()


if __name__ == "__main__":
    main()

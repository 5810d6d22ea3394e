"""Time every registered query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; one JSON line at the end.

Each query runs once to warm up and once for the clock, over all its output columns.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import contract  # noqa: E402
from trailkeep.session import build_session  # noqa: E402


def main(names: list[str]) -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    chosen = {n: q for n, q in contract.QUERIES.items() if not names or any(n.startswith(p) for p in names)}
    seconds = {}
    for name, run in chosen.items():
        for _ in range(2):
            start = time.perf_counter()
            run(spark, sf).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])

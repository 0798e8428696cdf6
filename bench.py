"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores and
``BENCH_QUERIES`` a comma list to time other queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from linetrace.queries import REGISTRY
from linetrace.session import local_session

HEADLINE = ["positional_compare", "hunks", "range_cosine", "range_map", "best_map", "hybrid_map"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 4)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        start = time.time()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 2)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 2),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the folder of the given tables and ``BENCH_CPUS`` the number of local
cores. Each query runs to the end into a sink that drops its rows, so all columns are
computed; the better of two runs counts. Lookups and a loaded star are stored first and timed apart:
dimensions, checks and questions read them, as they do after a load.
"""

from __future__ import annotations

import json
import os
import sys
import time

from curbstar.session import local_session
from workload import catalog
from workload.catalog import QUERIES

HEADLINE = [
    "src_csv_anydate",
    "normalize_time",
    "lookup_inner_state",
    "lookup_left_body_type",
    "unmatched_codes",
    "stage2_violation",
    "dim_date",
    "dim_time",
    "dim_location",
    "dim_vehicle",
    "fact_violation",
    "last_maker",
    "profile_columns",
    "profile_duplicates",
    "value_counts",
    "conflicting_plates",
    "bad_times",
    "check_stage",
    "check_primary_keys",
    "check_references",
    "top_months",
    "top_hours",
    "top_vehicle_types",
    "top_places",
    "load_star_counts",
]
RUNS = 2


def seconds(session, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](session, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    session = local_session("bench", cpus)
    # What a load stores before any of its tables is asked; best runs of single queries leave it out.
    setup = {}
    for name, make in (("lookups", catalog._lookup_tables), ("star", catalog.star_tables)):
        start = time.perf_counter()
        make(session, sf_dir)
        setup[name] = round(time.perf_counter() - start, 3)
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        times[name] = round(min(seconds(session, name, sf_dir) for _ in range(RUNS)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    session.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of best runs; dimensions, checks and questions on a stored star",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "setup": setup,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()

"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR  data folder, default /root/testdata/sf0.1
BENCH_CPUS    threads of the local session, default 8
BENCH_RUNS    timed runs per query, default 3; the median counts
BENCH_QUERIES comma separated names, default the headline list
"""

import json
import os
import statistics
import time

from checks.queries import REGISTRY
from paperloom.runtime import local_session

HEADLINE = (
    "resolve_oa_link", "coverage_report", "accept_first_come", "duplicate_census", "biblio_lookup",
    "resolve_ids", "not_yet_seen", "reuse_entries", "merge_release", "pub_file_lookup", "pmc_lookup",
    "choose_location", "legacy_lookup", "pmc_oa_index", "pub_map_index", "artifact_index",
    "tei_report", "state_waterfall", "identifier_integrity", "collection_description",
    "upsert_id_map", "upsert_entries", "advance_flags", "first_success", "select_members",
    "content_validity", "redirect_links", "fetch_plan", "dump_metadata", "catalogue",
    "place_artifacts", "extract_archives", "ingest_release",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, "bench")
    run(spark, "coverage_report", sf_dir)
    times = {n: round(statistics.median(run(spark, n, sf_dir) for _ in range(runs)), 3) for n in names}
    print(json.dumps({
        "metric": "headline query wall time, sum of medians", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": sf_dir.rstrip("/").rpartition("sf")[2],
        "cpus": cpus, "runs": runs, "spark": spark.version,
    }))


if __name__ == "__main__":
    main()

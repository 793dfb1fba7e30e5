"""Time the headline queries; prints one JSON line.

The facts are written to a Parquet store once (timed as ``load_store``), as a loaded
database would hold them; ``q_*`` and ``p_*`` run on that store. Unpivoting, loading and
retrieval start from the source tables. Every figure is the median of BENCH_RUNS runs
after one warm-up, with the whole result produced and discarded.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortweave.sources.store import read_facts, write_facts  # noqa: E402
from fixtures import registry, study_data  # noqa: E402
from tools.session import local_session  # noqa: E402


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = tuple(sys.argv[1:])
    spark = local_session(cores, memory="16g")

    folder = tempfile.mkdtemp(prefix="cohortweave-bench-")
    facts_path, subjects_path = f"{folder}/facts", f"{folder}/subjects"

    def load() -> None:
        write_facts(study_data.spark_facts(spark, sf_dir), facts_path)
        study_data.spark_subjects(spark, sf_dir).write.mode("overwrite").parquet(subjects_path)

    times = {"load_store": timed(load)}
    for module in (registry, registry.page_queries):
        module.spark_facts = lambda s, _: read_facts(s, facts_path)
        module.spark_subjects = lambda s, _: s.read.parquet(subjects_path)

    for name, query in registry.queries().items():
        if only and not name.startswith(only):
            continue

        def run() -> None:
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        times[name] = statistics.median(timed(run) for _ in range(runs))

    print(json.dumps({
        "metric": "total of median query times", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": {name: round(t, 3) for name, t in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")), "cores": cores, "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark the headline queries.

Lands the encounter table (derived from ``lineitem`` at ``$BENCH_SF_DIR``) as
Parquet once, the way a raw file is landed in production, then runs each
headline query over the whole landed table on ``local[$BENCH_CPUS]``. Every
query is forced with a ``noop`` write (full execution, nothing collected).

Prints one JSON line: {"metric", "value", "unit", "queries", "jobs", "sf"}.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardflow.plans import model_queries as MQ  # noqa: E402
from wardflow.plans.queries import REGISTRY  # noqa: E402
from wardflow.session import get_session, scratch_path  # noqa: E402
from wardflow.sources.files import land_parquet, read_encounters  # noqa: E402
from wardflow.sources.fixtures import load_encounters  # noqa: E402

HEADLINE = [
    "missing_profile", "column_modes", "impute_encounters", "feature_table", "string_index",
    "assembled_long", "confusion_matrix", "class_metrics", "auc_exact", "decode_ids", "validate_records",
    "hash_split", "train_eval",
]


def _run(spark, name, fn, enc):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    t0 = time.time()
    df = fn(spark, enc)
    df.write.format("noop").mode("overwrite").save()
    dt = time.time() - t0
    jobs = len(sc.statusTracker().getJobIdsForGroup(name))
    return dt, jobs


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    sf = sf_dir.rsplit("sf", 1)[-1]
    spark = get_session(f"local[{cpus}]", app="wardflow-bench", shuffle_partitions=cpus * 2,
                        **{"spark.driver.memory": "16g"})
    times: dict[str, float] = {}
    jobs: dict[str, int] = {}
    load_at_start = round(os.getloadavg()[0], 2)  # host load, to read run-to-run noise

    t0 = time.time()
    path = land_parquet(load_encounters(spark, sf_dir), scratch_path(spark, "bench-encounters"))
    times["land_encounters"] = round(time.time() - t0, 3)
    enc = read_encounters(spark, path, fmt="parquet")

    registry = {**REGISTRY, **MQ.MODEL_QUERIES}
    for name in HEADLINE:
        dt, nj = _run(spark, name, registry[name], enc)
        times[name] = round(dt, 3)
        jobs[name] = nj

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_headline_sec", "value": total, "unit": "sec", "queries": times,
                      "jobs": jobs, "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus,
                      "load_at_start": load_at_start}))
    spark.stop()


if __name__ == "__main__":
    main()

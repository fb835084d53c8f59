"""Benchmark: the headline outputs on the driver tables.

1. The twelve raw source tables are derived from the driver tables at
   $BENCH_SF_DIR and written once to a scratch folder (as a connector would
   have landed them); timed as ``fixtures``.
2. Each headline output is planned from those stored raw tables and run to
   the ``noop`` sink; median of 5 runs.
3. ``full_build`` writes all nine outputs (hubs written once, then re-read;
   independent tables as concurrent jobs, ``..._one_job_at_a_time`` without);
   ``full_build_hubs_not_persisted`` writes them from the lazy plans, each
   output recomputing its whole lineage.
4. ``*_two_connections``: the same raw tables read as two accounts (twice the
   rows; every key includes ``source_relation``).

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from inboxlens import Connection, Options, build, read_sources  # noqa: E402
from inboxlens.plans.write import write_build  # noqa: E402
from inboxlens.session import local_session  # noqa: E402
from inboxlens.sources.fixtures import fixture_sources, load_driver_tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))

HEADLINE = ["campaign_activities", "campaign_recipients", "campaigns", "automation_activities",
            "automation_emails", "automations", "members", "lists", "segments"]


def timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def median_of(fn, runs: int = RUNS) -> float:
    return statistics.median(timed(fn) for _ in range(runs))


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) * 2)
    scratch = tempfile.mkdtemp(prefix="inboxlens-bench-", dir=os.environ.get("BENCH_TMP", "/tmp"))
    raw_dir = f"{scratch}/raw"

    d = load_driver_tables(spark, SF_DIR)
    fx = fixture_sources(d)

    def land():
        for t, df in fx.items():
            df.write.mode("overwrite").parquet(f"{raw_dir}/{t}")
    fixtures_sec = timed(land)

    raw = read_sources(spark, [Connection.from_directory("conn_a", raw_dir)])
    models = build(raw)
    native = build(raw, Options(distinct_strategy="native"))
    # the same tables read as two accounts: every key includes source_relation
    two = build(read_sources(spark, [Connection.from_directory("conn_a", raw_dir),
                                     Connection.from_directory("conn_b", raw_dir)]))

    def run(df):
        return lambda: df.write.format("noop").mode("overwrite").save()

    # warm-up: JVM code paths and file listing caches
    run(models["campaigns"])()

    q = {name: median_of(run(models[name])) for name in HEADLINE}
    for name in ("campaign_recipients", "members", "lists"):
        q[f"{name}_two_connections"] = median_of(run(two[name]))
    for name in ("int_campaign_activities_by_list", "int_automation_activities_by_list"):
        q[f"{name}_two_phase"] = median_of(run(models[name]))
        q[f"{name}_native"] = median_of(run(native[name]))
    runs = iter(range(1000))
    q["full_build"] = median_of(lambda: write_build(
        spark, raw, f"{scratch}/out{next(runs)}", staging=False))
    q["full_build_one_job_at_a_time"] = median_of(lambda: write_build(
        spark, raw, f"{scratch}/out{next(runs)}", staging=False, max_parallel_jobs=1))

    def lazy_build():
        target = f"{scratch}/lazy{next(runs)}"
        for name in HEADLINE:
            models[name].write.mode("overwrite").parquet(f"{target}/{name}")
    q["full_build_hubs_not_persisted"] = median_of(lazy_build)
    total = sum(q[n] for n in HEADLINE)
    print(json.dumps({
        "metric": "headline_outputs_total", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in q.items()},
        "fixtures_sec": round(fixtures_sec, 3), "sf": os.path.basename(SF_DIR.rstrip("/")),
        "cpus": int(CPUS), "runs": RUNS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Job and stage times of one output, from Spark's event log (no web UI).

usage: python tools/stage_times.py OUTPUT [sf_dir] [connections]

The raw tables are landed in a fresh scratch folder, the output is run once
to warm up and once measured; the event log of the run is written to the
scratch folder and summarised: wall time, jobs with their start offset and
duration, and the slowest stages with their task counts.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from inboxlens import Connection, build, read_sources  # noqa: E402
from inboxlens.session import local_session  # noqa: E402
from inboxlens.sources.fixtures import fixture_sources, load_driver_tables  # noqa: E402


def events(log_dir: str):
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isfile(path) and "events" in os.path.basename(path):
            with open(path, errors="ignore") as f:
                for line in f:
                    try:
                        yield json.loads(line)
                    except ValueError:
                        continue


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    n_conn = int(sys.argv[3]) if len(sys.argv) > 3 else 1
    scratch = tempfile.mkdtemp(prefix="inboxlens-stages-")
    os.makedirs(f"{scratch}/events")
    spark = local_session(8, 16, extra={"spark.eventLog.enabled": "true",
                                        "spark.eventLog.dir": f"{scratch}/events",
                                        "spark.eventLog.compress": "false"})
    for t, df in fixture_sources(load_driver_tables(spark, sf_dir)).items():
        df.write.mode("overwrite").parquet(f"{scratch}/raw/{t}")
    conns = [Connection.from_directory(f"conn_{i}", f"{scratch}/raw") for i in range(n_conn)]
    df = build(read_sources(spark, conns))[name]
    df.write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("measured", name)
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    wall = time.perf_counter() - t0
    spark.stop()

    jobs, stage_job, stages = {}, {}, {}
    for e in events(f"{scratch}/events"):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart" and \
                (e.get("Properties") or {}).get("spark.jobGroup.id") == "measured":
            jobs[e["Job ID"]] = [e["Submission Time"], None]
            for s in e["Stage IDs"]:
                stage_job[s] = e["Job ID"]
        elif kind == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            if info["Stage ID"] in stage_job and "Completion Time" in info:
                stages[info["Stage ID"]] = (info["Completion Time"] - info["Submission Time"],
                                            info["Number of Tasks"])
    start = min(v[0] for v in jobs.values())
    print(f"{name}: wall {wall:.2f}s, {len(jobs)} jobs, {len(stages)} stages run "
          f"(event log in {scratch}/events)")
    for jid, (s, e) in sorted(jobs.items(), key=lambda kv: kv[1][0]):
        print(f"  job {jid}: +{s - start} ms, {e - s} ms")
    print("  slowest stages (ms, tasks):")
    for sid, (ms, tasks) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:8]:
        print(f"    stage {sid}: {ms} ms, {tasks} tasks")


if __name__ == "__main__":
    main()

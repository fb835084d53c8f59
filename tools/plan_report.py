"""Summarise the physical plan of every output: shuffles (with their keys),
join strategies, Expand nodes and scan widths.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
import tempfile
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from inboxlens import Connection, OUTPUTS, build, read_sources  # noqa: E402
from inboxlens.session import local_session  # noqa: E402
from inboxlens.sources.fixtures import fixture_sources, load_driver_tables  # noqa: E402

SETTINGS = {
    "worst case (AQE off, no broadcast)": {"spark.sql.adaptive.enabled": "false",
                                           "spark.sql.autoBroadcastJoinThreshold": "-1"},
    "recommended settings, final plans after AQE": {},
}


def summary(plan: str) -> dict:
    # an executed adaptive plan prints its final plan, then the initial one
    plan = re.sub(r"#\d+L?", "", plan.split("== Initial Plan ==")[0])
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)
    # the scan's output column list (ReadSchema text is truncated by Spark)
    widths = [len(s.split(",")) for s in re.findall(r"FileScan \w+ \[([^\]\n]*)\]", plan)]
    return {"shuffles": len(keys), "keys": Counter(keys),
            "broadcast joins": plan.count("BroadcastHashJoin"),
            "sort-merge joins": plan.count("SortMergeJoin"), "expand": plan.count("Expand"),
            "scans": len(widths), "max scan width": max(widths or [0])}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 16)
    raw_dir = tempfile.mkdtemp(prefix="plans-") + "/raw"
    for t, df in fixture_sources(load_driver_tables(spark, sf_dir)).items():
        df.write.mode("overwrite").parquet(f"{raw_dir}/{t}")
    print("# Physical plans of the outputs\n")
    print(f"Generated by `python tools/plan_report.py {sf_dir}` (one connection; raw tables as "
          "Parquet). Shuffle keys are listed with their count.\n")
    for title, conf in SETTINGS.items():
        old = {k: spark.conf.get(k) for k in conf}
        for k, v in conf.items():
            spark.conf.set(k, v)
        models = build(read_sources(spark, [Connection.from_directory("a", raw_dir)]))
        print(f"## {title}\n")
        print("| output | shuffles | broadcast / sort-merge joins | Expand | scans (max columns read) | shuffle keys |")
        print("| --- | --- | --- | --- | --- | --- |")
        for name in OUTPUTS:
            df = models[name]
            if not conf:
                # run through the DataFrame's own query execution so that its
                # plan is AQE's final one (an action like .write plans anew)
                df._jdf.queryExecution().toRdd().count()
            s = summary(df._jdf.queryExecution().executedPlan().toString())
            keys = "; ".join(f"({k}) ×{n}" if n > 1 else f"({k})" for k, n in sorted(s["keys"].items()))
            print(f"| {name} | {s['shuffles']} | {s['broadcast joins']} / {s['sort-merge joins']} | "
                  f"{s['expand']} | {s['scans']} ({s['max scan width']}) | {keys} |")
        print()
        for k, v in old.items():
            spark.conf.set(k, v)


if __name__ == "__main__":
    main()

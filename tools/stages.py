"""Per-stage wall time and task count of one registered query, read from
Spark's event log written to a fresh scratch folder (no web UI involved).

usage: python tools/stages.py <query> [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.registry import QUERIES  # noqa: E402
from tessera.session import get_session  # noqa: E402


def main():
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="tessera-eventlog-")
    spark = get_session("local[8]", shuffle_partitions=16, spark__eventLog__enabled="true",
                        spark__eventLog__dir=f"file://{log_dir}",
                        spark__eventLog__compress="false",
                        spark__eventLog__rolling__enabled="false")
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    wall = time.perf_counter() - t0
    spark.stop()
    stages = []
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
                    stages.append((info["Stage ID"], dur, info["Number of Tasks"],
                                   info["Stage Name"][:70]))
    for sid, dur, tasks, label in sorted(stages):
        print(f"stage {sid:4d} {dur:7.2f}s {tasks:5d} tasks  {label}")
    print(f"{name}: {wall:.2f}s wall, {len(stages)} stages (event log in {log_dir})")


if __name__ == "__main__":
    main()

"""Per-query job / stage / task totals from a Spark event log.

Usage: BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
       python tools/eventlog_summary.py <that dir>/<app log file or eventlog_v2_* folder>

Jobs are attributed to the job description bench.py sets per query
(``query:<name>`` / ``stage:<name>``). Prints one line per description:
jobs, stages, tasks, summed stage wall time, executor run time, shuffle
bytes written, and the widest single-task stage count (scans that did not
split).
"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of a plain, zstd-compressed or rolling (directory) event log."""
    files = ([os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("events_")]
             if os.path.isdir(path) else [path])
    for f in files:
        if f.endswith(".zstd"):
            import zstandard
            with open(f, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(f) as fh:
                yield from fh


def main(path: str) -> None:
    job_desc: dict[int, str] = {}
    stage_job: dict[int, int] = {}
    agg = defaultdict(lambda: defaultdict(float))
    if True:
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                desc = (ev.get("Properties") or {}).get("spark.job.description", "-")
                job_desc[ev["Job ID"]] = desc
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = ev["Job ID"]
                agg[desc]["jobs"] += 1
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                desc = job_desc.get(stage_job.get(info["Stage ID"], -1), "-")
                a = agg[desc]
                a["stages"] += 1
                a["tasks"] += info.get("Number of Tasks", 0)
                if info.get("Number of Tasks", 0) == 1:
                    a["single_task_stages"] += 1
                if "Submission Time" in info and "Completion Time" in info:
                    a["stage_ms"] += info["Completion Time"] - info["Submission Time"]
                for acc in info.get("Accumulables", []):
                    name, value = acc.get("Name"), acc.get("Value")
                    if name == "internal.metrics.executorRunTime":
                        a["run_ms"] += float(value)
                    elif name == "internal.metrics.shuffle.write.bytesWritten":
                        a["shuffle_bytes"] += float(value)
    print(f"{'description':40s} {'jobs':>5s} {'stages':>6s} {'tasks':>6s} {'1-task':>6s} "
          f"{'stage_ms':>9s} {'run_ms':>9s} {'shuffle_MB':>10s}")
    for desc, a in sorted(agg.items(), key=lambda kv: -kv[1]["stage_ms"]):
        print(f"{desc[:40]:40s} {int(a['jobs']):5d} {int(a['stages']):6d} {int(a['tasks']):6d} "
              f"{int(a['single_task_stages']):6d} {int(a['stage_ms']):9d} {int(a['run_ms']):9d} "
              f"{a['shuffle_bytes'] / 1e6:10.2f}")


if __name__ == "__main__":
    main(sys.argv[1])

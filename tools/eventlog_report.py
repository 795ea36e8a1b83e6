"""Summarise a Spark event log: jobs, stages, task-time skew, shuffle bytes.

usage: python tools/eventlog_report.py <event log file or folder> [--top N]

Write the log with ``spark.eventLog.enabled=true`` and
``spark.eventLog.dir=<scratch folder>`` (bench.py: BENCH_EVENT_LOG=<folder>).
For each stage: task count, wall time, max and median task time (a max far
above the median marks a skewed stage), shuffle read/write bytes, spill.
"""

from __future__ import annotations

import io
import json
import os
import statistics
import sys
from collections import defaultdict


def _files(path):
    """Event log files under ``path`` (Spark 4 writes rolling logs in a folder)."""
    if not os.path.isdir(path):
        return [path]
    out = []
    for root, _dirs, names in os.walk(path):
        out += [os.path.join(root, n) for n in sorted(names)
                if not n.startswith(".") and not n.startswith("appstatus")]
    return sorted(out)


def _open(f):
    """Open a plain or zstd-compressed (Spark's default codec) event log file."""
    if f.endswith(".zstd") or f.endswith(".zst"):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(open(f, "rb"), read_across_frames=True)
        return io.TextIOWrapper(raw, encoding="utf-8")
    return open(f, encoding="utf-8")


def report(path: str, top: int = 15) -> None:
    tasks = defaultdict(list)
    stages = {}
    jobs = 0
    for f in _files(path):
        with _open(f) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    jobs += 1
                elif kind == "SparkListenerTaskEnd" and ev.get("Task Metrics"):
                    m = ev["Task Metrics"]
                    sid = ev["Stage ID"]
                    sr = m.get("Shuffle Read Metrics", {})
                    sw = m.get("Shuffle Write Metrics", {})
                    tasks[sid].append((m.get("Executor Run Time", 0),
                                       sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0),
                                       sw.get("Shuffle Bytes Written", 0),
                                       m.get("Disk Bytes Spilled", 0)))
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    dur = (info.get("Completion Time") or 0) - (info.get("Submission Time") or 0)
                    stages[info["Stage ID"]] = (info.get("Stage Name", "")[:60], dur)
    print(f"jobs={jobs} stages={len(stages)} tasks={sum(len(t) for t in tasks.values())}")
    print(f"{'stage':>5} {'tasks':>5} {'wall ms':>8} {'max ms':>7} {'med ms':>7} {'shuf rd':>9} {'shuf wr':>9} {'spill':>7}  name")
    rows = sorted(stages.items(), key=lambda kv: -kv[1][1])[:top]
    for sid, (name, dur) in rows:
        t = tasks.get(sid, [])
        run = [x[0] for x in t] or [0]
        print(f"{sid:>5} {len(t):>5} {dur:>8} {max(run):>7} {int(statistics.median(run)):>7} "
              f"{sum(x[1] for x in t):>9} {sum(x[2] for x in t):>9} {sum(x[3] for x in t):>7}  {name}")


if __name__ == "__main__":
    args = sys.argv[1:]
    n = 15
    if "--top" in args:
        i = args.index("--top")
        n = int(args[i + 1])
        del args[i:i + 2]
    report(args[0], n)

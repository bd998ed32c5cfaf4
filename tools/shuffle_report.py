"""Summarise a Spark event log per job group (one group per bench query):
job wall time, bytes read from files, shuffle bytes written and read.

Usage: python tools/shuffle_report.py <event-log-file>
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of an event log: a file, or a rolling-log directory of parts."""
    files = [path] if os.path.isfile(path) else sorted(
        os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_"))
    for fp in files:
        if fp.endswith(".zstd"):
            import io

            import zstandard

            with open(fp, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(fp) as f:
                yield from f


def main(path: str) -> None:
    job_group, stage_job = {}, {}
    stats = defaultdict(lambda: {"jobs": 0, "ms": 0, "input": 0, "shuffle_write": 0, "shuffle_read": 0})
    starts = {}
    for line in _lines(path):
        if line.strip():
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id", "-")
                job_group[e["Job ID"]] = g
                starts[e["Job ID"]] = e["Submission Time"]
                for sid in e.get("Stage IDs", []):
                    stage_job[sid] = e["Job ID"]
                stats[g]["jobs"] += 1
            elif ev == "SparkListenerJobEnd":
                g = job_group.get(e["Job ID"], "-")
                stats[g]["ms"] += e["Completion Time"] - starts.get(e["Job ID"], e["Completion Time"])
            elif ev == "SparkListenerTaskEnd":
                g = job_group.get(stage_job.get(e["Stage ID"]), "-")
                m = e.get("Task Metrics") or {}
                stats[g]["input"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
                stats[g]["shuffle_write"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                r = m.get("Shuffle Read Metrics") or {}
                stats[g]["shuffle_read"] += r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
    print(f"{'group':24s} {'jobs':>4s} {'job ms':>8s} {'input MB':>9s} {'shuf w MB':>9s} {'shuf r MB':>9s}")
    for g, s in sorted(stats.items()):
        if g.startswith("warmup:"):
            continue
        print(f"{g:24s} {s['jobs']:4d} {s['ms']:8d} {s['input'] / 1e6:9.2f} {s['shuffle_write'] / 1e6:9.2f} "
              f"{s['shuffle_read'] / 1e6:9.2f}")


if __name__ == "__main__":
    main(sys.argv[1])

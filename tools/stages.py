"""Summarise a Spark event log folder: slowest stages and their task counts.

Usage: python tools/stages.py <event-log-dir> [top]
(Works with the default zstd-compressed v2 event logs written by bench.py
when BENCH_EVENT_LOG_DIR is set.)
"""

from __future__ import annotations

import io
import json
import os
import sys


def _lines(path):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    return raw.decode().splitlines()


def main(argv):
    d, top = argv[1], int(argv[2]) if len(argv) > 2 else 10
    if not any(f.startswith("events") for f in os.listdir(d)):
        d = os.path.join(d, sorted(os.listdir(d))[-1])
    stages, jobs = {}, {}
    for fn in sorted(os.listdir(d)):
        if not fn.startswith("events"):
            continue
        for line in _lines(os.path.join(d, fn)):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerJobStart":
                desc = (e.get("Properties") or {}).get("spark.job.description", "")
                for sid in e.get("Stage IDs", []):
                    jobs[sid] = desc[:60]
            if e.get("Event") == "SparkListenerStageCompleted":
                i = e["Stage Info"]
                stages[i["Stage ID"]] = (i.get("Completion Time", 0) - i.get("Submission Time", 0),
                                         i["Number of Tasks"], jobs.get(i["Stage ID"], ""))
    for sid, (ms, tasks, desc) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"stage {sid:5d} {ms:7d} ms {tasks:5d} tasks {desc}")
    print(f"{len(stages)} stages, {sum(v[0] for v in stages.values())} ms in total")


if __name__ == "__main__":
    main(sys.argv)

"""Summarise a Spark event log: one line per job with its stages.

    python tools/eventlog_jobs.py <event-log-folder>

For offline reading of stage and task times (``BENCH_EVENT_LOG=<folder>
python bench.py`` writes one); no UI or server is involved. Prints
``job  start_s  duration_s  call_site  [(stage, tasks, seconds), ...]``.
"""

from __future__ import annotations

import io
import json
import os
import sys

import zstandard


def _lines(path: str):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    return raw.decode("utf-8", "replace").splitlines()


def main(folder: str) -> None:
    jobs: dict[int, dict] = {}
    stages: dict[int, tuple] = {}
    for root, _, files in os.walk(folder):
        for name in files:
            if name.startswith((".", "appstatus")):
                continue
            for line in _lines(os.path.join(root, name)):
                try:
                    e = json.loads(line)
                except ValueError:
                    continue
                kind = e.get("Event")
                if kind == "SparkListenerJobStart":
                    jobs[e["Job ID"]] = {
                        "start": e["Submission Time"],
                        "stages": e["Stage IDs"],
                        "site": e.get("Properties", {}).get("callSite.short", ""),
                    }
                elif kind == "SparkListenerJobEnd" and e["Job ID"] in jobs:
                    jobs[e["Job ID"]]["end"] = e["Completion Time"]
                elif kind == "SparkListenerStageCompleted":
                    si = e["Stage Info"]
                    took = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
                    stages[si["Stage ID"]] = (si["Stage Name"][:40], si["Number of Tasks"], took)
    if not jobs:
        print("no jobs found")
        return
    first = min(j["start"] for j in jobs.values())
    for jid, j in sorted(jobs.items()):
        st = [stages[s] for s in j["stages"] if s in stages]
        took = (j.get("end", j["start"]) - j["start"]) / 1000
        print(jid, round((j["start"] - first) / 1000, 2), round(took, 2), j["site"][:50], st)


if __name__ == "__main__":
    main(sys.argv[1])

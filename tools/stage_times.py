"""Summarise jobs, stages and slow tasks from a Spark event log folder.

    BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/stage_times.py <that folder>
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main(folder: str, slow_ms: int = 100) -> None:
    files = sorted(glob.glob(os.path.join(folder, "**", "events_*"), recursive=True)) or sorted(
        f for f in glob.glob(os.path.join(folder, "*")) if os.path.isfile(f)
    )
    jobs: dict[int, dict] = {}
    stages: dict[int, dict] = {}
    slow: list[tuple] = []
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            kind = e["Event"]
            if kind == "SparkListenerJobStart":
                desc = (e.get("Properties") or {}).get("spark.job.description", "")
                jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": e["Stage IDs"], "desc": desc}
            elif kind == "SparkListenerJobEnd":
                jobs[e["Job ID"]]["end"] = e["Completion Time"]
            elif kind == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = {
                    "ms": si.get("Completion Time", 0) - si.get("Submission Time", 0),
                    "tasks": si["Number of Tasks"],
                    "name": si["Stage Name"],
                }
            elif kind == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                ms = ti["Finish Time"] - ti["Launch Time"]
                if ms >= slow_ms:
                    slow.append((e["Stage ID"], ti["Task ID"], ms))
    per_label: dict[str, list[int]] = {}
    for j in jobs.values():
        if j["desc"]:
            per_label.setdefault(j["desc"], []).append(j.get("end", j["start"]) - j["start"])
    if per_label:
        print("per label (jobs, total ms):")
        for label, times in sorted(per_label.items(), key=lambda kv: -sum(kv[1])):
            print(f"  {len(times):3d} {sum(times):7d}  {label[:100]}")
    for jid, j in sorted(jobs.items()):
        print(f"job {jid:4d} {j.get('end', j['start']) - j['start']:6d} ms  stages {j['stages']}  {j['desc'][:80]}")
    for sid, s in sorted(stages.items()):
        print(f"stage {sid:4d} {s['ms']:6d} ms  {s['tasks']:4d} tasks  {s['name'][:60]}")
    for sid, tid, ms in slow:
        print(f"slow task {tid} of stage {sid}: {ms} ms")


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 100)

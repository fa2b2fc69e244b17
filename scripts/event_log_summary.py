"""Summarise a Spark event log: time per job description and per stage.

Usage:
    python scripts/event_log_summary.py <event-log file or folder> [--stages]

Write the log to a scratch folder with ``spark.eventLog.enabled=true`` and
``spark.eventLog.dir=<folder>`` (the web UI stays off).  Plain and
zstd-compressed logs (the default codec) are read.  Prints, per job
description (``SparkContext.setJobDescription`` -- the full refresh labels
each staged table), the number of jobs and their summed duration; with
``--stages``, every stage with its task count, wall time, executor run time
and shuffle records written.
"""

from __future__ import annotations

import collections
import glob
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "*"))) if os.path.isdir(path) else [path]
    for fn in files:
        base = os.path.basename(fn)
        if os.path.isdir(path) and not base.startswith("events_"):
            continue
        with open(fn, "rb") as fh:
            raw = fh.read()
        if raw[:4] == b"\x28\xb5\x2f\xfd":  # zstd frame
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        yield from raw.decode().splitlines()


def main() -> int:
    if len(sys.argv) < 2:
        print(__doc__)
        return 2
    path, show_stages = sys.argv[1], "--stages" in sys.argv[2:]
    job_start, job_desc, stage_job = {}, {}, {}
    per_desc = collections.defaultdict(lambda: [0, 0])
    stages = []
    for line in _lines(path):
        e = json.loads(line)
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            job_start[e["Job ID"]] = e["Submission Time"]
            job_desc[e["Job ID"]] = props.get("spark.job.description") or "(no description)"
            for sid in e.get("Stage IDs", []):
                stage_job[sid] = e["Job ID"]
        elif ev == "SparkListenerJobEnd":
            d = per_desc[job_desc[e["Job ID"]]]
            d[0] += 1
            d[1] += e["Completion Time"] - job_start[e["Job ID"]]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            acc = {a["Name"]: a.get("Value") for a in si.get("Accumulables", [])}
            stages.append((si["Stage ID"], stage_job.get(si["Stage ID"]), si["Number of Tasks"],
                           si["Completion Time"] - si["Submission Time"],
                           acc.get("internal.metrics.executorRunTime"),
                           acc.get("internal.metrics.shuffle.write.recordsWritten")))
    print(f"{'job description':50s} {'jobs':>5s} {'sum ms':>8s}")
    for desc, (n, ms) in per_desc.items():
        print(f"{desc[:50]:50s} {n:5d} {ms:8d}")
    if show_stages:
        print(f"\n{'stage':>6s} {'job':>5s} {'tasks':>6s} {'wall ms':>8s} {'run ms':>8s} {'shuffle w':>10s}")
        for sid, job, tasks, wall, run, shuf in stages:
            print(f"{sid:6d} {job if job is not None else -1:5d} {tasks:6d} {wall:8d} "
                  f"{run or 0:8d} {shuf or 0:10d}")
    return 0


if __name__ == "__main__":
    sys.exit(main())

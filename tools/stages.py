"""Per-query job, stage and task totals from a Spark event log written by
``BENCH_EVENTLOG=<folder> python bench.py`` (bench sets one job group per
query; stages of untagged jobs, such as the warm-up, are listed as ``-``).

    python tools/stages.py <event-log-folder-or-file>
"""

import glob
import io
import json
import os
import sys
from collections import defaultdict


def event_lines(path: str):
    """Lines of one event-log file; Spark 4 writes rolling folders
    (``eventlog_v2_<app>/events_<n>_<app>[.zstd]``), compressed by default."""
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def log_files(path: str) -> list[str]:
    if os.path.isfile(path):
        return [path]
    return sorted(f for f in glob.glob(os.path.join(path, "**", "*"), recursive=True)
                  if os.path.isfile(f) and os.path.basename(f).startswith(("events_", "local-")))


def main(path: str) -> None:
    stage_group: dict[int, str] = {}
    jobs: dict[str, set] = defaultdict(set)
    stats = defaultdict(lambda: {"stages": 0, "tasks": 0, "stage_ms": 0})
    for f in log_files(path):
        for line in event_lines(f):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "-")
                jobs[group].add(ev["Job ID"])
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = group
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                s = stats[stage_group.get(info["Stage ID"], "-")]
                s["stages"] += 1
                s["tasks"] += info.get("Number of Tasks", 0)
                if info.get("Submission Time") and info.get("Completion Time"):
                    s["stage_ms"] += info["Completion Time"] - info["Submission Time"]
    print(f"{'query':26s} {'jobs':>5s} {'stages':>7s} {'tasks':>6s} {'stage s':>8s}")
    for group, s in sorted(stats.items(), key=lambda kv: -kv[1]["stage_ms"]):
        print(f"{group:26s} {len(jobs[group]):5d} {s['stages']:7d} {s['tasks']:6d} "
              f"{s['stage_ms'] / 1000:8.2f}")


if __name__ == "__main__":
    main(sys.argv[1])

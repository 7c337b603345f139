"""Summarise a Spark event log: the slowest stages with task counts.

Usage: python tools/stage_times.py EVENT_LOG_FILE_OR_DIR [top_n]
"""

from __future__ import annotations

import io
import json
import os
import sys


def _event_files(path: str) -> list[str]:
    if not os.path.isdir(path):
        return [path]
    found = []
    for root, _, names in os.walk(path):
        found += [os.path.join(root, n) for n in sorted(names) if n.startswith(("events_", "local-", "app-"))]
    return found


def _lines(file: str):
    if file.endswith(".zstd"):
        import zstandard

        raw = open(file, "rb")
        reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
        return io.TextIOWrapper(reader, encoding="utf-8")
    return open(file, encoding="utf-8")


def stages(path: str) -> list[dict]:
    out = []
    for file in _event_files(path):
        with _lines(file) as fh:
            for line in fh:
                event = json.loads(line)
                if event.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = event["Stage Info"]
                start, end = info.get("Submission Time"), info.get("Completion Time")
                if start is None or end is None:
                    continue
                out.append({
                    "stage": info["Stage ID"],
                    "name": info["Stage Name"].split(" at ")[0],
                    "tasks": info["Number of Tasks"],
                    "ms": end - start,
                })
    return out


def main(argv):
    rows = sorted(stages(argv[0]), key=lambda r: -r["ms"])[: int(argv[1]) if len(argv) > 1 else 15]
    for r in rows:
        print(f"{r['ms']:>7} ms  stage {r['stage']:>4}  {r['tasks']:>5} tasks  {r['name']}")


if __name__ == "__main__":
    main(sys.argv[1:])

"""Summarise stage durations from a Spark event log folder (zstd or plain)."""

import glob
import io
import json
import sys

import zstandard


def lines(path):
    if path.endswith(".zstd"):
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        yield from open(path, encoding="utf-8")


def main(folder):
    stages = {}
    for f in sorted(glob.glob(folder + "/**/events_*", recursive=True)):
        for line in lines(f):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                d = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
                stages[si["Stage ID"]] = (round(d, 2), si["Number of Tasks"], si["Stage Name"][:40])
            elif e.get("Event") == "SparkListenerJobStart":
                print("job", e["Job ID"], "stages", e["Stage IDs"])
    for k, v in sorted(stages.items()):
        print(k, v)


if __name__ == "__main__":
    main(sys.argv[1])

"""Summarise stage durations from a Spark event log folder (zstd or plain)."""
import glob
import io
import json
import sys


def lines(path):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as f:
            data = zstandard.ZstdDecompressor().stream_reader(f).read()
        return io.StringIO(data.decode("utf-8"))
    return open(path, encoding="utf-8")


def main(folder, last=None):
    stages = {}
    for f in sorted(glob.glob(f"{folder}/**/events_*", recursive=True)):
        for line in lines(f):
            e = json.loads(line)
            if e["Event"] == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si.get("Completion Time", 0) - si.get("Submission Time", 0),
                                          si["Number of Tasks"], si["Stage Name"][:80])
    items = sorted(stages.items())
    for sid, (dur, nt, name) in items[-int(last):] if last else items:
        print(f"{sid:5d} {dur:7d} ms {nt:4d} tasks  {name}")


if __name__ == "__main__":
    main(*sys.argv[1:])

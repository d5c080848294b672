"""Measure every registered query: wall seconds, input rows read, shuffle bytes
written, from Spark's event log in a fresh scratch folder (no UI, no server).

    python scripts/measure_baseline.py [sf_dir] [cpus] > table.md
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from hearth.plans.testbed import QUERIES  # noqa: E402
from hearth.session import DEFAULT_CONF, ensure_checkpoint_dir  # noqa: E402


def _lines(path: str):
    """Event-log lines; rolling logs are zstd-compressed by default."""
    if path.endswith(".zstd"):
        import io

        import zstandard
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path) as fh:
            yield from fh


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = sys.argv[2] if len(sys.argv) > 2 else "8"
    logdir = tempfile.mkdtemp(prefix="hearth-eventlog-")
    b = SparkSession.builder.master(f"local[{cpus}]").appName("hearth-baseline")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = (b.config("spark.sql.shuffle.partitions", str(int(cpus) * 2)).config("spark.driver.memory", "12g")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    walls = {}
    for name, fn in QUERIES.items():          # warm-up pass (JIT, codegen caches)
        fn(spark, sf).write.format("noop").mode("overwrite").save()
    for name, fn in QUERIES.items():
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        fn(spark, sf).write.format("noop").mode("overwrite").save()
        walls[name] = time.perf_counter() - t0
    version = spark.version
    spark.stop()

    stage_group, rows, shuffle = {}, defaultdict(int), defaultdict(int)
    for path in sorted(glob.glob(os.path.join(logdir, "**", "events_*"), recursive=True)):
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = group
            elif kind == "SparkListenerTaskEnd":
                g = stage_group.get(ev.get("Stage ID"))
                m = ev.get("Task Metrics") or {}
                if g:
                    rows[g] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                    shuffle[g] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
    print(f"Measured on {sf}, local[{cpus}], Spark {version}, after one warm-up pass; sum "
          f"{sum(walls.values()):.1f} s over {len(walls)} queries.\n")
    print("| query | wall s | input rows | shuffle bytes |")
    print("|---|---|---|---|")
    for name in QUERIES:
        print(f"| {name} | {walls[name]:.2f} | {rows[name]:,} | {shuffle[name]:,} |")


if __name__ == "__main__":
    main()

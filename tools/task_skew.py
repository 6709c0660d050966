"""Largest task per stage, from Spark's event log, for the fact build on skewed input.

Usage: python tools/task_skew.py [sf_dir] [hot_share] [films|crew]

The bronze films of ``sf_dir`` are derived as usual, then a ``hot_share`` part
of them (default a third, picked by a hash of the id) gets one common imdb_id:
a group of copies holding that share of all rows.  With ``crew`` the films
stay as they are and that share of the crew rows gets the id of one film
instead (a title with a third of all crew rows).  The fact is built twice,
with the plain crew join and window (``hot_keys=None``) and with hot ids
detected and split off (``find_hot_keys``), each as its own job group.  The
event log is written to a fresh scratch folder; per variant the tool prints
the stage holding the largest task (shuffle records read): its task count,
largest and median task and total, as one JSON line.  Partition coalescing
is off, so each shuffle partition is one task, as with realistic sizes.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _event_lines(log_path: str):
    """Lines of a plain event log file, or of the event files of a rolling log folder, in order."""
    if os.path.isdir(log_path):
        parts = [p for p in os.listdir(log_path) if p.startswith("events_")]
        files = [os.path.join(log_path, p) for p in sorted(parts, key=lambda p: int(p.split("_")[1]))]
    else:
        files = [log_path]
    for f in files:
        with open(f) as fh:
            yield from fh


def _stage_tasks(log_path: str) -> tuple[dict, dict]:
    """Job group of each stage, and shuffle records read by each of its tasks."""
    groups, tasks = {}, {}
    for line in _event_lines(log_path):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerStageSubmitted":
            sid = e["Stage Info"]["Stage ID"]
            groups[sid] = (e.get("Properties") or {}).get("spark.jobGroup.id")
        elif ev == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            n = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            tasks.setdefault(e["Stage ID"], []).append(n)
    return groups, tasks


def main(argv) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    share = float(argv[2]) if len(argv) > 2 else 1 / 3
    side = argv[3] if len(argv) > 3 else "films"
    scratch = tempfile.mkdtemp(prefix="reelhouse-skew-", dir=os.environ.get("TMPDIR", "/tmp"))
    logs = os.path.join(scratch, "eventlog")
    os.makedirs(logs)

    from pyspark.sql import functions as F

    from reelhouse.operators.windows import find_hot_keys
    from reelhouse.plans.daily import build_bronze
    from reelhouse.plans.fact import fact_movie_performance
    from reelhouse.session import build_session
    from reelhouse.sources import sinks
    from reelhouse.sources.adapter import RawInputs

    spark = build_session("local[8]", app_name="reelhouse-skew", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{logs}",
        "spark.eventLog.compress": "false",
        # keep the plain plan a shuffle join, as it would be for large tables
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    })
    spark.sparkContext.setLogLevel("ERROR")
    # one task per shuffle partition, as with partitions of realistic size
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    raw = RawInputs(spark, sf_dir)
    b = build_bronze(raw.films_src, raw.crew_src, raw.names_src)
    hot_id = F.lit("tt000000001")
    films = b.tmdb_raw
    if side == "films":
        bucket = F.abs(F.xxhash64("imdb_id")) % 1000
        films = films.withColumn("imdb_id", F.when(bucket < int(share * 1000), hot_id).otherwise(F.col("imdb_id")))
    sinks.overwrite(films, f"{scratch}/films")
    films = spark.read.parquet(f"{scratch}/films")
    # crew rows of the films present only, so that film rows dominate the join tasks
    ids = films.select(F.col("imdb_id").alias("tconst")).distinct()
    crew = b.crew.join(ids, "tconst", "left_semi")
    if side == "crew":
        first_id = films.agg(F.min("imdb_id")).first()[0]  # one value
        bucket = F.abs(F.xxhash64("tconst", "directors")) % 1000
        crew = crew.withColumn("tconst", F.when(bucket < int(share * 1000), F.lit(first_id)).otherwise(F.col("tconst")))
    sinks.overwrite(crew, f"{scratch}/crew")
    films, crew = spark.read.parquet(f"{scratch}/films"), spark.read.parquet(f"{scratch}/crew")
    n_rows = films.count()

    sc = spark.sparkContext
    sc.setJobGroup("plain", "fact, plain join and window")
    sinks.overwrite(fact_movie_performance(films, crew, hot_keys=None), f"{scratch}/fact_plain")
    sc.setJobGroup("split", "fact, hot ids split off")
    # at test scale the share test alone picks the heavy id (5% of the sampled rows)
    found = [h for h in (find_hot_keys(films, ["imdb_id"], share=0.05, sample_fraction=0.2, min_rows=10),
                         find_hot_keys(crew.select(F.col("tconst").alias("imdb_id")), ["imdb_id"], share=0.05,
                                       sample_fraction=0.2, min_rows=10)) if h is not None]
    if not found:
        spark.stop()
        print(json.dumps({"sf_dir": sf_dir, "hot_side": side, "hot_share": round(share, 3), "hot_ids": 0}))
        return 1
    hot = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    sinks.overwrite(fact_movie_performance(films, crew, hot_keys=hot), f"{scratch}/fact_split")
    same = (spark.read.parquet(f"{scratch}/fact_plain").exceptAll(spark.read.parquet(f"{scratch}/fact_split"))
            .count() == 0)
    spark.stop()

    log_path = sorted(glob.glob(os.path.join(logs, "*")))[-1]
    groups, tasks = _stage_tasks(log_path)
    out = {"sf_dir": sf_dir, "hot_side": side, "film_rows": n_rows, "hot_share": round(share, 3),
           "results_equal": same}
    for variant in ("plain", "split"):
        stages = [t for sid, t in tasks.items() if groups.get(sid) == variant and len(t) > 1 and max(t) > 0]
        t = max(stages, key=max)
        out[variant] = {"stage_tasks": len(t), "max_task_shuffle_records": max(t),
                        "median_task_shuffle_records": int(statistics.median(t)),
                        "stage_shuffle_records": sum(t)}
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

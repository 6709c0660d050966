"""Benchmark: the daily warehouse build and the reports at one scale factor.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3; reports and id builds report the median warm run).

Stages (seconds):
  bronze          adapter -> film filter -> typed bronze Parquet (films, crew, names)
  dims            the five dimensions, written
  fact_direct     fact, direct plan (one join + lag + distributed ids), written
  fact_literal    fact with dimension lookups by join and '' director keys (counted, not written)
  ids_distributed dense_row_id over lineitem (range + checkpoint + offsets)
  ids_window      row_number() over a global ORDER BY (single task), for contrast
  r1..r5, r4_mode reports on the written gold tables (collected)
  views           full and limited views (counted)
  quality         12 column tests + 5 foreign keys, one result frame
  daily_end_to_end  run_daily from files: film CSV and gzip TSV dumps (written by
                  Spark from the adapter frames, untimed) -> raw run by date ->
                  bronze -> dimensions -> fact -> views -> quality, every layer
                  written; reported on its own, not part of ``value``

An untimed warm-up pass runs the same stages on sf0.001 first.
Prints one JSON line.  ``value`` is the sum of all stages except the
single-task contrast ``ids_window`` and the end-to-end ``daily_end_to_end``
(which repeats the other stages' work from files).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from reelhouse import oracle
    from reelhouse.operators import quality
    from reelhouse.operators.windows import dense_row_id
    from reelhouse.plans import reports as R
    from reelhouse.plans.daily import Bronze, build_bronze, build_dims, run_daily
    from reelhouse.plans.fact import fact_literal, fact_movie_performance
    from reelhouse.plans.views import view_full, view_limited
    from reelhouse.session import build_session, ensure_checkpoint_dir
    from reelhouse.sources import sinks
    from reelhouse.sources.adapter import RawInputs, read_testdata

    spark = build_session(f"local[{cpus}]", app_name="reelhouse-bench", shuffle_partitions=max(8, cpus * 2))
    spark.sparkContext.setLogLevel("ERROR")
    as_of = oracle.AS_OF

    def run(sf_dir: str, times: dict, repeat: int):
        scratch = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex[:8]}"

        def timed(name, fn):
            t0 = time.perf_counter()
            out = fn()
            times[name] = round(time.perf_counter() - t0, 3)
            return out

        def timed_median(name, fn):
            runs = []
            for _ in range(repeat):
                t0 = time.perf_counter()
                fn()
                runs.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(runs), 3)

        # -- bronze ---------------------------------------------------------------
        def bronze_stage():
            raw = RawInputs(spark, sf_dir)
            b = build_bronze(raw.films_src, raw.crew_src, raw.names_src)
            for name, df, key in (("tmdb_raw", b.tmdb_raw, "imdb_id"), ("crew", b.crew, "tconst"),
                                  ("names", b.names, "nconst")):
                sinks.overwrite(df, f"{scratch}/bronze/{name}", sort_by=[key])
            return Bronze(*(spark.read.parquet(f"{scratch}/bronze/{n}") for n in ("tmdb_raw", "crew", "names")))

        bronze = timed("bronze", bronze_stage)

        # -- gold -----------------------------------------------------------------
        def dims_stage():
            for name, df in build_dims(bronze, as_of).items():
                sinks.overwrite(df, f"{scratch}/gold/{name}")
            return {n: spark.read.parquet(f"{scratch}/gold/{n}") for n in
                    ("dim_movie", "dim_genre", "dim_director", "dim_production", "dim_date")}

        g = timed("dims", dims_stage)

        def fact_stage():
            sinks.overwrite(fact_movie_performance(bronze.tmdb_raw, bronze.crew), f"{scratch}/gold/fact")
            return spark.read.parquet(f"{scratch}/gold/fact")

        fact = timed("fact_direct", fact_stage)
        timed("fact_literal", lambda: fact_literal(bronze.tmdb_raw, bronze.crew, g["dim_genre"], g["dim_production"],
                                                   g["dim_date"]).count())

        # -- global row ids: distributed vs single task --------------------------
        li = read_testdata(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
        order = ["l_orderkey", "l_linenumber"]
        timed_median("ids_distributed",
                     lambda: dense_row_id(li, order, "rid").agg(F.max("rid"), F.sum("l_quantity")).collect())
        w = Window.orderBy(*[F.col(c).asc_nulls_last() for c in order])
        timed_median("ids_window",
                     lambda: li.withColumn("rid", F.row_number().over(w)).agg(F.max("rid"), F.sum("l_quantity")).collect())

        # -- reports on the written gold tables -----------------------------------
        dm, dg, dd, ddir, dp = g["dim_movie"], g["dim_genre"], g["dim_date"], g["dim_director"], g["dim_production"]
        reports = {
            "r1_genre_rating": lambda: R.genre_rating(fact, dg).collect(),
            "r2_directors": lambda: R.directors(fact, ddir, min_rating=oracle.DIRECTOR_MIN_RATING).collect(),
            "r3_by_year": lambda: R.by_release_year(fact, dm).collect(),
            "r4_top_films": lambda: R.top_films(fact, dm, dg, oracle.TOP_YEAR, 10).collect(),
            "r4_mode": lambda: R.top_genres_by_peak(fact, dm, dg, oracle.TOP_YEAR, 10).collect(),
            "r5_runtime_bucket": lambda: R.runtime_buckets(fact, dm).collect(),
        }
        for name, fn in reports.items():
            timed_median(name, fn)
        timed_median("views", lambda: (view_full(fact, dm, dd, ddir, dg, dp).count(),
                                       view_limited(fact, dm, dd, ddir, dg, dp).count()))
        tables = {"dim_movie": dm, "dim_genre": dg, "dim_date": dd, "dim_production": dp, "dim_director": ddir,
                  "fact_movie_performance": fact}
        timed_median("quality", lambda: quality.run_suite(tables, foreign_keys=quality.GOLD_FOREIGN_KEYS, fail=False))

        # -- the daily run from files, end to end ----------------------------------
        raw = RawInputs(spark, sf_dir)
        inp = f"{scratch}/in"
        raw.films_src.write.option("header", True).option("escape", '"').csv(f"{inp}/movies")
        sinks.write_tsv_gz(raw.crew_src.select("tconst", "directors"), f"{inp}/title.crew.tsv.gz")
        sinks.write_tsv_gz(raw.names_src.select("nconst", "primaryName", "primaryProfession"),
                           f"{inp}/name.basics.tsv.gz")
        timed("daily_end_to_end", lambda: run_daily(
            spark, f"{inp}/movies", f"{inp}/title.crew.tsv.gz", f"{inp}/name.basics.tsv.gz", f"{scratch}/daily",
            run_date=oracle.AS_OF, as_of=as_of, raw_partitions=max(8, cpus * 2)))
        return bronze, fact

    # Warm-up (untimed): the same code paths on the smallest scale, so JVM
    # class loading and JIT compilation do not land in the first timed stage.
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    run(warm_dir if os.path.isdir(warm_dir) else sf_dir, {}, 1)
    times: dict[str, float] = {}
    bronze, fact = run(sf_dir, times, repeat)

    total = round(sum(v for k, v in times.items() if k not in ("ids_window", "daily_end_to_end")), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "warehouse_build_and_reports_total", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "rows": {"tmdb_raw": bronze.tmdb_raw.count(), "fact": fact.count()}}))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())

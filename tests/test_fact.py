import datetime as dt

from pyspark.sql import functions as F

from fixtures import dup_world, films, crew
from reelhouse.plans import dims as D
from reelhouse.operators.windows import find_hot_keys
from reelhouse.plans import fact as FM
from reelhouse.plans.fact import fact_literal, fact_movie_performance


def test_dims_on_fixture(spark):
    f, c, n = dup_world(spark)
    movies = {r.movie_title: r for r in D.dim_movie(f).collect()}
    assert set(movies) == {"Alpha", "Beta", "Gamma"}
    assert movies["Alpha"].imdb_id == "tt1" and movies["Alpha"].release_date == dt.date(2001, 3, 1)
    assert movies["Beta"].imdb_id == "tt2"  # smallest id wins, whole row
    genres = {r.genre_name for r in D.dim_genre(f).collect()}
    assert genres == {"Drama", "Horror", ""}  # blank first item of a non-empty list is kept
    prods = {r.production_name for r in D.dim_production(f, "2024-01-01").collect()}
    assert prods == {"Studio A"}
    dirs = {r.director_id: r.director_name for r in D.dim_director(c, n, "2024-01-01").collect()}
    assert dirs == {"nm1": "Agnès Varda", "nm3": "Cher", "nm9": None}
    dd = D.dim_date(f).collect()
    assert len(dd) == 4 and all(r.date_id is not None for r in dd)


def test_fact_direct_lag_and_ids(spark):
    f, c, _ = dup_world(spark)
    fact = fact_movie_performance(f, c).collect()
    assert len(fact) == 5
    assert sorted(r.fact_id for r in fact) == [1, 2, 3, 4, 5]
    tt1 = sorted([r for r in fact if r.imdb_id == "tt1"], key=lambda r: r.revenue)
    assert tt1[0].revenue_growth is None and tt1[1].revenue_growth == 500
    assert abs(tt1[1].vote_avg_change - 1.0) < 1e-9
    assert {r.director_id for r in fact if r.imdb_id == "tt2"} == {None}  # empty list -> NULL key
    # the empty genre list joins the '' genre, which exists because of tt4's blank first item
    g_blank = [r.genre_id for r in fact if r.imdb_id in ("tt2", "tt4")]
    assert g_blank[0] == g_blank[1] and g_blank[0] is not None


def test_fact_key_modes_agree(spark):
    f, c, _ = dup_world(spark)
    derive = fact_movie_performance(f, c).collect()
    joined = fact_movie_performance(f, c, key_mode="join", dim_genre=D.dim_genre(f),
                                    dim_production=D.dim_production(f), dim_date=D.dim_date(f)).collect()
    assert sorted(derive) == sorted(joined)


def test_fact_key_modes_agree_without_blank_genre(spark):
    f = films(spark, [dict(imdb_id="tt1", genres=""), dict(imdb_id="tt2", genres="Drama")])
    c = crew(spark, [("tt1", "nm1")])
    derive = fact_movie_performance(f, c).collect()
    joined = fact_movie_performance(f, c, key_mode="join", dim_genre=D.dim_genre(f),
                                    dim_production=D.dim_production(f), dim_date=D.dim_date(f)).collect()
    assert sorted(derive) == sorted(joined)
    assert [r.genre_id for r in derive if r.imdb_id == "tt1"] == [None]


def test_literal_plan_keeps_one_row_per_film(spark):
    f, c, _ = dup_world(spark)
    lit = fact_literal(f, c, D.dim_genre(f), D.dim_production(f), D.dim_date(f))
    # no self-join product: the two copies of tt1 stay two rows
    assert lit.filter(F.col("imdb_id") == "tt1").count() == 2
    assert lit.count() == 5
    assert lit.filter(F.col("imdb_id") == "tt2").first().director_id == ""
    direct = {r.imdb_id: r.director_id for r in fact_movie_performance(f, c).collect()}
    assert direct["tt2"] is None


def test_fact_hot_key_path_matches(spark):
    f, c, _ = dup_world(spark)
    hot = spark.createDataFrame([("tt1",)], "imdb_id string")
    a = fact_movie_performance(f, c, hot_keys=None).collect()
    b = fact_movie_performance(f, c, hot_keys=hot).collect()
    assert sorted(a) == sorted(b)


def test_fact_hot_id_split_before_the_crew_join(spark):
    # one id holds a third of the rows (copies with different revenue and dates)
    hot_rows = [dict(imdb_id="tt7", title=f"Copy {i}", revenue=1000 + i, release_date=dt.date(2000 + i % 20, 1, 1))
                for i in range(300)]
    cold_rows = [dict(imdb_id=f"tt{100 + i}", title=f"Film {i}", revenue=i) for i in range(600)]
    f = films(spark, hot_rows + cold_rows).repartition(6)
    c = crew(spark, [("tt7", "nm7,nm8")] + [(f"tt{100 + i}", f"nm{i % 13}") for i in range(0, 600, 2)])
    hot = find_hot_keys(f, ["imdb_id"], share=0.1, sample_fraction=0.5, min_rows=10)
    assert {r.imdb_id for r in hot.collect()} == {"tt7"}
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # behave like large tables
    try:
        split = fact_movie_performance(f, c, hot_keys=hot)
        directors = c.select(F.col("tconst").alias("imdb_id"), F.col("directors").alias("director_id"))
        cold_j, hot_j = FM._join_crew(FM._film_measures(f), directors, hot, 1000)
        cold_plan = cold_j._jdf.queryExecution().executedPlan().toString()
        hot_plan = hot_j._jdf.queryExecution().executedPlan().toString()
        plain = fact_movie_performance(f, c, hot_keys=None)
        a, b = sorted(plain.collect()), sorted(split.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert a == b and len(a) == 900
    assert sorted(r.fact_id for r in b) == list(range(1, 901))
    tt7 = sorted((r for r in b if r.imdb_id == "tt7"), key=lambda r: (r.revenue,))
    assert all(r.director_id == "nm7" for r in tt7)
    assert sum(1 for r in tt7 if r.revenue_growth is None) == 1
    # the hot rows meet their crew rows in a broadcast join; the cold rows in a shuffle join
    assert "SortMergeJoin" in cold_plan and "LeftOuter" in cold_plan
    assert "SortMergeJoin" not in hot_plan and "BroadcastHashJoin" in hot_plan and "LeftOuter" in hot_plan


def test_fact_hot_id_heavy_in_crew_too(spark):
    # tt7: 40 film rows and 30 crew rows (a group of copies on both sides); the
    # hot crew rows exceed the broadcast cap, so the hot branch takes the
    # inner join plus the films without crew rows (tt8 is hot but has none)
    hot_rows = [dict(imdb_id="tt7", title=f"Copy {i}", revenue=1000 + i) for i in range(40)]
    hot_rows += [dict(imdb_id="tt8", title=f"Lone {i}", revenue=i) for i in range(5)]
    cold_rows = [dict(imdb_id=f"tt{100 + i}", title=f"Film {i}", revenue=i) for i in range(60)]
    f = films(spark, hot_rows + cold_rows).repartition(4)
    c = crew(spark, [("tt7", f"nm{i},nm0") for i in range(30)] + [(f"tt{100 + i}", "nm5") for i in range(0, 60, 3)])
    hot = spark.createDataFrame([("tt7",), ("tt8",)], "imdb_id string")
    plain = fact_movie_performance(f, c, hot_keys=None).collect()
    split = fact_movie_performance(f, c, hot_keys=hot, max_broadcast_rows=10).collect()
    assert len(plain) == 40 * 30 + 5 + 60
    key = lambda r: (r.imdb_id, r.director_id or "", r.revenue, r.fact_id)
    assert sorted(plain, key=key) == sorted(split, key=key)
    d = c.select(F.col("tconst").alias("imdb_id"), F.col("directors").alias("director_id"))
    _, hot_j = FM._join_crew(FM._film_measures(f), d, hot, 10)
    plan = hot_j._jdf.queryExecution().executedPlan().toString()
    assert "Inner" in plan and "LeftAnti" in plan and "LeftOuter" not in plan


def test_fact_ids_deterministic_with_crew_copies(spark):
    # one film, 25 identical crew rows: 25 fact rows equal in every column but
    # the lag changes (the first has none); ids must not depend on the plan
    f = films(spark, [dict(imdb_id="tt7", title="Only"), dict(imdb_id="tt8", title="Other")])
    c = crew(spark, [("tt7", "nm1,nm2")] * 25 + [("tt8", "nm3")])
    hot = spark.createDataFrame([("tt7",)], "imdb_id string")
    plain = sorted(fact_movie_performance(f, c, hot_keys=None).collect())
    split = sorted(fact_movie_performance(f, c, hot_keys=hot, max_broadcast_rows=5).collect())
    assert plain == split and len(plain) == 26
    first = [r for r in plain if r.imdb_id == "tt7" and r.revenue_growth is None]
    assert len(first) == 1 and first[0].fact_id == 1  # the row without a predecessor gets the lowest id

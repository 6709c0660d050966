"""The reporting questions as parameterised DataFrame queries.

Where a report groups the fact by a dimension attribute, the fact is first
aggregated by the dimension *key* (sum and count, map-side partial
aggregation), and only those per-key partials meet the dimension.  The join
input is then one row per key instead of one row per film, whatever the size
of the dimension, and a hot key costs one partial row per map task.  Averages
are recombined exactly as sum / count.

Films are matched to ``dim_movie`` on imdb_id (the fact's movie_id is a title
hash and cannot be compared with a text id).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.exprs import bucketize, year_range
from reelhouse.operators.joins import DEFAULT_BROADCAST_ROWS, fits
from reelhouse.operators.windows import top_k_per_group

# Runtime buckets (inclusive upper edges, minutes) and labels.
RUNTIME_EDGES = (60, 90, 120, 150)
RUNTIME_LABELS = ("0-60 min", "61-90 min", "91-120 min", "121-150 min")
RUNTIME_ELSE = "151+ min"


def _partials(fact: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """Per-key sum and non-NULL count of each measure, plus count(movie_id)."""
    aggs = []
    for m in measures:
        aggs += [F.sum(F.col(m).cast("double")).alias(f"s_{m}"), F.count(m).alias(f"n_{m}")]
    aggs.append(F.count("movie_id").alias("n_movies"))
    return fact.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def _avg(m: str) -> F.Column:
    return F.sum(f"s_{m}") / F.sum(f"n_{m}")


def genre_rating(fact: DataFrame, dim_genre: DataFrame, digits: int = 2) -> DataFrame:
    """Average rating per genre, best first."""
    p = _partials(fact, "genre_id", ["vote_avg"])
    j = p.join(dim_genre.select("genre_id", "genre_name"), "genre_id", "inner")
    return (
        j.groupBy("genre_name")
        .agg(F.round(_avg("vote_avg"), digits).alias("avg_rating"))
        .orderBy(F.col("avg_rating").desc_nulls_last(), F.col("genre_name").asc_nulls_last())
    )


def directors(
    fact: DataFrame,
    dim_director: DataFrame,
    min_films: int = 5,
    min_rating: float = 6.5,
    min_revenue: float = 10_000_000,
    k: int = 10,
    digits: int = 2,
) -> DataFrame:
    """Directors with at least ``min_films`` films, average rating above
    ``min_rating`` and average revenue above ``min_revenue``; top ``k`` by
    rating, then revenue."""
    p = _partials(fact, "director_id", ["vote_avg", "revenue"])
    j = p.join(dim_director.select("director_id", "director_name"), "director_id", "inner")
    g = j.groupBy("director_name").agg(
        _avg("vote_avg").alias("r"), _avg("revenue").alias("v"), F.sum("n_movies").alias("movie_count")
    )
    g = g.filter((F.col("movie_count") >= min_films) & (F.col("r") > min_rating) & (F.col("v") > min_revenue))
    return (
        g.select(
            "director_name",
            F.round("r", digits).alias("avg_rating"),
            F.round("v", digits).alias("avg_revenue"),
            "movie_count",
        )
        .orderBy(F.col("avg_rating").desc_nulls_last(), F.col("avg_revenue").desc_nulls_last(),
                 F.col("director_name").asc_nulls_last())
        .limit(k)
    )


def by_release_year(fact: DataFrame, dim_movie: DataFrame, digits: int = 2) -> DataFrame:
    """Average rating and revenue per release year of the matched movie.

    The fact is first reduced to per-imdb_id partials; that aggregation and
    the join share one hash partitioning on imdb_id, so the pre-aggregation
    adds no exchange and a repeated id arrives as one row.
    """
    p = _partials(fact, "imdb_id", ["vote_avg", "revenue"])
    m = dim_movie.select("imdb_id", F.year("release_date").alias("release_year"))
    j = p.join(m, "imdb_id", "inner")
    return (
        j.groupBy("release_year")
        .agg(
            F.round(_avg("vote_avg"), digits).alias("avg_rating"),
            F.round(_avg("revenue"), 0).alias("avg_revenue"),
        )
        .orderBy(F.col("release_year").asc_nulls_last())
    )


def _year_movies(dim_movie: DataFrame, year: int) -> DataFrame:
    """Movies released in ``year``; the date range reaches the Parquet scan."""
    return dim_movie.filter(year_range("release_date", year)).select("imdb_id", "movie_title")


def _year_fact(fact: DataFrame, movies: DataFrame, max_broadcast_rows: int) -> DataFrame:
    """Fact rows with a genre, cut to the year's films by a broadcast semi-join
    when the year's movie list is checked small (otherwise the inner join
    with the movies does the cut later)."""
    f = fact.select("imdb_id", "genre_id", "revenue").filter(F.col("genre_id").isNotNull())
    if fits(movies, max_broadcast_rows):
        f = f.join(F.broadcast(movies.select("imdb_id")), "imdb_id", "left_semi")
    return f


def top_films(fact: DataFrame, dim_movie: DataFrame, dim_genre: DataFrame, year: int, k: int = 10,
              max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The ``k`` highest-revenue films of each genre released in ``year``.

    Equal to ranking every (fact row, movie row) pair that shares an imdb_id,
    without forming those pairs: only the ``k`` best revenues of a (genre,
    film) and the ``k`` smallest titles of a film can reach a genre's top
    ``k``, so both sides are cut to that first (partial top-k before each
    shuffle) and a group of copies of one id never multiplies.
    """
    movies = _year_movies(dim_movie, year)
    f = _year_fact(fact, movies, max_broadcast_rows)
    f = top_k_per_group(f, ["genre_id", "imdb_id"], [F.col("revenue").desc_nulls_last()], k, "__r").drop("__r")
    m = top_k_per_group(movies, ["imdb_id"], [F.col("movie_title").asc_nulls_last()], k, "__r").drop("__r")
    j = f.join(m, "imdb_id", "inner").join(dim_genre.select("genre_id", "genre_name"), "genre_id", "inner")
    order = [F.col("revenue").desc_nulls_last(), F.col("movie_title").asc_nulls_last(),
             F.col("imdb_id").asc_nulls_last()]
    ranked = top_k_per_group(j, ["genre_name"], order, k, "rank")
    return ranked.select("genre_name", "rank", "movie_title", "imdb_id", "revenue")


def top_genres_by_peak(fact: DataFrame, dim_movie: DataFrame, dim_genre: DataFrame, year: int,
                       k: int = 10, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Per genre in ``year``: the most frequent title (ties -> smallest) and
    the highest revenue; the ``k`` genres with the highest peak revenue.

    Counted over (fact row, movie row) pairs sharing an imdb_id, without
    forming them: the fact is first reduced to one row per (genre, film)
    (row count and top revenue, map-side partial aggregation), and only those
    rows meet the movie titles.  The frequent title then takes two aggregation
    levels with constant-size buffers, so no genre or title has to sit in one
    task as a value -> count map.
    """
    movies = _year_movies(dim_movie, year)
    per_film = _year_fact(fact, movies, max_broadcast_rows).groupBy("genre_id", "imdb_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("revenue").alias("peak"))
    j = per_film.join(movies, "imdb_id", "inner").join(dim_genre.select("genre_id", "genre_name"), "genre_id")
    per_title = j.filter(F.col("movie_title").isNotNull()).groupBy("genre_name", "movie_title").agg(
        F.sum("n").alias("n"))
    top_title = per_title.groupBy("genre_name").agg(
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("movie_title").alias("t"))).alias("best"))
    peak = j.groupBy("genre_name").agg(F.max("peak").alias("top_revenue"))
    g = peak.join(top_title, "genre_name", "left").select(
        "genre_name", F.col("best.t").alias("top_movie"), "top_revenue")
    return g.orderBy(F.col("top_revenue").desc_nulls_last(), F.col("genre_name").asc_nulls_last()).limit(k)


def runtime_buckets(fact: DataFrame, dim_movie: DataFrame, digits: int = 2) -> DataFrame:
    """Film count and average revenue per runtime bucket, lowest revenue first.

    Per-imdb_id partials of the fact meet the movie dimension (see
    ``by_release_year``).
    """
    m = dim_movie.filter(F.col("movie_runtime").isNotNull()).select(
        "imdb_id",
        bucketize("movie_runtime", RUNTIME_EDGES, RUNTIME_LABELS, RUNTIME_ELSE).alias("runtime_bucket"),
    )
    p = _partials(fact.filter(F.col("revenue").isNotNull()), "imdb_id", ["revenue"])
    j = p.join(m, "imdb_id", "inner")
    return (
        j.groupBy("runtime_bucket")
        .agg(F.sum("n_movies").alias("movie_count"), F.round(_avg("revenue"), digits).alias("avg_revenue"))
        .orderBy(F.col("avg_revenue").asc_nulls_last(), F.col("runtime_bucket").asc_nulls_last())
    )


def slice_report(df: DataFrame, filters: dict[str, Sequence]) -> DataFrame:
    """Dashboard slice: keep rows whose columns take one of the given values."""
    out = df
    for c, values in filters.items():
        out = out.filter(F.col(c).isin(list(values)))
    return out

"""Analytical views over the star schema: full and pseudonymised.

Both are five LEFT joins from the fact to its dimensions.  Dimension sides
are projected to the key and the attribute the view needs before joining, so
only those columns travel.  A view is defined once and read later, so it holds
no hints: AQE picks broadcast or shuffle joins from the sizes it meets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.operators.masking import bucket_rule, first_word_rule, hash_rule, keep_prefix, mask

MEASURES = [
    "vote_avg", "vote_count", "revenue", "budget", "movie_popularity", "revenue_growth",
    "popularity_change", "vote_avg_change",
]
VIEW_COLUMNS = ["movie_title", "release_year", "director_name", "genre_name", "production_name", *MEASURES]


def _star(fact, dim_movie, dim_date, dim_director, dim_genre, dim_production):
    f = fact.select("imdb_id", "date_id", "director_id", "genre_id", "production_id", *MEASURES)
    sides = {
        "imdb_id": dim_movie.select("imdb_id", "movie_title"),
        "date_id": dim_date.select("date_id", F.col("year").alias("release_year")),
        "director_id": dim_director.select("director_id", "director_name"),
        "genre_id": dim_genre.select("genre_id", "genre_name"),
        "production_id": dim_production.select("production_id", "production_name"),
    }
    for key, dim in sides.items():
        f = f.join(dim, key, "left")
    return f.select(VIEW_COLUMNS)


def view_full(fact, dim_movie, dim_date, dim_director, dim_genre, dim_production) -> DataFrame:
    """Readable star view: titles, year, names and all measures."""
    return _star(fact, dim_movie, dim_date, dim_director, dim_genre, dim_production)


# The pseudonymisation of the limited view, as rules (column -> mask).
LIMITED_RULES = {
    "movie_title": hash_rule("md5_60"),
    "release_year": keep_prefix(2, "**"),
    "director_name": first_word_rule("*****"),
    "vote_avg": bucket_rule(6.0, 8.0),
}


def view_limited(fact, dim_movie, dim_date, dim_director, dim_genre, dim_production,
                 rules=None) -> DataFrame:
    """Star view with the title hashed, the year masked to its century, only
    the director's first name shown and the rating generalised to a band."""
    full = _star(fact, dim_movie, dim_date, dim_director, dim_genre, dim_production)
    return mask(full, LIMITED_RULES if rules is None else rules)


# The two views as SQL text over stored tables (``{fact}`` and the dimensions are
# relation names), for views that live in the catalog.
STAR_SQL = """SELECT {columns}
FROM {fact_movie_performance} f
LEFT JOIN {dim_movie} m ON f.imdb_id = m.imdb_id
LEFT JOIN {dim_date} dt ON f.date_id = dt.date_id
LEFT JOIN {dim_director} d ON f.director_id = d.director_id
LEFT JOIN {dim_genre} g ON f.genre_id = g.genre_id
LEFT JOIN {dim_production} p ON f.production_id = p.production_id"""
FULL_SQL = {
    "movie_title": "m.movie_title", "release_year": "dt.year", "director_name": "d.director_name",
    "genre_name": "g.genre_name", "production_name": "p.production_name", **{c: f"f.{c}" for c in MEASURES},
}
LIMITED_SQL = FULL_SQL | {
    "movie_title": "CAST(conv(substr(md5(m.movie_title), 1, 15), 16, 10) AS BIGINT)",
    "release_year": "concat(substr(CAST(dt.year AS STRING), 1, 2), '**')",
    "director_name": "concat(split_part(d.director_name, ' ', 1), ' ', '*****')",
    "vote_avg": "CASE WHEN f.vote_avg IS NULL OR isnan(f.vote_avg) THEN 'UNKNOWN' WHEN f.vote_avg < 6.0D THEN 'LOW' "
                "WHEN f.vote_avg < 8.0D THEN 'MID' ELSE 'HIGH' END",
}
STORED_VIEWS = {"analytical_view_full": FULL_SQL, "analytical_view_limited": LIMITED_SQL}


def view_sql(name: str, relations: dict[str, str]) -> str:
    """SQL text of a view over the given relations (table name -> what FROM reads)."""
    columns = ",\n       ".join(f"{x} AS {c}" for c, x in STORED_VIEWS[name].items())
    return STAR_SQL.format(columns=columns, **relations)

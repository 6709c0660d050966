"""Declared table schemas (bronze and gold) and column documentation.

Bronze types follow the warehouse DDL, widened where Spark has no unsigned
integer (UInt32 -> BIGINT).  Gold types are what the models produce; hash keys
are signed 64-bit (only equality matters).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, F, DT, B = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.FloatType(),
    T.DateType(),
    T.BooleanType(),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Columns the film loader keeps from the raw catalogue file (extra ones ignored).
RAW_FILM_COLUMNS = [
    "imdb_id", "title", "release_date", "production_companies", "budget", "revenue",
    "vote_average", "original_language", "vote_count", "runtime", "genres", "status",
]

# -- bronze ---------------------------------------------------------------
TMDB_RAW = _struct(
    ("imdb_id", S), ("title", S), ("release_date", DT), ("production_companies", S),
    ("budget", L), ("revenue", L), ("vote_average", F), ("vote_count", L),
    ("runtime", I), ("genres", S), ("original_language", S),
)
TITLE_BASICS_RAW = _struct(("tconst", S), ("primaryTitle", S), ("startYear", I), ("runtimeMinutes", I))
TITLE_CREW_RAW = _struct(("tconst", S), ("directors", S))
NAME_BASICS_RAW = _struct(("nconst", S), ("primaryName", S), ("primaryProfession", S))

# Lakehouse snapshot of the film file (all optional, timestamps in microseconds).
TMDB_SNAPSHOT = _struct(
    ("imdb_id", S), ("title", S), ("vote_avg", D), ("vote_count", I),
    ("release_date", T.TimestampNTZType()), ("revenue", D),
)

BRONZE = {
    "tmdb_raw": TMDB_RAW,
    "imdb_title_basics_raw": TITLE_BASICS_RAW,
    "imdb_title_crew_raw": TITLE_CREW_RAW,
    "imdb_name_basics_raw": NAME_BASICS_RAW,
}

# -- gold -----------------------------------------------------------------
DIM_MOVIE = _struct(
    ("movie_id", L), ("imdb_id", S), ("movie_title", S), ("release_date", DT),
    ("movie_runtime", I), ("language", S),
)
DIM_GENRE = _struct(("genre_id", L), ("genre_name", S))
DIM_DIRECTOR = _struct(
    ("imdb_dir_name_id", L), ("director_id", S), ("director_name", S),
    ("valid_from", DT), ("valid_to", DT), ("is_current", I),
)
DIM_PRODUCTION = _struct(
    ("production_id", L), ("production_name", S), ("valid_from", DT), ("valid_to", DT),
    ("is_current", B),
)
DIM_DATE = _struct(
    ("date_id", L), ("full_date", DT), ("year", I), ("month", I), ("day", I), ("week", I),
    ("weekday", S), ("season", S), ("is_weekend", I), ("holiday_name", S), ("is_holiday", I),
    ("days_until_holiday", I), ("days_after_holiday", I),
)
FACT = _struct(
    ("fact_id", L), ("movie_id", L), ("imdb_id", S), ("director_id", S), ("genre_id", L),
    ("production_id", L), ("date_id", L), ("vote_avg", D), ("vote_count", L), ("revenue", L),
    ("budget", L), ("movie_popularity", D), ("revenue_growth", L), ("popularity_change", D),
    ("vote_avg_change", D),
)

GOLD = {
    "dim_movie": DIM_MOVIE,
    "dim_genre": DIM_GENRE,
    "dim_director": DIM_DIRECTOR,
    "dim_production": DIM_PRODUCTION,
    "dim_date": DIM_DATE,
    "fact_movie_performance": FACT,
}

# Table and column descriptions (documentation kept with the data as
# StructField metadata / table comments, see ``operators.quality.describe``).
TABLE_COMMENTS = {
    "dim_movie": "One row per trimmed film title",
    "dim_genre": "One row per first-listed genre",
    "dim_date": "One row per release day, with calendar attributes",
    "dim_production": "One row per first-listed production company",
    "fact_movie_performance": "One row per film row and crew row: keys, measures, changes within an id",
    "tmdb_raw": "Film rows that passed the quality filter, typed",
    "imdb_title_basics_raw": "Titles with start year and runtime, -1 where unknown",
    "imdb_title_crew_raw": "Director lists by title id",
    "imdb_name_basics_raw": "People by id",
}
COLUMN_COMMENTS = {
    "dim_movie": {
        "movie_id": "hash of the trimmed title",
        "imdb_id": "smallest catalogue id carrying the title",
        "movie_title": "trimmed title",
        "movie_runtime": "minutes, from the row of that id",
        "language": "language code, from the row of that id",
    },
    "dim_genre": {"genre_id": "hash of the name", "genre_name": "first item of the genre list"},
    "dim_date": {
        "date_id": "hash of the ISO date",
        "full_date": "the day itself",
        "year": "calendar year",
        "month": "1 to 12",
        "day": "1 to 31",
        "week": "ISO week, 1 to 53",
        "weekday": "three-letter English name",
        "season": "by month, northern hemisphere",
        "is_weekend": "1 on Saturday and Sunday, else 0",
        "holiday_name": "tagged holiday, NULL on other days",
        "is_holiday": "1 where holiday_name is set, else 0",
    },
    "dim_production": {
        "production_id": "hash of the name",
        "production_name": "first item of the company list",
        "valid_from": "day of the build",
        "valid_to": "NULL: every row is open",
        "is_current": "TRUE in every row of a full refresh",
    },
    "fact_movie_performance": {
        "movie_id": "key into dim_movie",
        "imdb_id": "catalogue id of the film row",
        "director_id": "first listed director, key into dim_director",
        "genre_id": "key into dim_genre",
        "production_id": "key into dim_production",
        "date_id": "key into dim_date",
        "vote_avg": "rating as loaded",
        "vote_count": "votes as loaded",
        "revenue": "revenue as loaded",
        "budget": "budget as loaded",
        "movie_popularity": "rating times ln(1 + votes)",
        "revenue_growth": "revenue minus that of the previous row of the same id",
        "popularity_change": "popularity minus that of the previous row of the same id",
        "vote_avg_change": "rating minus that of the previous row of the same id",
    },
}

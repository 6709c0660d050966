"""Gold fact: one row per bronze film row (times its crew rows).

Direct plan (default)
    Every dimension key of the fact is a hash of a value the film row already
    carries, and each dimension holds *every* such value of the same bronze
    table (dimensions and fact are rebuilt from one bronze snapshot).  So
    ``key = hash(value)`` whenever the dimension would match, which removes the
    genre, company and date joins: the only join left is the one to the crew
    table (both sides large: one shuffle on imdb_id).  The lag window reuses
    that hash partitioning, and ``fact_id`` is numbered by the distributed
    ``file_row_id`` instead of a single-task window.  Ids that hold a large
    share of the films or of the crew rows are split off both inputs *before*
    that join; they take a broadcast join (or an inner join that AQE can split
    on either side) and the spread lag path (``_join_crew``).

    With ``key_mode="join"`` the keys are looked up in given dimension frames
    instead (size-checked broadcast joins), for dimensions built elsewhere.

Literal plan (``fact_literal``)
    The model's key lookups as joins against given dimensions, with '' kept as
    the key of an empty director list.  The model's re-join of per-film
    lookups on imdb_id (n copies of an id -> n^4 rows, all combinations within
    a group) is deliberately not reproduced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.exprs import first_item, popularity, surrogate_key
from reelhouse.operators.joins import DEFAULT_BROADCAST_ROWS, fits, fits_all
from reelhouse.operators.windows import file_row_id, find_hot_keys, lag_spread, lag_window, split_by_keys
from reelhouse.plans.dims import KEY_ALGO

# Fixed orderings (ascending, NULLs last).  The first columns are the model's;
# the rest are tiebreaks that make row ids and lag deterministic.  The changes
# come last in the row-id order (NULLs first: the row without a predecessor
# gets the lower id), so rows still tied there are identical in every column:
# copies of one film with the same first director, whichever id each gets.
FACT_ID_ORDER = ["imdb_id", "date_id", "director_id", "genre_id", "production_id", "title", "revenue"]
FACT_ID_LAST = ["revenue_growth", "popularity_change", "vote_avg_change"]  # ascending, NULLs first
LAG_ORDER = ["release_year", "release_date", "title", "revenue", "director_id"]
CHANGES = {"revenue": "revenue_growth", "movie_popularity": "popularity_change", "vote_avg": "vote_avg_change"}

FACT_COLUMNS = [
    "fact_id", "movie_id", "imdb_id", "director_id", "genre_id", "production_id", "date_id",
    "vote_avg", "vote_count", "revenue", "budget", "movie_popularity", "revenue_growth",
    "popularity_change", "vote_avg_change",
]


def _film_measures(films: DataFrame) -> DataFrame:
    return films.select(
        "imdb_id", "title", "release_date", "production_companies", "genres", "budget", "revenue",
        F.col("vote_average").cast("double").alias("vote_avg"),
        F.col("vote_count").cast("bigint").alias("vote_count"),
        popularity("vote_average", "vote_count").alias("movie_popularity"),
        F.year("release_date").alias("release_year"),
    )


def _blank_first_genre_exists(films: DataFrame) -> bool:
    """Does the genre dimension contain '' (a non-empty list with a blank first item)?"""
    g = F.col("genres")
    return films.filter(g.isNotNull() & (g != "") & (first_item(g) == "")).limit(1).count() > 0


def _resolve_hot_keys(films: DataFrame, directors: DataFrame, hot_keys):
    """``"auto"``: ids heavy in the films *or* in the crew rows, each found on
    a sample of its (cheap, column-pruned) id column, not on the joined rows.
    Each list holds at most ``1 / share`` ids, so their union stays small."""
    if not (isinstance(hot_keys, str) and hot_keys == "auto"):
        return hot_keys
    found = [h for h in (find_hot_keys(films, ["imdb_id"]), find_hot_keys(directors, ["imdb_id"]))
             if h is not None]
    if not found:
        return None
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def _finish(metrics: DataFrame, key_algo: str, id_partitions: int | None) -> DataFrame:
    """Row ids and the final column list (shared by both plans)."""
    order = FACT_ID_ORDER + [F.col(c).asc_nulls_first() for c in FACT_ID_LAST]
    numbered = file_row_id(metrics, order, name="fact_id", partitions=id_partitions)
    return numbered.withColumn("movie_id", surrogate_key(F.trim("title"), key_algo)).select(FACT_COLUMNS)


def _join_crew(t: DataFrame, directors: DataFrame, hot, max_broadcast_rows: int):
    """Films LEFT JOIN first directors on imdb_id, as ``(cold, hot)`` frames.

    Without hot ids: one shuffle join (``hot`` is ``None``).  With hot ids
    both inputs are split *before* the join, so the cold shuffle join never
    sees a hot id on either side.  The hot ids' films meet their crew rows in
    a broadcast join when those crew rows are checked few; otherwise as an
    inner join (AQE splits a skewed partition on either side, or both) plus
    the films without any crew row (an anti join against the hot ids that do
    have crew rows: at most the hot-id list).  No join task receives a whole
    hot group.  Splitting after the join would not help: AQE cannot split a
    skewed join partition whose hash partitioning the lag window downstream
    relies on, nor the inner side of a left outer join.
    """
    if hot is None:
        return t.join(directors, "imdb_id", "left"), None
    cold_t, hot_t = split_by_keys(t, ["imdb_id"], hot)
    cold_d, hot_d = split_by_keys(directors, ["imdb_id"], hot)
    cold = cold_t.join(cold_d, "imdb_id", "left")
    if fits(hot_d, max_broadcast_rows):
        return cold, hot_t.join(F.broadcast(hot_d), "imdb_id", "left")
    matched = hot_t.join(hot_d, "imdb_id", "inner")
    with_crew = F.broadcast(hot_d.select("imdb_id").distinct())  # a subset of the hot ids
    alone = hot_t.join(with_crew, "imdb_id", "left_anti")
    return cold, matched.unionByName(alone, allowMissingColumns=True)


def _join_crew_and_lag(t: DataFrame, directors: DataFrame, hot, max_broadcast_rows: int) -> DataFrame:
    """The crew join plus the lag changes: the plain window on the cold rows
    (it reuses the join's hash partitioning), the spread path on hot ids."""
    cold, hot_rows = _join_crew(t, directors, hot, max_broadcast_rows)
    metrics = lag_window(cold, ["imdb_id"], LAG_ORDER, CHANGES)
    if hot_rows is None:
        return metrics
    return metrics.unionByName(lag_spread(hot_rows, ["imdb_id"], LAG_ORDER, CHANGES))


def fact_movie_performance(
    films: DataFrame,
    crew: DataFrame,
    *,
    key_algo: str = KEY_ALGO,
    key_mode: str = "derive",
    dim_genre: DataFrame | None = None,
    dim_production: DataFrame | None = None,
    dim_date: DataFrame | None = None,
    hot_keys="auto",
    id_partitions: int | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    blank_director_as_null: bool = True,
) -> DataFrame:
    """Fact table from bronze films and crew (direct plan).

    ``hot_keys``: ``"auto"`` samples the film ids and the crew ids for groups
    large enough to need splitting (see ``find_hot_keys``); ``None`` uses the
    plain join and window; or pass a small frame of imdb_id values.
    An empty first-director list gives NULL as director key
    (``blank_director_as_null=False`` keeps '' as the model does).
    """
    t = _film_measures(films).withColumns({
        "first_genre": first_item("genres"),
        "first_company": first_item("production_companies"),
    })
    if key_mode == "derive":
        blank_genre = _blank_first_genre_exists(films)
        g, c = F.col("first_genre"), F.col("first_company")
        genre_ok = (g != "") | F.lit(blank_genre)
        t = t.withColumns({
            "genre_id": F.when(genre_ok, surrogate_key(g, key_algo)),
            "production_id": F.when(c != "", surrogate_key(c, key_algo)),
            "date_id": surrogate_key("release_date", key_algo),
        })
    elif key_mode == "join":
        if dim_genre is None or dim_production is None or dim_date is None:
            raise ValueError("key_mode='join' needs dim_genre, dim_production and dim_date")
        sides = {
            "first_genre": dim_genre.select(F.col("genre_name").alias("first_genre"), "genre_id"),
            "first_company": dim_production.select(F.col("production_name").alias("first_company"),
                                                   "production_id"),
            "release_date": dim_date.select(F.col("full_date").alias("release_date"), "date_id"),
        }
        small = fits_all(sides, max_broadcast_rows)  # the three size checks in one job
        for key, dim in sides.items():
            t = t.join(F.broadcast(dim) if small[key] else dim, key, "left")
    else:
        raise ValueError(f"unknown key_mode {key_mode!r}")
    t = t.drop("first_genre", "first_company")

    first_dir = first_item("directors")
    if blank_director_as_null:
        first_dir = F.nullif(first_dir, F.lit(""))
    directors = crew.select(F.col("tconst").alias("imdb_id"), first_dir.alias("director_id"))
    hot = _resolve_hot_keys(films, directors, hot_keys)
    metrics = _join_crew_and_lag(t, directors, hot, max_broadcast_rows)
    return _finish(metrics, key_algo, id_partitions)


def fact_literal(
    films: DataFrame,
    crew: DataFrame,
    dim_genre: DataFrame,
    dim_production: DataFrame,
    dim_date: DataFrame,
    *,
    key_algo: str = KEY_ALGO,
    hot_keys=None,
    id_partitions: int | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """The fact as the model writes it, minus its self-join fan-out.

    Keys are looked up in the given dimensions (fact -> dimension joins,
    size-checked broadcasts) and an empty director list keeps '' as its key.
    The model also re-joins four per-film lookups on imdb_id, which turns n
    copies of an id into n^4 rows: every combination inside a group of copies.
    That product is not reproduced; each film row stays one fact row, so the
    result equals the model wherever imdb_id is unique.
    """
    return fact_movie_performance(
        films, crew, key_algo=key_algo, key_mode="join", dim_genre=dim_genre,
        dim_production=dim_production, dim_date=dim_date, hot_keys=hot_keys,
        id_partitions=id_partitions, max_broadcast_rows=max_broadcast_rows,
        blank_director_as_null=False,
    )

"""Independent SQL formulation of every registered query, for DuckDB.

These texts are the correctness oracle: written directly in SQL from the
model semantics (not generated from the Spark code), over the same test
tables.  The adapter texts of ``sources.adapter`` are pasted as leading CTEs.
Computed columns carry the same names and types as the Spark results.
"""

from __future__ import annotations

from reelhouse.schemas import COLUMN_COMMENTS
from reelhouse.sources.adapter import BASICS_SQL, CREW_SQL, LINE_BREAKS, NAMES_SQL, TMDB_RAW_SQL, TMDB_SRC_SQL

AS_OF = "2024-01-01"  # fixed validity date used by the registered queries
TOP_YEAR = 2000  # release year asked by the top-films reports (dates span 1995-2007)
DIRECTOR_MIN_RATING = 5.0
# Genres shown by the dashboard-slice query (two genres present in the test data).
SLICE_GENRES = ("PROMO", "STANDARD")


def K(expr: str) -> str:
    """60-bit MD5 key of ``expr`` as text (DuckDB)."""
    return f"CAST(('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 15)) AS BIGINT)"


def _first(expr: str, sep: str = ",") -> str:
    return f"trim(split_part({expr}, '{sep}', 1))"


BRONZE_CTES = f"""
tmdb_src AS ({TMDB_SRC_SQL}),
tmdb_f AS ({TMDB_RAW_SQL}),
tmdb_raw AS (
  SELECT coalesce(imdb_id, '') AS imdb_id, coalesce(title, '') AS title, rd AS release_date,
         coalesce(production_companies, '') AS production_companies,
         CAST(budget AS BIGINT) AS budget, CAST(revenue AS BIGINT) AS revenue,
         CAST(vote_average AS FLOAT) AS vote_average, CAST(vote_count AS BIGINT) AS vote_count,
         CAST(runtime AS INTEGER) AS runtime, coalesce(genres, '') AS genres,
         coalesce(original_language, '') AS original_language
  FROM tmdb_f
),
crew_src AS ({CREW_SQL}),
names_src AS ({NAMES_SQL}),
crew_raw AS (SELECT tconst, coalesce(directors, '') AS directors FROM crew_src WHERE tconst IS NOT NULL),
names_raw AS (
  SELECT nconst, coalesce(primaryName, '') AS primaryName, coalesce(primaryProfession, '') AS primaryProfession
  FROM names_src WHERE nconst IS NOT NULL
)"""


def _calendar_select(date_expr: str, strict: bool, by_name: bool = False) -> str:
    d = date_expr
    # by_name: the model's literal weekday tests (short name against full names)
    monday = f"strftime({d}, '%a') = 'Monday'" if by_name else f"isodow({d}) = 1"
    thursday = f"strftime({d}, '%a') = 'Thursday'" if by_name else f"isodow({d}) = 4"
    weekend = f"strftime({d}, '%a') IN ('Saturday', 'Sunday')" if by_name else f"isodow({d}) IN (6, 7)"
    thanksgiving = (
        f"month({d}) = 11 AND {thursday} AND day({d}) BETWEEN 22 AND 28"
        if strict
        else f"month({d}) = 11 AND {thursday} AND week({d}) >= 47"
    )
    holiday = f"""CASE
      WHEN month({d}) = 1 AND day({d}) = 1 THEN 'New Years Day'
      WHEN month({d}) = 2 AND day({d}) = 14 THEN 'Valentines Day'
      WHEN month({d}) = 3 AND day({d}) = 17 THEN 'St. Patricks Day'
      WHEN month({d}) = 4 AND day({d}) = 1 THEN 'April Fools Day'
      WHEN month({d}) = 4 AND day({d}) = 22 THEN 'Earth Day'
      WHEN month({d}) = 5 AND day({d}) = 1 THEN 'May Day'
      WHEN month({d}) = 5 AND day({d}) = 5 THEN 'Cinco de Mayo'
      WHEN month({d}) = 6 AND day({d}) BETWEEN 19 AND 26 THEN 'Midsummer'
      WHEN month({d}) = 7 AND day({d}) = 4 THEN 'Independence Day'
      WHEN month({d}) = 9 AND day({d}) BETWEEN 1 AND 7 AND {monday} THEN 'Labor Day (US)'
      WHEN month({d}) = 10 AND day({d}) = 31 THEN 'Halloween'
      WHEN {thanksgiving} THEN 'Thanksgiving'
      WHEN month({d}) = 12 AND day({d}) = 24 THEN 'Christmas Eve'
      WHEN month({d}) = 12 AND day({d}) = 25 THEN 'Christmas Day'
      WHEN month({d}) = 12 AND day({d}) = 31 THEN 'New Years Eve'
    END"""
    return f"""
  SELECT {K(d)} AS date_id, {d} AS full_date,
         CAST(year({d}) AS INTEGER) AS year, CAST(month({d}) AS INTEGER) AS month,
         CAST(day({d}) AS INTEGER) AS day, CAST(week({d}) AS INTEGER) AS week,
         strftime({d}, '%a') AS weekday,
         CASE WHEN month({d}) IN (12, 1, 2) THEN 'Winter' WHEN month({d}) IN (3, 4, 5) THEN 'Spring'
              WHEN month({d}) IN (6, 7, 8) THEN 'Summer' WHEN month({d}) IN (9, 10, 11) THEN 'Autumn' END AS season,
         CASE WHEN {weekend} THEN 1 ELSE 0 END AS is_weekend,
         {holiday} AS holiday_name,
         CASE WHEN ({holiday}) IS NOT NULL THEN 1 ELSE 0 END AS is_holiday,
         CAST(NULL AS INTEGER) AS days_until_holiday, CAST(NULL AS INTEGER) AS days_after_holiday"""


DIM_CTES = f"""
dim_movie AS (
  SELECT {K('movie_title')} AS movie_id, imdb_id, movie_title, release_date, movie_runtime, language
  FROM (
    SELECT trim(title) AS movie_title, imdb_id, release_date, runtime AS movie_runtime,
           original_language AS language,
           row_number() OVER (PARTITION BY trim(title)
                              ORDER BY imdb_id NULLS FIRST, release_date NULLS FIRST,
                                       runtime NULLS FIRST, original_language NULLS FIRST) AS pick
    FROM tmdb_raw WHERE title IS NOT NULL AND title <> ''
  ) s WHERE pick = 1
),
dim_genre AS (
  SELECT {K('genre_name')} AS genre_id, genre_name
  FROM (SELECT DISTINCT {_first('genres')} AS genre_name FROM tmdb_raw WHERE genres IS NOT NULL AND genres <> '') s
),
dim_production AS (
  SELECT {K('production_name')} AS production_id, production_name, DATE '{AS_OF}' AS valid_from,
         CAST(NULL AS DATE) AS valid_to, TRUE AS is_current
  FROM (SELECT DISTINCT {_first('production_companies')} AS production_name FROM tmdb_raw
        WHERE production_companies IS NOT NULL AND production_companies <> '') s
  WHERE production_name IS NOT NULL AND production_name <> ''
),
dim_director AS (
  SELECT {K('d.director_id')} AS imdb_dir_name_id, d.director_id, n.primaryName AS director_name,
         DATE '{AS_OF}' AS valid_from, CAST(NULL AS DATE) AS valid_to, 1 AS is_current
  FROM (SELECT DISTINCT {_first('directors')} AS director_id FROM crew_raw
        WHERE directors IS NOT NULL AND directors <> '') d
  LEFT JOIN names_raw n ON d.director_id = n.nconst
  WHERE d.director_id IS NOT NULL
),
dim_date AS ({_calendar_select('full_date', False)}
  FROM (SELECT DISTINCT release_date AS full_date FROM tmdb_raw WHERE release_date IS NOT NULL) s
)"""


def _fact_ctes(director_expr: str) -> str:
    return f"""
fact_base AS (
  SELECT t.imdb_id, t.title, t.release_date, t.revenue, t.budget,
         CAST(t.vote_average AS DOUBLE) AS vote_avg, t.vote_count,
         CAST(t.vote_average AS DOUBLE) * ln(1 + CAST(t.vote_count AS DOUBLE)) AS movie_popularity,
         year(t.release_date) AS release_year,
         {director_expr} AS director_id,
         g.genre_id, p.production_id, dd.date_id
  FROM tmdb_raw t
  LEFT JOIN crew_raw c ON c.tconst = t.imdb_id
  LEFT JOIN dim_genre g ON g.genre_name = {_first('t.genres')}
  LEFT JOIN dim_production p ON p.production_name = {_first('t.production_companies')}
  LEFT JOIN dim_date dd ON dd.full_date = t.release_date
),
fact_lag AS (
  SELECT *,
         revenue - lag(revenue) OVER w AS revenue_growth,
         movie_popularity - lag(movie_popularity) OVER w AS popularity_change,
         vote_avg - lag(vote_avg) OVER w AS vote_avg_change
  FROM fact_base
  WINDOW w AS (PARTITION BY imdb_id ORDER BY release_year NULLS LAST, release_date NULLS LAST,
                                             title NULLS LAST, revenue NULLS LAST, director_id NULLS LAST)
),
fact AS (
  SELECT row_number() OVER (ORDER BY imdb_id NULLS LAST, date_id NULLS LAST, director_id NULLS LAST,
                                     genre_id NULLS LAST, production_id NULLS LAST, title NULLS LAST,
                                     revenue NULLS LAST, revenue_growth NULLS FIRST,
                                     popularity_change NULLS FIRST, vote_avg_change NULLS FIRST) AS fact_id,
         {K('trim(title)')} AS movie_id, imdb_id, director_id, genre_id, production_id, date_id,
         vote_avg, vote_count, revenue, budget, movie_popularity,
         revenue_growth, popularity_change, vote_avg_change
  FROM fact_lag
)"""


FACT_CTES = _fact_ctes(f"nullif({_first('c.directors')}, '')")
FACT_LITERAL_CTES = _fact_ctes(_first("c.directors"))

GOLD = f"WITH {BRONZE_CTES},\n{DIM_CTES},\n{FACT_CTES}\n"

FACT_OUT = """fact_id, movie_id, imdb_id, director_id, genre_id, production_id, date_id, vote_avg, vote_count,
       revenue, budget, round(movie_popularity, 6) AS movie_popularity, revenue_growth,
       round(popularity_change, 6) AS popularity_change, vote_avg_change"""

MEASURES_OUT = """f.vote_avg, f.vote_count, f.revenue, f.budget, round(f.movie_popularity, 6) AS movie_popularity,
       f.revenue_growth, round(f.popularity_change, 6) AS popularity_change, f.vote_avg_change"""

STAR = """FROM fact f
LEFT JOIN dim_movie m ON f.imdb_id = m.imdb_id
LEFT JOIN dim_date dt ON f.date_id = dt.date_id
LEFT JOIN dim_director d ON f.director_id = d.director_id
LEFT JOIN dim_genre g ON f.genre_id = g.genre_id
LEFT JOIN dim_production p ON f.production_id = p.production_id"""

RUNTIME_CASE = """CASE WHEN m.movie_runtime <= 60 THEN '0-60 min' WHEN m.movie_runtime <= 90 THEN '61-90 min'
            WHEN m.movie_runtime <= 120 THEN '91-120 min' WHEN m.movie_runtime <= 150 THEN '121-150 min'
            ELSE '151+ min' END"""

YEAR_FILMS = f"""year_films AS (
  SELECT g.genre_name, m.movie_title, f.imdb_id, f.revenue
  FROM fact f JOIN dim_movie m ON f.imdb_id = m.imdb_id JOIN dim_genre g ON f.genre_id = g.genre_id
  WHERE m.release_date >= DATE '{TOP_YEAR}-01-01' AND m.release_date < DATE '{TOP_YEAR + 1}-01-01'
)"""


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    bronze = f"WITH {BRONZE_CTES}\n"
    q["q_tmdb_filter"] = f"""WITH {BRONZE_CTES}
SELECT imdb_id, title, release_date, production_companies, budget, revenue, vote_average,
       original_language, vote_count, runtime, genres, status FROM tmdb_f"""
    q["q_fill_bronze"] = bronze + "SELECT * FROM tmdb_raw"
    q["q_crew_bronze"] = bronze + "SELECT * FROM crew_raw"
    q["q_names_bronze"] = bronze + "SELECT * FROM names_raw"
    dims = f"WITH {BRONZE_CTES},\n{DIM_CTES}\n"
    for name in ("dim_movie", "dim_genre", "dim_director", "dim_production", "dim_date"):
        q[f"q_{name}"] = dims + f"SELECT * FROM {name}"
    q["q_dim_date_literal"] = bronze + f"""SELECT * FROM ({_calendar_select('full_date', False, True)}
  FROM (SELECT DISTINCT release_date AS full_date FROM tmdb_raw WHERE release_date IS NOT NULL) s) c"""
    q["q_calendar_orders"] = (f"SELECT * FROM ({_calendar_select('full_date', False)} FROM "
                              f"(SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date FROM orders) s) c")
    q["q_holidays_strict"] = (f"SELECT * FROM ({_calendar_select('full_date', True)} FROM "
                              f"(SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date FROM orders) s) c")
    q["q_surrogate_key"] = f"SELECT c_custkey, c_name, {K('c_name')} AS name_key FROM customer"
    q["q_popularity"] = bronze + (
        "SELECT imdb_id, vote_count, round(CAST(vote_average AS DOUBLE) * ln(1 + CAST(vote_count AS DOUBLE)), 6) "
        "AS movie_popularity FROM tmdb_raw")
    q["q_bucketize_runtime"] = bronze + (
        f"SELECT imdb_id, runtime, {RUNTIME_CASE.replace('m.movie_runtime', 'runtime')} AS runtime_bucket FROM tmdb_raw")
    q["q_fact_direct"] = GOLD + f"SELECT {FACT_OUT} FROM fact"
    q["q_fact_join_keys"] = q["q_fact_direct"]
    q["q_fact_literal"] = f"WITH {BRONZE_CTES},\n{DIM_CTES},\n{FACT_LITERAL_CTES}\nSELECT {FACT_OUT} FROM fact"
    q["q_row_number"] = ("SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) "
                         "AS row_id FROM lineitem")
    q["q_lag_by_director_year"] = bronze + f"""
SELECT director_id, imdb_id, release_year, revenue,
       revenue - lag(revenue) OVER w AS revenue_growth
FROM (SELECT nullif({_first('c.directors')}, '') AS director_id, t.imdb_id,
             year(t.release_date) AS release_year, t.release_date, t.revenue
      FROM tmdb_raw t JOIN crew_raw c ON c.tconst = t.imdb_id) s
WHERE director_id IS NOT NULL
WINDOW w AS (PARTITION BY director_id ORDER BY release_year NULLS LAST, release_date NULLS LAST, imdb_id NULLS LAST,
                                             revenue NULLS LAST)"""
    q["q_view_full"] = GOLD + f"""SELECT m.movie_title, dt.year AS release_year, d.director_name, g.genre_name,
       p.production_name, {MEASURES_OUT}
{STAR}"""
    q["q_view_limited"] = GOLD + f"""SELECT {K('m.movie_title')} AS movie_title,
       substr(CAST(dt.year AS VARCHAR), 1, 2) || '**' AS release_year,
       split_part(d.director_name, ' ', 1) || ' ' || '*****' AS director_name,
       g.genre_name, p.production_name,
       CASE WHEN f.vote_avg IS NULL OR isnan(f.vote_avg) THEN 'UNKNOWN' WHEN f.vote_avg < 6 THEN 'LOW'
            WHEN f.vote_avg < 8 THEN 'MID' WHEN f.vote_avg >= 8 THEN 'HIGH' ELSE 'UNKNOWN' END AS vote_avg,
       f.vote_count, f.revenue, f.budget, round(f.movie_popularity, 6) AS movie_popularity,
       f.revenue_growth, round(f.popularity_change, 6) AS popularity_change, f.vote_avg_change
{STAR}"""
    q["q_role_projection"] = GOLD + """SELECT director_id, genre_id, production_id, date_id, imdb_id, vote_avg,
       vote_count, revenue, budget, round(movie_popularity, 6) AS movie_popularity, revenue_growth,
       round(popularity_change, 6) AS popularity_change, vote_avg_change FROM fact"""
    q["q_r1_genre_rating"] = GOLD + """SELECT g.genre_name, round(avg(f.vote_avg), 2) AS avg_rating
FROM fact f JOIN dim_genre g ON f.genre_id = g.genre_id GROUP BY g.genre_name"""
    q["q_r2_directors"] = GOLD + f"""SELECT d.director_name, round(avg(f.vote_avg), 2) AS avg_rating,
       round(avg(CAST(f.revenue AS DOUBLE)), 2) AS avg_revenue, count(f.movie_id) AS movie_count
FROM fact f JOIN dim_director d ON f.director_id = d.director_id
GROUP BY d.director_name
HAVING count(f.movie_id) >= 5 AND avg(f.vote_avg) > {DIRECTOR_MIN_RATING} AND avg(CAST(f.revenue AS DOUBLE)) > 10000000
ORDER BY avg_rating DESC, avg_revenue DESC, d.director_name LIMIT 10"""
    q["q_r3_by_year"] = GOLD + """SELECT CAST(year(m.release_date) AS INTEGER) AS release_year,
       round(avg(f.vote_avg), 2) AS avg_rating, round(avg(CAST(f.revenue AS DOUBLE)), 0) AS avg_revenue
FROM fact f JOIN dim_movie m ON f.imdb_id = m.imdb_id GROUP BY 1"""
    q["q_r4_top_films"] = GOLD + f""", {YEAR_FILMS}
SELECT genre_name, CAST(rk AS INTEGER) AS rank, movie_title, imdb_id, revenue FROM (
  SELECT *, row_number() OVER (PARTITION BY genre_name ORDER BY revenue DESC NULLS LAST,
                               movie_title NULLS LAST, imdb_id NULLS LAST) AS rk FROM year_films) s
WHERE rk <= 10"""
    q["q_r4_mode"] = GOLD + f""", {YEAR_FILMS},
title_counts AS (SELECT genre_name, movie_title, count(*) AS n FROM year_films GROUP BY 1, 2),
modes AS (SELECT genre_name, movie_title AS top_movie FROM (
  SELECT *, row_number() OVER (PARTITION BY genre_name ORDER BY n DESC, movie_title) AS rk FROM title_counts) s
  WHERE rk = 1)
SELECT m.genre_name, m.top_movie, x.top_revenue
FROM modes m JOIN (SELECT genre_name, max(revenue) AS top_revenue FROM year_films GROUP BY 1) x
  ON m.genre_name = x.genre_name
ORDER BY x.top_revenue DESC, m.genre_name LIMIT 10"""
    q["q_r5_runtime_bucket"] = GOLD + f"""SELECT {RUNTIME_CASE} AS runtime_bucket, count(f.movie_id) AS movie_count,
       round(avg(CAST(f.revenue AS DOUBLE)), 2) AS avg_revenue
FROM fact f JOIN dim_movie m ON f.imdb_id = m.imdb_id
WHERE m.movie_runtime IS NOT NULL AND f.revenue IS NOT NULL GROUP BY 1"""
    q["q_slice_genre"] = GOLD + f"""SELECT * FROM (SELECT m.movie_title, dt.year AS release_year, d.director_name,
       g.genre_name, p.production_name, {MEASURES_OUT}
{STAR}) v WHERE genre_name IN ({", ".join("'" + g + "'" for g in SLICE_GENRES)})"""
    quality_rows = [
        ("dim_movie", "movie_id", "not_null", "SELECT count(*) FROM dim_movie WHERE movie_id IS NULL"),
        ("dim_genre", "genre_id", "not_null", "SELECT count(*) FROM dim_genre WHERE genre_id IS NULL"),
        ("dim_date", "date_id", "not_null", "SELECT count(*) FROM dim_date WHERE date_id IS NULL"),
        ("dim_production", "production_id", "not_null",
         "SELECT count(*) FROM dim_production WHERE production_id IS NULL"),
        ("fact_movie_performance", "fact_id", "not_null", "SELECT count(*) FROM fact WHERE fact_id IS NULL"),
        ("fact_movie_performance", "movie_id", "not_null", "SELECT count(*) FROM fact WHERE movie_id IS NULL"),
        ("fact_movie_performance", "date_id", "not_null", "SELECT count(*) FROM fact WHERE date_id IS NULL"),
    ]
    for t, c, src in (("dim_movie", "movie_id", "dim_movie"), ("dim_genre", "genre_id", "dim_genre"),
                      ("dim_date", "date_id", "dim_date"), ("dim_production", "production_id", "dim_production"),
                      ("fact_movie_performance", "fact_id", "fact")):
        quality_rows.append((t, c, "unique", f"SELECT count(*) FROM (SELECT {c} FROM {src} WHERE {c} IS NOT NULL "
                                             f"GROUP BY {c} HAVING count(*) > 1) x"))
    q["q_quality_suite"] = GOLD + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", '{r}' AS rule, CAST(({s}) AS BIGINT) AS failures"
        for t, c, r, s in quality_rows
    )
    fks = [
        ("fact_movie_performance", "movie_id", "fact", "dim_movie", "movie_id"),
        ("fact_movie_performance", "date_id", "fact", "dim_date", "date_id"),
        ("fact_movie_performance", "genre_id", "fact", "dim_genre", "genre_id"),
        ("fact_movie_performance", "production_id", "fact", "dim_production", "production_id"),
        ("fact_movie_performance", "director_id", "fact", "dim_director", "director_id"),
        ("dim_director", "director_id", "dim_director", "imdb_name_basics_raw", "nconst"),
    ]
    parts = []
    for child, col, src, parent, pcol in fks:
        psrc = "names_raw" if parent == "imdb_name_basics_raw" else parent
        parts.append(
            f"SELECT '{child}' AS \"table\", '{col}' AS \"column\", 'references {parent}.{pcol}' AS rule, "
            f"CAST((SELECT count(*) FROM {src} ch WHERE ch.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {psrc} pa WHERE pa.{pcol} = ch.{col})) AS BIGINT) AS failures"
        )
    q["q_fk_orphans"] = GOLD + "\nUNION ALL\n".join(parts)
    q["q_snapshot"] = bronze + """SELECT imdb_id, title, CAST(vote_average AS DOUBLE) AS vote_avg,
       CASE WHEN vote_count = floor(vote_count) THEN CAST(vote_count AS INTEGER) END AS vote_count,
       TRY_CAST(release_date AS TIMESTAMP) AS release_date, CAST(revenue AS DOUBLE) AS revenue
FROM tmdb_f
WHERE imdb_id IS NOT NULL AND title IS NOT NULL AND vote_average IS NOT NULL AND vote_count IS NOT NULL
  AND release_date IS NOT NULL AND revenue IS NOT NULL"""
    q["q_sample_first"] = bronze + """SELECT imdb_id, title, revenue FROM tmdb_src
ORDER BY imdb_id NULLS LAST, title NULLS LAST, revenue NULLS LAST LIMIT 5000"""
    q["q_bronze_from_csv"] = q["q_fill_bronze"]
    q["q_crew_from_tsv_gz"] = q["q_crew_bronze"]
    q["q_title_basics_bronze"] = f"""WITH basics_src AS ({BASICS_SQL})
SELECT tconst, coalesce(primaryTitle, '') AS primaryTitle,
       coalesce(CAST(TRY_CAST(startYear AS DOUBLE) AS INTEGER), -1) AS startYear,
       coalesce(CAST(TRY_CAST(runtimeMinutes AS DOUBLE) AS INTEGER), -1) AS runtimeMinutes
FROM basics_src WHERE tconst IS NOT NULL"""
    q["q_snapshot_scan"] = q["q_snapshot"]
    q["q_films_year_partition"] = bronze + f"""SELECT *, CAST(year(release_date) AS INTEGER) AS release_year
FROM tmdb_raw WHERE year(release_date) = {TOP_YEAR}"""
    q["q_latest_run"] = bronze + f"""SELECT imdb_id, title, release_date, production_companies, budget, revenue,
       vote_average, original_language, vote_count, runtime, genres, status, DATE '{AS_OF}' AS run_date
FROM tmdb_f"""
    q["q_clustered_bronze"] = q["q_fill_bronze"]
    q["q_append_columns"] = bronze + """SELECT *, CAST(NULL AS VARCHAR) AS status FROM tmdb_raw
UNION ALL BY NAME
SELECT imdb_id, title, CAST(release_date AS DATE) AS release_date,
       production_companies, CAST(budget AS BIGINT) AS budget, CAST(revenue AS BIGINT) AS revenue,
       CAST(vote_average AS FLOAT) AS vote_average, CAST(vote_count AS BIGINT) AS vote_count,
       CAST(runtime AS INTEGER) AS runtime, genres, original_language, status
FROM tmdb_f"""
    basics = f"basics_src AS ({BASICS_SQL})"
    q["q_load_counts"] = f"""WITH {BRONZE_CTES}, {basics}
SELECT 'tmdb_filtered' AS "table", CAST(count(*) AS BIGINT) AS "rows" FROM tmdb_f
UNION ALL SELECT 'tmdb_raw', count(*) FROM tmdb_raw
UNION ALL SELECT 'imdb_title_crew_raw', count(*) FROM crew_raw
UNION ALL SELECT 'imdb_name_basics_raw', count(*) FROM names_raw
UNION ALL SELECT 'imdb_title_basics_raw', count(*) FROM basics_src WHERE tconst IS NOT NULL"""
    q["q_view_by_name"] = q["q_view_full"]
    q["q_csv_line_breaks"] = bronze + f"""SELECT * REPLACE ({", ".join(f"{x} AS {c}" for c, x in LINE_BREAKS.items())})
FROM tmdb_raw"""
    q["q_rejects"] = f"""WITH tmdb_src AS ({TMDB_SRC_SQL})
SELECT imdb_id, title, reason FROM (
  SELECT imdb_id, title, CASE WHEN imdb_id IS NULL THEN 'no id' WHEN title IS NULL THEN 'no title'
         WHEN TRY_CAST(release_date AS DATE) IS NULL THEN 'no release date'
         WHEN extract(year FROM TRY_CAST(release_date AS DATE)) < 2000 THEN 'too early'
         WHEN lower(coalesce(status, '')) <> 'released' THEN 'status'
         WHEN coalesce(runtime, 0) <= 40 THEN 'too short'
         WHEN isnan(vote_average) OR coalesce(vote_average, 0) <= 0 THEN 'no rating'
         WHEN coalesce(vote_count, 0) <= 0 THEN 'no votes' END AS reason
  FROM tmdb_src) s WHERE reason IS NOT NULL"""
    q["q_replace_table"] = bronze + "SELECT * REPLACE (revenue - budget AS revenue) FROM tmdb_raw"
    q["q_release_switch"] = bronze + """SELECT 'films' AS tbl, 1 AS version, imdb_id AS id FROM tmdb_f
UNION ALL SELECT 'crew', 1, tconst FROM crew_src
UNION ALL SELECT 'films', 2, imdb_id FROM tmdb_raw WHERE vote_count > 3
UNION ALL SELECT 'crew', 2, tconst FROM crew_raw WHERE directors <> ''"""
    q["q_append_stored"] = q["q_append_columns"]
    q["q_view_stored"] = q["q_view_limited"]
    q["q_describe"] = dims + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS tbl, '{c}' AS column_name, '{text}' AS description, count({c}) AS filled FROM {t}"
        for t in ("dim_movie", "dim_genre", "dim_date", "dim_production") for c, text in COLUMN_COMMENTS[t].items())
    q["q_ref_scan"] = q["q_dim_director"]
    q["q_lag_segments"] = """SELECT *, quantity - lag(quantity) OVER w AS quantity_change, cents - lag(cents) OVER w AS cents_change
FROM (SELECT l_suppkey, l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS quantity,
             CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem) s
WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, quantity, cents)"""
    q["q_any_heavy"] = """SELECT t.l_orderkey, m.flags AS heavy, t.n AS rows
FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) t
LEFT JOIN (SELECT l_orderkey, l_returnflag || l_linestatus AS flags, count(*) AS c FROM lineitem GROUP BY 1, 2) m
  ON m.l_orderkey = t.l_orderkey AND 2 * m.c > t.n"""
    return q

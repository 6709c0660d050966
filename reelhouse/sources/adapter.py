"""Bronze-shaped inputs derived from the driver's TPC-H-style test tables.

The real inputs (a film catalogue CSV and three person/title dumps) are not
available offline, so the tests and the registered queries derive raw-shaped
frames from ``orders / lineitem / part / customer / nation``.  The SQL texts
below run unchanged on Spark and DuckDB (the oracle pastes them as CTEs), and
they plant dirty cells on purpose: NULL ids, unparsable dates, empty lists,
mixed-case status, short runtimes, NaN ratings, orders without lines (0 votes),
repeated ids and titles, one heavy id and directors that have no name row.

Every order becomes one raw film row and one crew row, films use every part,
and planted cases are fixed shares of the rows: titles, directors, companies
and repeats grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TESTDATA_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Raw film catalogue, all columns as they would come out of the CSV reader.
TMDB_SRC_SQL = """
SELECT CASE WHEN o.o_orderkey % 97 = 0 THEN NULL
            WHEN o.o_orderkey % 89 = 3 THEN 'tt000000003'
            WHEN o.o_orderkey % 31 = 5 THEN concat('tt', lpad(CAST(o.o_orderkey - 1 AS STRING), 9, '0'))
            ELSE concat('tt', lpad(CAST(o.o_orderkey AS STRING), 9, '0')) END AS imdb_id,
       CASE WHEN o.o_orderkey % 89 = 3 THEN ' Heavy'
            WHEN o.o_orderkey % 10 < 2 THEN concat(' Double Bill ', CAST(o.o_orderkey - o.o_orderkey % 10 AS STRING))
            ELSE concat(' ', p.p_name, ' ', CAST(o.o_orderkey AS STRING)) END AS title,
       CASE WHEN o.o_orderkey % 101 = 0 THEN 'not a date'
            ELSE CAST(CAST(CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 7 AS INTEGER) * INTERVAL '1' YEAR AS DATE)
                      AS STRING) END AS release_date,
       CASE WHEN o.o_orderkey % 59 = 0 THEN ''
            ELSE concat(n.n_name, ' Studio ', CAST(o.o_custkey - o.o_custkey % 10 AS STRING), ', ', cu.c_mktsegment)
            END AS production_companies,
       coalesce(l.ext_cents, 0) AS budget,
       CAST(round(o.o_totalprice * 100) AS BIGINT) AS revenue,
       CASE WHEN o.o_orderkey % 83 = 0 THEN CAST('NaN' AS DOUBLE) ELSE coalesce(l.vote_average, 0.0e0) END AS vote_average,
       CASE o.o_orderkey % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' WHEN 2 THEN 'es' ELSE 'de' END AS original_language,
       coalesce(l.vote_count, 0) AS vote_count,
       p.p_size * 4 AS runtime,
       CASE WHEN o.o_orderkey % 53 = 0 THEN '' ELSE concat(p.p_type, ', ', substr(o.o_orderpriority, 3)) END AS genres,
       CASE o.o_orderstatus WHEN 'F' THEN 'Released' WHEN 'O' THEN 'RELEASED' ELSE 'Post Production' END AS status
FROM (SELECT *, o_orderkey % (SELECT count(*) FROM part) AS part_pick FROM orders) o
JOIN part p ON p.p_partkey = o.part_pick
JOIN customer cu ON cu.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = cu.c_nationkey
LEFT JOIN (SELECT l_orderkey,
                  CAST(count(*) AS BIGINT) AS vote_count,
                  CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / count(*) / 5.0e0 AS vote_average,
                  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS ext_cents
           FROM lineitem GROUP BY l_orderkey) l
  ON l.l_orderkey = o.o_orderkey
"""

# The film quality filter expressed in SQL over tmdb_src (oracle side; the
# Spark side uses ``operators.clean.filter_films``).
TMDB_RAW_SQL = """
SELECT * FROM (SELECT *, TRY_CAST(release_date AS DATE) AS rd FROM tmdb_src) x
WHERE imdb_id IS NOT NULL AND title IS NOT NULL AND rd IS NOT NULL AND extract(year FROM rd) >= 2000
  AND lower(coalesce(status, '')) = 'released' AND coalesce(TRY_CAST(runtime AS DOUBLE), 0) > 40
  AND NOT isnan(TRY_CAST(vote_average AS DOUBLE)) AND coalesce(TRY_CAST(vote_average AS DOUBLE), 0) > 0 AND coalesce(TRY_CAST(vote_count AS DOUBLE), 0) > 0
"""

# Raw film columns with line breaks, quotes and separators inside, as SQL of the
# plain columns: cells that a CSV file has to quote over several lines.
LINE_BREAKS = {
    "title": """CASE WHEN length(title) % 3 = 0 THEN concat(chr(10), title, ', "cut', chr(10), chr(10), '2"')
        WHEN length(title) % 3 = 1 THEN concat('"', title, chr(10)) ELSE title END""",
    "production_companies": """CASE WHEN length(production_companies) % 5 = 0 AND production_companies <> ''
        THEN concat(production_companies, chr(10), '"",', chr(10)) ELSE production_companies END""",
}

# Title -> directors dump (one row per order).
CREW_SQL = """
SELECT concat('tt', lpad(CAST(o_orderkey AS STRING), 9, '0')) AS tconst,
       CASE WHEN o_orderkey % 61 = 0 THEN ''
            ELSE concat('nm', lpad(CAST(o_custkey - o_custkey % 20 AS STRING), 9, '0'), ',nm', lpad(CAST(o_custkey AS STRING), 9, '0')) END AS directors
FROM orders
"""

# Person dump: one row per customer.  The person rows of every tenth first
# director have an id outside the director id space ('nx...'), so those
# directors have no name row (planted orphans) while no row is dropped.
NAMES_SQL = """
SELECT CASE WHEN c_custkey % 200 = 100 THEN concat('nx', lpad(CAST(c_custkey AS STRING), 9, '0'))
            ELSE concat('nm', lpad(CAST(c_custkey AS STRING), 9, '0')) END AS nconst,
       concat(c_mktsegment, ' ', c_name) AS primaryName, 'director' AS primaryProfession
FROM customer
"""


# Title basics dump (no gold consumer; exercises the -1 / '' fills): missing
# titles, missing years and unparsable runtimes are planted.
BASICS_SQL = """
SELECT concat('tt', lpad(CAST(o_orderkey AS STRING), 9, '0')) AS tconst,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE concat('Title ', CAST(o_orderkey AS STRING)) END AS primaryTitle,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL
            ELSE CAST(year(CAST(o_orderdate AS DATE)) AS STRING) END AS startYear,
       CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 240 AS STRING) END AS runtimeMinutes
FROM orders
"""


def read_testdata(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_testdata(spark: SparkSession, sf_dir: str, names=("orders", "lineitem", "part", "customer", "nation")) -> None:
    """Register the given test tables as temp views under their own names."""
    for n in names:
        read_testdata(spark, sf_dir, n).createOrReplaceTempView(n)


class RawInputs:
    """The three raw inputs of the warehouse, derived from one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        register_testdata(spark, sf_dir)
        # spark.sql analyses eagerly, so each frame keeps its own plan even if
        # the temp views are later re-pointed at another folder.
        self.films_src: DataFrame = spark.sql(TMDB_SRC_SQL)
        self.crew_src: DataFrame = spark.sql(CREW_SQL)
        self.names_src: DataFrame = spark.sql(NAMES_SQL)
        self.basics_src: DataFrame = spark.sql(BASICS_SQL)

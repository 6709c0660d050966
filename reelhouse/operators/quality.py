"""Data-quality rules over tables: not-null, unique, foreign key, suite runner.

Each rule gives a row ``(table, column, rule, failures)``:

* not-null: rows whose column is NULL
* unique: values (non-NULL) occurring more than once
* foreign key: child rows whose (non-NULL) value is missing from the parent

``table_rules`` checks all not-null and unique rules of a table in one scan: the
unique columns are grouping sets of one aggregation (an ``Expand``, one row per
column and value after the map-side combine), and the not-null counts ride
along.  ``reference_rules`` does the same for all references of a child table:
its values are counted by (rule, value) in one scan and one exchange, and meet the
parents' distinct keys in one left-anti join.  A value repeated in a large share
of the rows crosses an exchange as one row per task.

``run_suite`` unions the results and raises when any rule fails (if asked).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("rule", T.StringType()),
    T.StructField("failures", T.LongType()),
])

# The column tests of the gold models.
GOLD_TESTS: dict[str, dict[str, list[str]]] = {
    "dim_movie": {"not_null": ["movie_id"], "unique": ["movie_id"]},
    "dim_genre": {"not_null": ["genre_id"], "unique": ["genre_id"]},
    "dim_date": {"not_null": ["date_id"], "unique": ["date_id"]},
    "dim_production": {"not_null": ["production_id"], "unique": ["production_id"]},
    "fact_movie_performance": {"not_null": ["fact_id", "movie_id", "date_id"], "unique": ["fact_id"]},
}

# Declared references between gold tables (child column -> parent key).
GOLD_FOREIGN_KEYS = [
    ("fact_movie_performance", "movie_id", "dim_movie", "movie_id"),
    ("fact_movie_performance", "date_id", "dim_date", "date_id"),
    ("fact_movie_performance", "genre_id", "dim_genre", "genre_id"),
    ("fact_movie_performance", "production_id", "dim_production", "production_id"),
    ("fact_movie_performance", "director_id", "dim_director", "director_id"),
]


def not_null(df: DataFrame, cols: Sequence[str], table: str = "") -> DataFrame:
    """NULL count per column, all columns in a single aggregation."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(table).alias("table"), F.lit(c).alias("column"), F.lit("not_null").alias("rule"),
                 F.col(c).cast("bigint").alias("failures"))
        for c in cols
    ])).alias("r")).select("r.*")


def unique(df: DataFrame, col: str, table: str = "") -> DataFrame:
    """Number of distinct non-NULL values of ``col`` that occur more than once."""
    dup = df.filter(F.col(col).isNotNull()).groupBy(col).count().filter(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit(table).alias("table"), F.lit(col).alias("column"), F.lit("unique").alias("rule"), "failures"
    )


def foreign_key(child: DataFrame, col: str, parent: DataFrame, pcol: str, table: str = "",
                parent_table: str = "") -> DataFrame:
    """Child rows whose non-NULL ``col`` has no match in ``parent.pcol``."""
    keys = parent.select(F.col(pcol).alias("__pk")).distinct()
    # Child rows are counted per key first (map-side), so a key repeated in a
    # large share of the child rows crosses the shuffle as one row.
    per_key = child.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("__n"))
    orphans = per_key.join(keys, F.col(col) == F.col("__pk"), "left_anti")
    rule = f"references {parent_table}.{pcol}" if parent_table else f"references {pcol}"
    return orphans.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("failures")).select(
        F.lit(table).alias("table"), F.lit(col).alias("column"), F.lit(rule).alias("rule"), "failures"
    )


def _rows(totals: DataFrame, table: str, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """One row of numbers ``r0, r1, ...`` as one result row per rule (column, rule)."""
    structs = [F.struct(F.lit(table).alias("table"), F.lit(c).alias("column"), F.lit(rule).alias("rule"),
                        F.coalesce(F.col(f"r{i}"), F.lit(0)).cast("bigint").alias("failures")) for i, (c, rule) in enumerate(rules)]
    return totals.select(F.inline(F.array(*structs)))


def table_rules(df: DataFrame, table: str = "", not_null: Sequence[str] = (), unique: Sequence[str] = ()) -> DataFrame:
    """All not-null and unique rules of one table in one scan of it."""
    rules = [(c, "not_null") for c in not_null] + [(c, "unique") for c in unique]
    if not unique:
        totals = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"r{i}") for i, c in enumerate(not_null)])
        return _rows(totals, table, rules)
    keys = [F.col(c).alias(f"u{j}") for j, c in enumerate(unique)]
    nulls = [F.col(c).isNull().alias(f"n{i}") for i, c in enumerate(not_null)]
    src = df.select(*keys, *nulls)
    sets = [[F.col(f"u{j}")] for j in range(len(unique))]
    groups = src.groupingSets(sets, *[F.col(f"u{j}") for j in range(len(unique))]).agg(
        F.grouping_id().alias("which"), F.count(F.lit(1)).alias("copies"),
        *[F.count_if(F.col(f"n{i}")).alias(f"n{i}") for i in range(len(not_null))])
    # the bits of a grouping id name the columns that are not grouped by, the first column's the highest
    top = len(unique) - 1
    ids = [(1 << len(unique)) - 1 - (1 << (top - j)) for j in range(len(unique))]
    totals = groups.agg(
        *[F.sum(F.when(F.col("which") == ids[0], F.col(f"n{i}"))).alias(f"r{i}") for i in range(len(not_null))],
        *[F.count_if((F.col("which") == ids[j]) & F.col(f"u{j}").isNotNull() & (F.col("copies") > 1)).alias(f"r{len(not_null) + j}")
          for j in range(len(unique))])
    return _rows(totals, table, rules)


def reference_rules(child: DataFrame, table: str, references: Sequence[tuple[str, str, str, DataFrame]]) -> DataFrame:
    """All references (column, parent table, parent column, parent) of one child table in one scan of it."""
    def tagged(i: int, c: str) -> Column:
        return F.struct(F.lit(i).alias("rule"), F.col(c).cast("string").alias("key"))

    values = child.select(F.inline(F.array(*[tagged(i, c) for i, (c, *_) in enumerate(references)])))
    counted = values.filter(F.col("key").isNotNull()).groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n"))
    keys = _union(p.select(F.lit(i).alias("rule"), F.col(pc).cast("string").alias("key")) for i, (_, _, pc, p) in enumerate(references))
    orphans = counted.join(keys.distinct(), ["rule", "key"], "left_anti")
    totals = orphans.agg(*[F.sum(F.when(F.col("rule") == i, F.col("n"))).alias(f"r{i}") for i in range(len(references))])
    return _rows(totals, table, [(c, f"references {pt}.{pc}") for c, pt, pc, _ in references])


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table as ``(table, rows)``: one counting pass per table, no
    shuffle beyond the single partial count each task sends.  For counts of a
    table being written, attach an ``Observation`` to the write instead."""
    return _union(
        df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    )


def suite(tables: dict[str, DataFrame], tests=GOLD_TESTS, foreign_keys=()) -> DataFrame:
    """All rules as one result frame (lazy; one small row per rule)."""
    frames = [table_rules(tables[name], name, rules.get("not_null", ()), rules.get("unique", ()))
              for name, rules in tests.items() if name in tables and (rules.get("not_null") or rules.get("unique"))]
    references: dict[str, list] = {}
    for child, col, parent, pcol in foreign_keys:
        if child in tables and parent in tables:
            references.setdefault(child, []).append((col, parent, pcol, tables[parent]))
    frames += [reference_rules(tables[child], child, found) for child, found in references.items()]
    return _union(frames)


class QualityError(AssertionError):
    pass


def run_suite(tables: dict[str, DataFrame], tests=GOLD_TESTS, foreign_keys=(), fail: bool = True) -> list:
    """Evaluate the suite; raise ``QualityError`` listing failed rules when ``fail``.

    The collected result has one row per rule (bounded by the rule count).
    """
    rows = suite(tables, tests, foreign_keys).collect()
    bad = [r for r in rows if r["failures"] > 0]
    if fail and bad:
        raise QualityError("; ".join(f"{r['table']}.{r['column']} {r['rule']}: {r['failures']}" for r in bad))
    return rows


def describe(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column descriptions as field metadata (``comment``), values unchanged."""
    return df.select([
        F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c)
        for c in df.columns
    ])

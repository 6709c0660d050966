"""Per-role read policy: which tables and columns a role may select.

Open-source Spark has no column-level grants, so this is a projection helper
(applied by the serving layer), not a security boundary.  ``"*"`` grants all
columns of a table; a table missing from the role's entry is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# The grants of the two analyst roles, as published.
REFERENCE_POLICY: dict[str, dict[str, list[str] | str]] = {
    "analyst_limited": {
        "fact_movie_performance": [
            "vote_avg", "vote_count", "revenue", "budget", "movie_popularity", "revenue_growth",
            "popularity_change", "vote_avg_change", "date_id", "director_id", "genre_id",
            "imdb_id", "production_id",
        ],
        "dim_movie": ["movie_title", "imdb_id"],
        "dim_date": ["year", "date_id"],
        "dim_director": ["director_name", "director_id"],
        "dim_genre": ["genre_name", "genre_id"],
        "dim_production": ["production_name", "production_id"],
        "analytical_view_limited": "*",
    },
    "analyst_full": {
        "fact_movie_performance": "*",
        "dim_movie": "*",
        "dim_date": "*",
        "dim_director": "*",
        "dim_genre": "*",
        "dim_production": "*",
        "analytical_view_full": "*",
        "analytical_view_limited": "*",
    },
}

# Stricter default: the raw columns behind the masks are not granted to the
# limited role, so it can only read the pseudonymised view.
STRICT_POLICY: dict[str, dict[str, list[str] | str]] = {
    "analyst_limited": {"analytical_view_limited": "*"},
    "analyst_full": dict(REFERENCE_POLICY["analyst_full"]),
}


class AccessDenied(PermissionError):
    pass


def allowed_columns(df: DataFrame, table: str, role: str, policy=STRICT_POLICY) -> list[str]:
    grants = policy.get(role)
    if grants is None:
        raise AccessDenied(f"unknown role {role!r}")
    cols = grants.get(table)
    if cols is None:
        raise AccessDenied(f"role {role!r} may not read {table!r}")
    if cols == "*":
        return list(df.columns)
    return [c for c in df.columns if c in set(cols)]


def project_for_role(df: DataFrame, table: str, role: str, policy=STRICT_POLICY) -> DataFrame:
    """``df`` restricted to the columns ``role`` may read on ``table`` (table order)."""
    return df.select(allowed_columns(df, table, role, policy))

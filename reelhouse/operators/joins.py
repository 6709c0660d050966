"""Join helpers: size-checked broadcast and semi-join reduction.

A side is broadcast only after its row count has been checked against a cap
(``fits``: a plain count, one number per task; on a written table it reads
Parquet row counts, no column data).  Beyond the cap the join stays a shuffle
join, and AQE may still convert it at runtime from real shuffle sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows allowed on a broadcast side (a few narrow columns: tens of MB).
DEFAULT_BROADCAST_ROWS = 1_000_000


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (partial counts, no rows moved)."""
    return df.count() <= max_rows


def fits_all(frames: dict[str, DataFrame], max_rows: int) -> dict[str, bool]:
    """``fits`` for several frames in one job: a union of their counts
    (one small row per frame reaches the driver)."""
    counts = None
    for name, df in frames.items():
        c = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("frame"), "n")
        counts = c if counts is None else counts.unionByName(c)
    if counts is None:
        return {}
    return {r["frame"]: r["n"] <= max_rows for r in counts.collect()}


def reduce_then_left_join(
    keys: DataFrame,
    big: DataFrame,
    key_col: str,
    big_col: str,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """``keys LEFT JOIN big ON keys.key_col = big.big_col`` for a very large ``big``.

    ``keys`` holds distinct key values.  The left join is computed as the
    inner join plus the keys without any match (an anti join against the
    distinct matched keys), because a skewed key on ``big``'s side, the inner
    side of a left outer join, can be split neither by AQE nor by a broadcast
    of ``keys``:

    * keys checked small: ``big`` streams through a broadcast inner join
      against the keys (no shuffle of ``big`` at all); its matched key values
      are at most the keys, so their distinct list is broadcast for the anti
      join.
    * otherwise: one shuffle inner join, whose skewed partitions AQE splits on
      either side, and an anti join against ``big``'s distinct key values
      (map-side partial aggregation, so a hot key costs one row per task).
    """
    if key_col == big_col:
        raise ValueError("key_col and big_col must have different names")
    on = F.col(key_col) == F.col(big_col)
    present = big.filter(F.col(big_col).isNotNull())
    if fits(keys, max_broadcast_rows):
        matched = present.join(F.broadcast(keys), on, "inner")
        found = F.broadcast(matched.select(F.col(big_col).alias("__k")).distinct())
    else:
        matched = keys.join(present, on, "inner")
        found = present.select(F.col(big_col).alias("__k")).distinct()
    alone = keys.join(found, F.col(key_col) == F.col("__k"), "left_anti")
    return matched.select(*keys.columns, *big.columns).unionByName(alone, allowMissingColumns=True)

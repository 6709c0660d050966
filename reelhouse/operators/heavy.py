"""The value held by more than half of a group's rows, from a mergeable summary of constant size.

``any_heavy`` answers what a frequent-value aggregate approximates: a group's
majority value, exactly where one exists.  The summary is 16 counters per
group: how many of its values' hashes have each bit set.  Counters add up, so
every task sends one row per group however many values there are and however
hot a group is.  If one value holds more than half of the rows, it holds the
majority of every bit, so the majority bits spell its hash.  A second scan counts
the rows whose hash is the one spelled, by value, and keeps the value if they are
indeed more than half.  The result is exact for any number of bits: values that
share a hash are counted apart.  16 bits leave one in 65,536 of a hot group's
other values to count, and small groups cost little more than their keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.operators.joins import DEFAULT_BROADCAST_ROWS, fits

BITS = 16  # a counter each; tables of many small groups shuffle little else


def any_heavy(df: DataFrame, keys: Sequence[str], value: str, out: str = "heavy",
              max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """keys, ``out`` and ``rows`` of every group: the non-NULL value of more than half of its rows, or NULL.

    Rows whose value is NULL count as rows.  Key columns may be NULL (one group).
    """
    low = F.xxhash64("__value").bitwiseAND(F.lit((1 << BITS) - 1).cast("bigint"))
    rows = df.select(*keys, F.col(value).alias("__value")).withColumn("__hash", F.when(F.col("__value").isNotNull(), low))
    bit = [F.sum(F.shiftrightunsigned("__hash", b).bitwiseAND(F.lit(1))).alias(f"__b{b}") for b in range(BITS)]
    summary = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *bit)
    spelled = reduce(lambda x, y: x.bitwiseOR(y),
                     [F.when(2 * F.col(f"__b{b}") > F.col("rows"), F.shiftleft(F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))
                      for b in range(BITS)])
    groups = summary.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "rows", spelled.alias("__spelled"))
    side = groups.drop("rows")
    side = F.broadcast(side) if fits(side, max_broadcast_rows) else side
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    met = rows.join(side, [*same, F.col("__hash") == F.col("__spelled")], "inner")
    # values of one hash are candidates of their own; at most one of them is a majority
    counted = met.groupBy(*keys, "__value").agg(F.count(F.lit(1)).alias("__n"))
    found = groups.join(counted, [*same, 2 * F.col("__n") > F.col("rows")], "left")
    return found.select(*[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)], F.col("__value").alias(out), "rows")

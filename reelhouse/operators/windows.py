"""Ordered operators: change vs previous row, global row ids, top rows.

``dense_row_id`` is the distributed replacement for ``row_number() OVER
(ORDER BY ...)`` without PARTITION BY, which Spark would run in a single task.
It range-partitions on the full ordering key (hot keys spread over several
ranges, because the tiebreak columns are part of the key), checkpoints the
ranged data to the reliable checkpoint folder so its boundaries can never move
between the two passes (even if executors are lost), counts the rows of each
range (one number per partition reaches the driver) and numbers rows as
range offset + position inside the range.  ``file_row_id`` gives the same
numbers from the sorted ranges written as a Parquet table: offsets from the
files' footers, positions from the scan.

``lag_delta`` is ``x - lag(x)`` per group: a plain window for ordinary groups
(``lag_window``) and, for the few groups ``find_hot_keys`` reports, a path
that never holds a group in one task (``lag_spread``); ``split_by_keys``
separates the two with broadcast joins against the bounded hot-key list.
``top_k_per_group`` and ``top_n`` keep the first rows per group / overall with
partial limits before every shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.session import ensure_checkpoint_dir
from reelhouse.sources.scratch import settled

# Upper bound on a hot-key list that split_by_keys broadcasts; a longer one
# meets the rows in a shuffle join.
MAX_HOT_KEYS = 10_000


def _asc(c) -> Column:
    """Ascending, NULLs last (the warehouse's ordering convention)."""
    if isinstance(c, Column):
        return c
    return F.col(c).asc_nulls_last()


def dense_row_id(
    df: DataFrame,
    order: Sequence,
    name: str = "row_id",
    partitions: int | None = None,
    start: int = 1,
) -> DataFrame:
    """Add ``name`` = 1-based position of each row in the global ``order``.

    Equal to ``row_number() OVER (ORDER BY order)``.  Ties are numbered in an
    arbitrary order, fixed once the ranges are checkpointed; add a unique
    tiebreak column for run-to-run determinism.  Columns of ``order`` given
    as names sort ascending with NULLs last.

    Rows tied on the whole ``order`` (copies) are broken by their scan
    position, so even a group of copies holding a large share of the rows is
    spread over several ranges instead of landing in one task.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    tie = "__scan_pos"
    keys = [_asc(c) for c in order] + [F.col(tie).asc()]
    src = df.withColumn(tie, F.monotonically_increasing_id())
    ranged = src.repartitionByRange(partitions, *keys) if partitions else src.repartitionByRange(*keys)
    ranged = ranged.sortWithinPartitions(*keys).drop(tie)
    # Reliable checkpoint: the ranges and their row order are fixed on shared
    # storage, so both passes below see exactly the same partitions.
    fixed = ranged.checkpoint(eager=True)
    counts = fixed.groupBy(F.spark_partition_id().alias("pid")).count().collect()
    if not counts:
        return fixed.withColumn(name, F.lit(None).cast("bigint"))
    per_part = dict((r["pid"], r["count"]) for r in counts)
    offsets, acc = [], 0
    for p in range(max(per_part) + 1):
        offsets.append((p, acc))
        acc += per_part.get(p, 0)
    # One (partition, offset) row per range: bounded by the partition count,
    # not by the data, so it is broadcast; the join keeps each row in place.
    offs = spark.createDataFrame(offsets, "__pid int, __off bigint")
    pid = F.spark_partition_id()
    # monotonically_increasing_id = (partition index << 33) + position in partition
    located = fixed.withColumns({
        "__pid": pid,
        "__pos": F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33),
    })
    out = located.join(F.broadcast(offs), "__pid", "inner")
    return out.withColumn(name, F.col("__off") + F.col("__pos") + F.lit(start).cast("bigint")).drop(
        "__pid", "__pos", "__off")


def file_row_id(
    df: DataFrame,
    order: Sequence,
    name: str = "row_id",
    partitions: int | None = None,
    start: int = 1,
) -> DataFrame:
    """:func:`dense_row_id` off a written table: one Parquet write of the sorted ranges, no pass to count them.

    The row counts come from the files' footers and a row's place in its file
    from the scan, so the result reads like any table (by column, split by size);
    ``dense_row_id`` keeps each range as one partition.  Ties are numbered in an
    arbitrary order, fixed once the ranges are written; add a unique tiebreak
    column for run-to-run determinism.  Columns of ``order`` given as names sort
    ascending with NULLs last.

    Rows tied on the whole ``order`` (copies) are broken by their scan
    position, so even a group of copies holding a large share of the rows is
    spread over several ranges instead of landing in one task.
    """
    spark = df.sparkSession
    tie = "__scan_pos"
    keys = [_asc(c) for c in order] + [F.col(tie).asc()]
    src = df.withColumn(tie, F.monotonically_increasing_id())
    ranged = src.repartitionByRange(partitions, *keys) if partitions else src.repartitionByRange(*keys)
    fixed = settled(ranged.sortWithinPartitions(*keys).drop(tie))
    # row counts come from the footers; a file's name holds its range's number, then its own
    names = fixed.select(F.col("_metadata.file_name").alias("file")).groupBy("file").count().collect()
    if not names:
        return fixed.withColumn(name, F.lit(None).cast("bigint"))
    offsets, acc = [], start
    for r in sorted(names, key=lambda r: [int(x) for x in re.fullmatch(r"part-(\d+)-.*?-c(\d+)\D.*", r["file"]).groups()]):
        offsets.append((r["file"], acc))
        acc += r["count"]
    # One (file, offset) row per range: bounded by the partition count, not by
    # the data, so it is broadcast; the join keeps each row in place.
    offs = spark.createDataFrame(offsets, "__file string, __off bigint")
    located = fixed.withColumns({"__file": F.col("_metadata.file_name"), "__pos": F.col("_metadata.row_index")})
    out = located.join(F.broadcast(offs), "__file", "inner")
    return out.withColumn(name, F.col("__off") + F.col("__pos")).drop("__file", "__pos", "__off")


def lag_delta(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence,
    cols: dict[str, str],
    hot_keys: DataFrame | None = None,
) -> DataFrame:
    """Add ``out = col - lag(col, 1) OVER (PARTITION BY keys ORDER BY order)``.

    ``cols`` maps input column -> output column.  The first row of a group gets
    NULL (no previous row).  ``order`` must be a total order inside each group
    for a deterministic result.

    ``hot_keys`` (a small frame of key values, e.g. from
    :func:`find_hot_keys`) routes those groups through the skew-safe path
    (:func:`lag_spread`), so no single task receives a whole hot group.  Other
    groups use a plain window, which reuses an existing hash partitioning on the
    keys.
    """
    if hot_keys is None:
        return lag_window(df, keys, order, cols)
    cold, hot = split_by_keys(df, keys, hot_keys)
    return lag_window(cold, keys, order, cols).unionByName(lag_spread(hot, keys, order, cols))


def bounded_keys(hot_keys: DataFrame, keys: Sequence[str], limit: int = MAX_HOT_KEYS) -> DataFrame:
    """Distinct ``keys`` of ``hot_keys``, marked for broadcast if at most ``limit`` of them exist."""
    hk = hot_keys.select(*keys).distinct()
    return F.broadcast(hk) if hk.count() <= limit else hk


def split_by_keys(df: DataFrame, keys: Sequence[str], hot_keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(cold, hot)``: the rows whose ``keys`` are not / are among ``hot_keys``.

    Both halves join the size-checked key list; broadcast, the split moves no
    data.  A NULL key matches a NULL hot key.
    """
    hk = bounded_keys(hot_keys, keys)
    cond = [df[k].eqNullSafe(hk[k]) for k in keys]
    return df.join(hk, cond, "left_anti"), df.join(hk, cond, "left_semi")


def lag_window(df: DataFrame, keys: Sequence[str], order: Sequence, cols: dict[str, str]) -> DataFrame:
    """Plain window form of :func:`lag_delta` (each key group in one task)."""
    w = Window.partitionBy(*keys).orderBy(*[_asc(c) for c in order])
    return df.withColumns({out: F.col(c) - F.lag(c, 1).over(w) for c, out in cols.items()})


def lag_spread(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: dict[str, str]) -> DataFrame:
    """Skew-safe form of :func:`lag_delta`, meant for a few very large groups.

    The rows are range-partitioned by (keys, order), which cuts even one huge
    group into many segments, and written once with their segment's number.
    Each segment takes the plain lag, with one row carried over in front: the
    last row of the group's segment before it.  Those boundary rows are one per
    group and segment.  No row meets another in a join.
    """
    tie, seg, carried = "__tie", "__segment", "__carried"
    sort = [_asc(c) for c in order] + [F.col(tie).asc()]
    src = df.withColumn(tie, F.monotonically_increasing_id())
    ranged = src.repartitionByRange(*[_asc(k) for k in keys], *sort)
    rows = settled(ranged.withColumn(seg, F.spark_partition_id()))
    place = F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))], F.col(tie))  # NULLs last, as the order has them
    lasts = rows.groupBy(*keys, seg).agg(F.max_by(F.struct(*cols), place).alias("__last"))
    following = F.lead(seg).over(Window.partitionBy(*keys).orderBy(seg))
    fronts = lasts.withColumn(seg, following).filter(F.col(seg).isNotNull())
    fronts = fronts.select(*keys, seg, *[F.col("__last")[c].alias(c) for c in cols], F.lit(True).alias(carried))
    both = rows.withColumn(carried, F.lit(False)).unionByName(fronts, allowMissingColumns=True)
    w = Window.partitionBy(*keys, seg).orderBy(F.col(carried).desc(), *sort)
    changed = both.withColumns({o: F.col(c) - F.lag(c, 1).over(w) for c, o in cols.items()})
    return changed.filter(~F.col(carried)).drop(tie, seg, carried)


def find_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    share: float | None = None,
    sample_fraction: float = 0.001,
    min_rows: int = 1_000_000,
    seed: int = 7,
) -> DataFrame | None:
    """Key values holding more than ``share`` of the rows, or ``None``.

    Without a ``share`` it is that of one shuffle partition: a key with more
    rows than an average partition is what a task would notice.

    One job over a Bernoulli sample of the key columns only (a pruned scan;
    nothing is persisted): a ``rollup`` counts the sampled rows per key and,
    in the same pass, in total.  Counts combine map-side, so a hot key costs
    one partial row per task.  Only the total and the heaviest keys reach the
    driver, through an ordered limit: at most ``1 / share`` keys can hold more
    than ``share`` of the rows, so the returned frame is small by construction
    and safe to broadcast.  A key must also hold an estimated ``min_rows``
    rows, since smaller groups fit one task anyway; choose ``sample_fraction``
    so that ``min_rows * sample_fraction`` is a few hundred rows or more.
    """
    spark = df.sparkSession
    if share is None:
        share = 1 / max(100, int(spark.conf.get("spark.sql.shuffle.partitions")))
    total_level = (1 << len(keys)) - 1  # grouping_id of the grand-total row
    counts = (
        df.select(*keys).sample(fraction=sample_fraction, seed=seed)
        .rollup(*keys).agg(F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__g"))
    )
    per_key = (F.col("__g") == 0) & (F.col("__n") >= F.lit(min_rows * sample_fraction))
    rows = (
        counts.filter((F.col("__g") == total_level) | per_key)
        .orderBy(F.col("__n").desc())
        .limit(int(1 / share) + 2)  # the total row first, then the heaviest keys
        .collect()
    )
    n = next((r["__n"] for r in rows if r["__g"] == total_level), 0)
    hot = [tuple(r[k] for k in keys) for r in rows if r["__g"] == 0 and r["__n"] > n * share]
    if not hot:
        return None
    return spark.createDataFrame(hot, schema=df.select(*keys).schema)


def top_k_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank_col: str = "rank",
) -> DataFrame:
    """Rows ranked 1..k inside each group by ``order`` (give a unique tiebreak).

    Spark plans this as a partial ``WindowGroupLimit`` before the shuffle, so a
    hot group sends at most ``k`` rows per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def top_n(df: DataFrame, order: Sequence[Column], n: int, fan_in: int = 1024) -> DataFrame:
    """The first ``n`` rows of ``df`` in ``order`` (give a unique tiebreak).

    ``orderBy(order).limit(n)`` alone plans as ``TakeOrderedAndProject``,
    whose final merge pulls ``n`` rows from *every* input partition into one
    task: a number that grows with the input.  Here the input partitions are
    first dealt into ``fan_in`` groups, each reduced to its first ``n`` rows
    (partial ``WindowGroupLimit`` in every map task, then once more per
    group), so a group task receives about ``partitions / fan_in * n`` rows
    and the final merge at most ``fan_in * n``.
    """
    g, r = "__topn_group", "__topn_rank"
    grouped = df.withColumn(g, F.spark_partition_id() % F.lit(fan_in))
    firsts = top_k_per_group(grouped, [g], order, n, r).drop(g, r)
    return firsts.orderBy(*order).limit(n)

"""Splittable reading of CSV files whose quoted cells hold line breaks.

Spark's ``multiLine`` parser reads each file in one task.  Here a file is read
as text lines by many tasks, and the lines that belong to one record are put
together afterwards:

1. A line starts either outside of quotes (a new record) or inside a quoted cell.
   For both cases a fold over the text between its quotes gives the state at its
   end, so a line is a function of one bit; the functions of a split's lines are
   composed to that of the split (one narrow row per split).
2. Composing the splits' functions in file order gives each split's start, and
   with it which splits hold a record of several lines or a part of one.
3. Lines of all other splits are records as they are and stay where they were
   read.  Lines of those splits are dealt by split, numbered by a running count
   of record starts and joined; what a split's first lines continue goes to the
   split where that record starts.

A quote opens a cell only as its first character, doubled quotes inside a quoted
cell stand for one, and other quotes are text, as Spark's parser reads them.
Splits and their order come from the scan itself (``_metadata``), so executors may
be lost at any time.  Line ends are ``\\n`` or ``\\r\\n``, inside cells both are read
as ``\\n``.  A file that ends inside quotes raises ``OpenQuoteError``
(or, if asked, its last record takes the rest of the file).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelhouse.operators.joins import DEFAULT_BROADCAST_ROWS, fits
from reelhouse.session import ensure_checkpoint_dir

CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
SPLIT = ["file", "split"]


class OpenQuoteError(ValueError):
    pass


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, split (its first byte), pos (order inside the split) and text of every line."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("pos"), F.regexp_replace("value", "\r\\z", "").alias("line"))


def ends_inside(line: Column, inside: bool) -> Column:
    """1 if a line that starts inside (outside of) quotes ends inside them.

    The line is cut at its quotes; a fold over the texts before each quote keeps
    0 plain text, 1 quoted, 2 just after a closing quote, 3 the record's start.
    """
    parts = F.split(line, '"', -1)
    before = F.slice(parts, 1, F.size(parts) - 1)
    new_cell = lambda x: F.endswith(x, F.lit(","))
    step = lambda s, x: (
        F.when(s == 1, 2)
        .when(((s == 2) | (s == 3)) & (x == ""), 1)
        .when((s != 1) & new_cell(x), 1)
        .otherwise(0))
    state = F.aggregate(before, F.lit(1 if inside else 3), step)
    same = F.lit(1 if inside else 0)
    return F.when(F.contains(line, F.lit('"')), (state == 1).cast("int")).otherwise(same)


def with_ends(lines: DataFrame) -> DataFrame:
    """Lines with their state at the end when started outside (``e0``) and inside (``e1``) of quotes."""
    return lines.withColumns({"e0": ends_inside(F.col("line"), False), "e1": ends_inside(F.col("line"), True)})


def split_table(lines: DataFrame) -> DataFrame:
    """One row per split: its start state, whether it holds parts of records, the split where its first lines' record starts."""
    moved = F.when((F.col("e0") != 0) | (F.col("e1") != 1), F.struct("pos", "e0", "e1"))
    splits = with_ends(lines).groupBy(*SPLIT).agg(
        F.sort_array(F.collect_list(moved)).alias("moves"), F.max("pos").alias("last"),
        F.min(F.when(~blank("line"), F.col("pos"))).alias("first"))

    def fold(start: int) -> Column:
        """End state, whether a line ended inside, whether a record starts in the split."""
        zero = F.struct(F.lit(start).alias("at"), F.lit(False).alias("open"), F.lit(start == 0).alias("starts"))

        def step(s, x):
            at = F.when(s["at"] == 0, x["e0"]).otherwise(x["e1"])
            return F.struct(at.alias("at"), (s["open"] | (at == 1)).alias("open"),
                            (s["starts"] | ((at == 0) & (x["pos"] < F.col("last")))).alias("starts"))

        return F.aggregate("moves", zero, step)

    splits = splits.select(*SPLIT, "first", fold(0).alias("f0"), fold(1).alias("f1"))
    # numbers per split only, so a file's splits fit in one task
    w = Window.partitionBy("file").orderBy("split")
    known = with_start(splits.select(*SPLIT, "first", "f0", "f1", F.col("f0.at").alias("e0"), F.col("f1.at").alias("e1")), w, F.lit(0))
    f = F.when(F.col("inside") == 0, F.col("f0")).otherwise(F.col("f1"))
    known = known.select(*SPLIT, "first", F.col("inside").alias("start"), f.alias("f"))
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    return known.select(
        *SPLIT, "first", "start", ((F.col("start") == 1) | F.col("f.open")).alias("mixed"),
        F.last(F.when(F.col("f.starts"), F.col("split")), ignorenulls=True).over(earlier).alias("owner"),
        ((F.col("f.at") == 1) & F.lead("split").over(w).isNull()).alias("unclosed"))


def with_start(rows: DataFrame, w, start: Column) -> DataFrame:
    """``inside``: state before each row of the ordered window, earlier rows being functions ``e0``, ``e1`` of one bit.

    A row that ends alike from both states fixes the state; each row since that
    swaps it (the difference of two running counts) turns it over.
    """
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("swaps", F.sum((F.col("e0") > F.col("e1")).cast("int")).over(w))
    fixed = F.when(F.col("e0") == F.col("e1"), F.struct(F.col("e0").alias("at"), "swaps"))
    rows = rows.withColumns({"fixed": F.last(fixed, ignorenulls=True).over(earlier),
                             "seen": F.coalesce(F.lag("swaps").over(w), F.lit(0))})
    since = F.col("seen") - F.coalesce(F.col("fixed.swaps"), F.lit(0))
    return rows.withColumn("inside", ((F.coalesce(F.col("fixed.at"), start) + since) % 2).cast("int")).drop("swaps", "fixed", "seen")


def in_order(place: str, text: str) -> Column:
    """Aggregate: texts joined by line breaks in the order of their places."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(place).alias("place"), F.col(text).alias("text"))))
    return F.array_join(F.transform(pairs, lambda x: x["text"]), "\n")


def blank(line: str) -> Column:
    return F.trim(F.regexp_replace(line, "\\r", "")) == ""


def whole_records(lines: DataFrame, mixed: DataFrame) -> DataFrame:
    """Text of the records that start in the ``mixed`` splits, and whether it is its file's first."""
    w = Window.partitionBy(*SPLIT).orderBy("pos")
    # join, running counts and grouping share one exchange by split
    rows = with_start(with_ends(lines).join(mixed, SPLIT), w, F.col("start"))
    numbered = rows.withColumn("record", F.sum((F.col("inside") == 0).cast("int")).over(w))
    parts = numbered.groupBy(*SPLIT, "record", "owner").agg(in_order("pos", "line").alias("text"))
    # lines before a split's first start continue the last record of an earlier split: one row for each split
    tails = parts.filter("record = 0").groupBy("file", F.col("owner").alias("split")).agg(in_order("split", "text").alias("tail"))
    of_split = Window.partitionBy(*SPLIT)
    whole = parts.filter("record > 0").withColumns({
        "final": F.max("record").over(of_split) == F.col("record"),
        "header": (F.col("split") == 0) & (F.min(F.when(~blank("text"), F.col("record"))).over(of_split) == F.col("record"))})
    whole = whole.join(tails.withColumn("final", F.lit(True)), [*SPLIT, "final"], "left")
    return whole.select(F.concat_ws("\n", "text", "tail").alias("text"), "header")


def text_records(spark: SparkSession, path: str, unclosed: str = "error") -> DataFrame | None:
    """text and header (a file's first record) of every record that is not blank; None if each line is a record.

    ``unclosed`` is ``"error"`` or ``"keep"``.  One job reads the text to find the
    splits that hold parts of records; its result, a row for each split, is
    checkpointed.
    """
    ensure_checkpoint_dir(spark)
    lines = text_lines(spark, path)
    splits = split_table(lines).checkpoint()
    if unclosed == "error":
        open_files = [r["file"] for r in splits.filter("unclosed").select("file").limit(10).collect()]
        if open_files:
            raise OpenQuoteError(f"a quoted cell never ends in {', '.join(open_files)}")
    if not splits.filter("mixed").limit(1).count():
        return None
    # the other splits' lines stay where they were read as long as the list is checked small
    listed = splits.filter("mixed OR split = 0").select(*SPLIT, "first", "mixed")
    listed = F.broadcast(listed) if fits(listed, DEFAULT_BROADCAST_ROWS) else listed
    single = lines.join(listed, SPLIT, "left").filter(~F.coalesce("mixed", F.lit(False)))
    single = single.select(F.col("line").alias("text"), F.coalesce(F.col("pos") == F.col("first"), F.lit(False)).alias("header"))
    records = single.unionByName(whole_records(lines, splits.filter("mixed").select(*SPLIT, "start", "owner")))
    return records.filter(~blank("text"))


def read_csv_records(spark: SparkSession, path: str, unclosed: str = "error") -> DataFrame:
    """CSV rows with a header, all columns as text: the rows of ``multiLine`` read by as many tasks as the file has splits."""
    reader = spark.read.options(**CSV_OPTIONS).option("header", True)
    records = text_records(spark, path, unclosed)
    if records is None:
        return reader.csv(path)
    names = reader.option("multiLine", True).csv(path).columns  # reads one record
    fields = ", ".join(f"`c{i}` STRING" for i in range(len(names)))
    row = F.from_csv("text", F.lit(fields), {**CSV_OPTIONS, "multiLine": "true"})
    rows = records.filter(~F.col("header")).select(row.alias("r"))
    return rows.select([F.col(f"r.c{i}").alias(name) for i, name in enumerate(names)])

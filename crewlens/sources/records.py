"""CSV files read by many tasks although values may hold line ends.

A reader that takes a value across lines needs a file from its start. Here the files are read as
lines, in blocks that any task can begin with, and lines are put together afterwards.

Whether a line begins inside a quoted value depends on all lines before it, but only through one
bit: each line turns "inside or not" before it into "inside or not" after it. Such steps can be
joined in any grouping: those of a block's lines make one step per block, the blocks' steps give the
state each block begins in, and that gives the state of each of its lines. A record then is a line
that begins outside, with the lines after it that begin inside, also from the next blocks.

Where no line ends inside a quoted value, lines are records, and Spark's reader splits the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewlens.session import stored

# Blanks around values are part of the data. A quote inside a value is doubled.
CSV = {
    "header": True,
    "dateFormat": "yyyy-MM-dd",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "quote": '"',
    "escape": '"',
}
# A value that does not fit its type, or a file with another header, fails the read.
STRICT = {**CSV, "mode": "FAILFAST", "enforceSchema": False}


def _ends_inside(line: Column, begins_inside: bool) -> Column:
    """Does a quoted value go on after the line? Quotes are followed one by one: outside, one opens a
    value if it stands first in its field; inside, two in a row are part of the value."""
    parts = F.split(line, '"', -1)
    last = F.size(parts) - 1

    def follow(state: Column, i: Column) -> Column:
        before, after = F.get(parts, i), F.get(parts, i + 1)
        opens = before.endswith(",") | ((i == 0) & (before == ""))
        doubled = (after == "") & (i + 1 < last)
        return (
            F.when(state["second"], F.struct(state["inside"].alias("inside"), F.lit(False).alias("second")))
            .when(state["inside"], F.struct(doubled.alias("inside"), doubled.alias("second")))
            .otherwise(F.struct(opens.alias("inside"), F.lit(False).alias("second")))
        )

    start = F.struct(F.lit(begins_inside).alias("inside"), F.lit(False).alias("second"))
    end = F.aggregate(F.sequence(F.lit(0), last - 1), start, follow, lambda s: s["inside"])
    return F.when(line.contains('"'), end).otherwise(F.lit(begins_inside))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, block and place, and the states they turn outside and inside into."""
    text = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
    )
    return text.withColumn("opens", _ends_inside(F.col("line"), False)).withColumn(
        "stays", _ends_inside(F.col("line"), True)
    )


def _state(before: Window, begins: Column) -> Column:
    """The state after all rows of a window of steps (columns opens, stays): that of the last step
    that does not depend on the state before it, turned by every step since that turns it."""
    fixed = F.col("opens") == F.col("stays")
    turns = F.sum(F.when(F.col("opens") & ~F.col("stays"), 1).otherwise(0)).over(before)
    turns = F.coalesce(turns, F.lit(0))
    last = F.last(F.when(fixed, F.struct("opens", "turned")), ignorenulls=True).over(before)
    state = F.coalesce(last["opens"], begins)
    since = turns - F.coalesce(last["turned"], F.lit(0))
    return state != (since % 2 == 1)


def _with_turned(rows: DataFrame, upto: Window) -> DataFrame:
    """Add `turned`: how many steps up to this one turn the state."""
    turns = F.when(F.col("opens") & ~F.col("stays"), 1).otherwise(0)
    return rows.withColumn("turned", F.sum(turns).over(upto))


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, block, place, is_header, record: the records of CSV files, line ends inside values kept."""
    in_block = Window.partitionBy("file", "block").orderBy("place")
    upto, before = (in_block.rowsBetween(Window.unboundedPreceding, k) for k in (0, -1))
    lines = stored(
        _with_turned(_lines(spark, path), upto)
        # The state a line begins in, for each state its block may begin in.
        .withColumn("if_outside", _state(before, F.lit(False)))
        .withColumn("if_inside", _state(before, F.lit(True))),
        "lines",
    )
    # A block's step is that of its last line, from the states that line begins in.
    def after(begins: str) -> Column:
        return F.max_by(F.when(F.col(begins), F.col("stays")).otherwise(F.col("opens")), "place")

    def last_start(begins: str) -> Column:
        return F.max(F.when(~F.col(begins), F.col("place")))

    blocks = lines.groupBy("file", "block").agg(
        after("if_outside").alias("opens"), after("if_inside").alias("stays"),
        last_start("if_outside").alias("start_outside"), last_start("if_inside").alias("start_inside"),
    )
    in_file = Window.partitionBy("file").orderBy("block")
    blocks_upto, blocks_before = (in_file.rowsBetween(Window.unboundedPreceding, k) for k in (0, -1))
    entered = _with_turned(blocks, blocks_upto).withColumn("inside", _state(blocks_before, F.lit(False)))
    start = F.when(F.col("inside"), F.col("start_inside")).otherwise(F.col("start_outside"))
    # The record that a block's first lines go on with: the last begun in an earlier block.
    entered = entered.withColumn("start", F.when(start.isNotNull(), F.struct("block", start.alias("place")))).select(
        "file", "block", "inside", F.last("start", ignorenulls=True).over(blocks_before).alias("earlier"))
    begins = F.when(F.col("inside"), F.col("if_inside")).otherwise(F.col("if_outside"))
    # One row per block meets the lines; the first lines of a file are told by their places.
    placed = lines.join(entered, ["file", "block"]).select(
        "file", "block", "place", "line", begins.alias("goes_on"), "earlier",
        (F.when(begins, F.col("stays")).otherwise(F.col("opens"))).alias("open_end"),
    )
    own = F.max(F.when(~F.col("goes_on"), F.col("place"))).over(upto)
    key = F.when(own.isNotNull(), F.struct("block", own.alias("place"))).otherwise(F.col("earlier"))
    placed = placed.withColumn("start", key).drop("earlier")
    whole = placed.filter(~F.col("goes_on") & ~F.col("open_end")).select("file", "start", F.col("line").alias("record"))
    parts = placed.filter(F.col("goes_on") | F.col("open_end"))
    joined = parts.groupBy("file", "start").agg(
        F.array_sort(F.collect_list(F.struct("block", "place", "line"))).alias("lines")
    ).select("file", "start", F.array_join(F.col("lines.line"), "\n").alias("record"))
    first = lines.filter("block = 0").groupBy("file").agg(F.min("place").alias("_first"))
    found = whole.unionByName(joined).join(first, "file").select(
        "file", F.col("start.block").alias("block"), F.col("start.place").alias("place"),
        ((F.col("start.block") == 0) & (F.col("start.place") == F.col("_first"))).alias("is_header"),
        F.regexp_replace("record", r"\r$", "").alias("record"),
    )
    return found.filter("record <> ''")


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names, from the first line of a file."""
    return spark.read.options(**CSV).csv(path).columns


def has_long_records(spark: SparkSession, path: str) -> bool:
    """Does any value hold a line end? Unless a line ends inside a value, every line begins outside."""
    line = F.col("value")
    bare = F.regexp_replace(line, r"\r$", "")
    odd = _ends_inside(line, False) | bare.contains("\r")
    return not spark.read.text(path, lineSep="\n").filter(odd).isEmpty()


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of CSV files that all have this header, in any number of tasks."""
    if not has_long_records(spark, path):
        return spark.read.schema(schema).options(**STRICT).csv(path)
    found = stored(records(spark, path), "records")
    names = [f"{f.name}" for f in schema]
    texts = ", ".join(f"_{k} string" for k in range(len(names)))
    heads = found.filter("is_header").select(F.from_csv("record", texts, CSV).alias("h")).select("h.*")
    odd = heads.filter(~F.array(*heads.columns).eqNullSafe(F.array(*map(F.lit, names))))
    other = odd.first()
    if other is not None:
        raise ValueError(f"CSV header does not conform to the schema: {list(other)} instead of {names}.")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    options = {k: v for k, v in STRICT.items() if k not in ("header", "enforceSchema")}
    rows = found.filter("NOT is_header").select(F.from_csv("record", fields, options).alias("row"))
    return rows.select("row.*")

"""Semicolon-separated files: tolerant in content, strict in shape."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window, functions as F, types as T

from risklake.functions.text import na_to_null
from risklake.sources.schemas import Source

SEPARATOR = ";"
RECORD = "_registro"
QUOTED = r'"(?:[^"]|"")*"'


def _reader(spark: SparkSession, source: Source) -> DataFrameReader:
    return (
        spark.read.option("sep", SEPARATOR)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", source.multiline)
    )


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def _records(spark: SparkSession, path: str) -> DataFrame:
    """(record, first): the records of files with line breaks inside quotes, and whether each is the first of its file.

    The files are split between tasks at any line. Of each split one row is made first: how many of its lines begin a record if
    the split begins outside quotes, and how many if inside, and whether its quotes leave that as it was. Their order
    in the file then tells for each split where it begins, and which record is open there. Only the lines of records
    with line breaks are shuffled.
    """
    split = ["_file", "_block"]
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.regexp_replace("value", "\r$", "").alias("_line"),
        F.xxhash64("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    within = Window.partitionBy(*split).orderBy("_id")
    odd = _quotes(F.col("_line")) % 2
    # one split is read by one task: its lines are what a task can hold
    before = F.coalesce(F.sum(odd).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    lines = lines.withColumns({"_odd": odd, "_before": before})
    splits = lines.groupBy(*split).agg(
        (F.sum("_odd") % 2).alias("_turns"),
        F.count(F.when(F.col("_before") == 0, 1)).alias("_outside"),
        F.count(F.when(F.col("_before") == 1, 1)).alias("_inside"),
    )
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_in", F.coalesce(F.sum("_turns").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("_in") == 0, F.col("_outside")).otherwise(F.col("_inside"))
    open_ = F.last(F.when(begun > 0, F.struct(F.col("_block").alias("block"), begun.alias("n"))), True).over(earlier)
    known = lines.join(splits.select(*split, "_in", open_.alias("_open")), split)
    starts = F.col("_before") == F.col("_in")
    number = F.sum(starts.cast("long")).over(within.rowsBetween(Window.unboundedPreceding, 0))
    known = known.withColumns({"_starts": starts, "_n": number})
    carried = F.col("_n") == 0
    known = known.select(
        "_file", "_block", "_id", "_line", F.when(carried, F.col("_open.block")).otherwise(F.col("_block")).alias("_at"),
        F.when(carried, F.col("_open.n")).otherwise(F.col("_n")).alias("_of"), (starts & (F.col("_odd") == 0)).alias("_whole"),
    )
    first = (F.col("_at") == 0) & (F.col("_of") == 1)
    parts = known.where("not _whole").groupBy("_file", "_at", "_of")
    joined = parts.agg(F.sort_array(F.collect_list(F.struct("_block", "_id", "_line"))).alias("_lines"))
    whole = known.where("_whole").select(F.col("_line").alias("record"), first.alias("first"))
    joined = joined.select(F.array_join(F.transform("_lines", lambda x: x["_line"]), "\n").alias("record"), first.alias("first"))
    return whole.unionByName(joined).where(F.trim("record") != "")


def read_raw(spark: SparkSession, path: str, source: Source) -> DataFrame:
    """Raw rows of ``source`` as text, with missing-value words as NULL.

    Columns go by the names in the header, in any order; a missing one fails, further ones are kept. All files below
    ``path`` must have the same header. A short row is padded with NULL; a row with more fields than the header fails
    the read, and so does one with an open quote: a quoted line break needs a source that is ``multiline``. Files of either kind are read by as
    many tasks as their size asks for.
    """
    header = _reader(spark, source).csv(path).columns  # reads one line
    missing = [name for name in source.columns if name not in header]
    if missing:
        raise ValueError(f"{source.table}: no column {', '.join(missing)} in {path}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*header, RECORD]])

    # the message names the row by its first field too: a scan of the record column alone is not allowed
    def failure(what: str) -> Column:
        label = f"{source.table}: {what} where {header[0]} is "
        return F.raise_error(F.concat_ws("", F.lit(label), F.col(f"`{header[0]}`"), F.lit(": "), F.col(RECORD))).cast("boolean")

    if source.multiline:
        options = {"sep": SEPARATOR, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
        ddl = ", ".join(f"`{f.name}` string" for f in schema)
        parsed = F.from_csv("record", ddl, {**options, "maxCharsPerColumn": "-1"}).alias("_row")
        lines = _records(spark, path).select("first", "record", parsed).select("first", "_row.*", F.col("record").alias("_whole"))
        same = F.lit(True)
        for name in header:
            same = same & F.coalesce(F.col(f"`{name}`") == name, F.lit(False))
        lines = lines.withColumn(RECORD, F.when(F.col(RECORD).isNotNull() | (_quotes(F.col("_whole")) % 2 == 1), F.col("_whole")))
        lines = lines.where(F.when(F.col("first") & ~same, failure("CSV header differs")).otherwise(~F.col("first")))
    else:
        lines = (
            _reader(spark, source)
            .schema(schema)
            .option("enforceSchema", False)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", RECORD)
            .option("columnPruning", False)  # a pruned parser does not count fields
            .csv(path)
        )
    bare = F.regexp_replace(RECORD, QUOTED, "")
    separators = F.length(bare) - F.length(F.replace(bare, F.lit(SEPARATOR), F.lit("")))
    too_long = F.col(RECORD).isNotNull() & (separators >= len(header))
    # a quoted line break ends the record early, in an open quote; what follows is then short, so both are checked
    open_quote = F.col(RECORD).isNotNull() & (_quotes(F.col(RECORD)) % 2 == 1)
    checked = lines.where(
        F.when(open_quote, failure("an open quote (set multiline for quoted line breaks)"))
        .when(too_long, failure(f"more than {len(header)} fields"))
        .otherwise(True)
    )
    return checked.select([na_to_null(F.col(f"`{name}`")).alias(name) for name in header])


def write_raw(df: DataFrame, path: str) -> None:
    """Semicolon-separated text with a header, readable by ``read_raw``."""
    (
        df.write.option("sep", SEPARATOR)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_all_raw(tables: dict[str, DataFrame]) -> None:
    """``write_raw`` of each table to its path, the first ones first. Tasks that one table leaves idle work on the next."""
    with ThreadPoolExecutor(max(len(tables), 1)) as pool:
        for written in [pool.submit(write_raw, df, path) for path, df in tables.items()]:
            written.result()

"""Reading large multi-line CSV files in parallel.

Spark's own reader takes a whole file per task once quoted newlines are allowed,
since a task that starts inside a file cannot tell whether it is inside quotes.
So each line is read both ways. Only structural quotes count: one that stands at
the start of a field opens it, and the next one that is not doubled closes it.
A line is a map from the state before it to the state after it, (outside, inside)
to (outside, inside), and such maps compose: after a line that ends in one state
whatever came before, the state is known; other lines keep or swap the two. The
maps are composed per block, blocks being what tasks read, so only one small row
per block is put in file order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BLOCK = ["_file", "_block"]


def read_csv_split(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV with quoted multi-line text, every column text, large files split.

    Lines end in LF or CRLF. A stray quote inside a field that does not start with
    one is text; a field that is never closed, and would run to the end of its file,
    is an error. ``columns`` must be each file's header.
    """
    lines = _numbered_lines(spark, path)
    records = (
        lines.join(_block_starts(lines), _BLOCK)
        .withColumn("_record", F.col("_records_before") + _starts(F.col("_quoted")))
        .groupBy("_file", "_record")
        .agg(F.array_sort(F.collect_list(F.struct("_block", "_line", "value"))).alias("_lines"))
        .select("_record", F.array_join(F.col("_lines.value"), "\n").alias("_text"))
        .withColumn("_text", F.regexp_replace("_text", "\r$", ""))
    )
    schema = ", ".join(f"`{name}` string" for name in columns)
    options = {"escape": '"', "multiLine": "true"}
    rows = records.filter(F.col("_text") != "").select(
        "_record", F.from_csv("_text", schema, options).alias("_row")
    )
    header = F.array(*(F.col(f"_row.`{name}`") for name in columns))
    same = F.assert_true(header == F.array(*map(F.lit, columns)), F.lit("unexpected CSV header"))
    is_data = F.when(F.col("_record") == 1, same.isNotNull()).otherwise(True)
    return rows.filter(is_data).select("_row.*")


# What a quoted field may hold up to its closing quote, and a whole field.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|)'
_OPENS = rf'(?:{_FIELD},)*+"{_INSIDE}\z'


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, block and number, and the state before each.

    That is ``_fixed`` (1 inside quotes, 0 outside) where the block tells, otherwise
    the state at the block's start, turned round if ``_flip``.
    """
    text = F.col("value")
    opens = text.rlike(rf"\A{_OPENS}").cast("int")
    stays = text.rlike(rf'\A{_INSIDE}(?:\z|"[^,]*+,{_OPENS})').cast("int")
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_line"),
            F.when(opens == stays, opens).alias("_always"),
            ((opens == 1) & (stays == 0)).cast("int").alias("_swaps"),
            "value",
        )
    )
    return _state_before(lines, _BLOCK, "_line")


def _state_before(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds ``_fixed``, ``_flip`` and ``_known``, the last fixed state turned to the start."""
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.coalesce(F.sum("_swaps").over(earlier), F.lit(0)) % 2
    return (
        rows.withColumn("_flip", swaps.cast("int"))
        .withColumn("_known", F.col("_always").bitwiseXOR(F.col("_flip")))
        .withColumn(
            "_fixed",
            F.last("_known", ignorenulls=True).over(earlier).bitwiseXOR(F.col("_flip")),
        )
    )


def _outside(quoted: Column) -> Column:
    """Whether a line starts outside quotes, if its block starts with ``quoted`` (0 or 1)."""
    return F.coalesce(F.col("_fixed"), F.col("_flip").bitwiseXOR(quoted)) == 0


def _starts(quoted: Column) -> Column:
    """Records started in the block up to and including a line."""
    so_far = Window.partitionBy(*_BLOCK).orderBy("_line").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return F.sum(_outside(quoted).cast("bigint")).over(so_far)


def _block_starts(lines: DataFrame) -> DataFrame:
    """Per block: whether it starts inside quotes (1 or 0), and the records before it."""
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    swaps = (F.sum("_swaps") % 2).cast("int")
    told = F.when(F.col("_known").isNotNull(), F.col("_line"))
    blocks = lines.groupBy(*_BLOCK).agg(
        swaps.alias("_swaps"),
        F.max_by("_known", told).bitwiseXOR(swaps).alias("_always"),
        F.count_if(_outside(F.lit(0))).alias("_records_outside"),
        F.count_if(_outside(F.lit(1))).alias("_records_inside"),
    )
    # A block that always ends in one state swaps nothing.
    blocks = blocks.withColumn(
        "_swaps", F.when(F.col("_always").isNull(), F.col("_swaps")).otherwise(0)
    )
    blocks = _state_before(blocks, ["_file"], "_block").withColumn(
        "_quoted", F.coalesce("_fixed", "_flip")
    )
    starts = F.when(F.col("_quoted") == 0, F.col("_records_outside")).otherwise(
        F.col("_records_inside")
    )
    before = F.coalesce(F.sum(starts).over(earlier), F.lit(0))
    ends_inside = F.coalesce("_always", F.col("_quoted").bitwiseXOR(F.col("_swaps"))) == 1
    is_last = F.lead("_block").over(Window.partitionBy("_file").orderBy("_block")).isNull()
    closed = F.assert_true(~(is_last & ends_inside), F.lit("a quoted CSV field is never closed"))
    return blocks.select(
        *_BLOCK,
        F.when(closed.isNull(), F.col("_quoted")).alias("_quoted"),
        before.alias("_records_before"),
    )

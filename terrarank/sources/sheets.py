"""Sheets landed as separated text, whose table begins some lines down.

The lines above a table differ in number from file to file. A line offset is
tried as the header's, in a fixed order; the first one below which some column
holds entity keys (an all-digit value of 6 or 7 characters among its first 20
values that are not empty) counts, and that column is the key. What stands
below the header are the rows.

All files are read once, whatever their number and size: lines keep their
order by the start of their block in the file and a running number in it. Only
the first lines of a file, and the first few values of each of its columns,
are ranked (a window-group limit drops the others before they are shuffled).
Cells hold no separator; empty cells are NULL. A file without a key column has no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrarank.functions import normalize_key_guarded
from terrarank.session import cut_lineage

HEADER_OFFSETS = (9, 10, 8, 7)  # fixed values: lines above the header, in the order they are tried
SAMPLE = 20
KEY_PATTERN = r"^[0-9]{6,7}$"
PLACE = ("block", "seq")


def read_lines(spark: SparkSession, paths: str | Sequence[str], sep: str = ";") -> DataFrame:
    """(file, block, seq, cells): every line with its place; block and seq order the lines of a file."""
    text = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.split("value", f"\\Q{sep}\\E", -1).alias("cells"))
    cells = F.transform("cells", lambda c: F.nullif(F.trim(c), F.lit("")))
    return cut_lineage(text.withColumn("cells", cells))  # the running numbers must not change between the two uses


def header_choices(lines: DataFrame, offsets: Sequence[int] = HEADER_OFFSETS, sample: int = SAMPLE) -> DataFrame:
    """(file, offset, header, key_position, header_at): the header line of each file that has a key column; one row a file."""
    at = F.struct(*PLACE)
    by_place = Window.partitionBy("file").orderBy(*PLACE)
    top = lines.withColumn("n", F.row_number().over(by_place) - 1).where(F.col("n") <= max(offsets))
    tried = F.array_position(F.array(*map(F.lit, offsets)), F.col("n").cast("int"))
    heads = top.where(F.col("n").isin(list(offsets))).select(
        F.col("file").alias("h_file"), F.col("n").alias("offset"), tried.alias("turn"), F.col("cells").alias("header"), at.alias("header_at"))
    # a column's first values below any offset are among its first few in the file
    values = lines.select("file", at.alias("at"), F.posexplode("cells").alias("position", "value")).where("value IS NOT NULL")
    by_column = Window.partitionBy("file", "position").orderBy("at")
    few = values.withColumn("n", F.row_number().over(by_column)).where(F.col("n") <= sample + max(offsets) + 1)
    below = few.drop("n").join(heads, F.col("file") == F.col("h_file")).where(F.col("at") > F.col("header_at"))
    nth = F.row_number().over(Window.partitionBy("file", "offset", "position").orderBy("at"))
    keyed = below.withColumn("n", nth).where((F.col("n") <= sample) & F.col("value").rlike(KEY_PATTERN))
    first = keyed.groupBy("file").agg(F.min(F.struct("turn", "position", "offset", "header", "header_at")).alias("c"))
    return first.select("file", F.col("c.offset").cast("int").alias("offset"), "c.header", F.col("c.position").alias("key_position"), "c.header_at")


def rows_below_headers(lines: DataFrame, choices: DataFrame) -> DataFrame:
    """(file, offset, key_name, key, header, cells): the rows below each file's header that have a key."""
    c = choices.withColumnRenamed("file", "c_file")
    rows = lines.join(c, F.col("file") == F.col("c_file")).where(F.struct(*PLACE) > F.col("header_at"))
    key = normalize_key_guarded(F.try_element_at("cells", F.col("key_position") + 1))
    name = F.try_element_at("header", F.col("key_position") + 1)
    return rows.select("file", "offset", name.alias("key_name"), key.alias("key"), "header", "cells").where("key IS NOT NULL")


def cell(name: str) -> Column:
    """The cell under the header's first column of this name; NULL where there is none."""
    return F.try_element_at("cells", F.nullif(F.array_position("header", F.lit(name)), F.lit(0)).cast("int"))


def read_sheets(spark: SparkSession, paths: str | Sequence[str], sep: str = ";", offsets: Sequence[int] = HEADER_OFFSETS) -> DataFrame:
    lines = read_lines(spark, paths, sep)
    return rows_below_headers(lines, header_choices(lines, offsets))

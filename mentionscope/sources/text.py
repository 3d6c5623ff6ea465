"""Text and delimited scans of article segments.

Lines are read as text and parsed with column expressions (see
:mod:`mentionscope.operators.articles`) rather than through the CSV reader:
the CSV reader's quote handling and column pruning change which malformed
lines survive, while the text route gives one explicit rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.articles import typed_articles
from ..operators.prefix import bucketed_row_number


def read_lines(spark: SparkSession, paths, with_file: bool = False) -> DataFrame:
    """A glob (or list) of text files -> ``value`` (+ ``file``, ``split``, ``pos``).

    ``split`` is where the line's block starts in its file, ``pos`` grows with the lines of a block."""
    df = spark.read.text(paths)
    if with_file:
        df = df.select("value", F.col("_metadata.file_name").alias("file"),
                       F.col("_metadata.file_block_start").alias("split"),
                       F.monotonically_increasing_id().alias("pos"))
    return df


def numbered_lines(spark: SparkSession, paths) -> DataFrame:
    """S1 with true line numbers -> ``file, line_no, value`` (``line_no`` from 1, per file).

    Blocks of a file are read by many tasks, in any packing: lines are numbered within their
    block and the blocks' counts summed in the order of the file.
    """
    lines = read_lines(spark, paths, with_file=True)
    return bucketed_row_number(lines, ["file"], F.col("split"), [F.col("pos")], "line_no").select("file", "line_no", "value")


def read_articles(spark: SparkSession, paths, mode: str = "drop", observation: Observation | None = None) -> DataFrame:
    """Typed 27-column records from TAB separated segments, read once in either
    mode (see :func:`~mentionscope.operators.articles.typed_articles`)."""
    return typed_articles(read_lines(spark, paths), mode=mode, observation=observation)


def repair_utf8(col: str = "value") -> F.Column:
    """Drop malformed UTF-8 byte sequences (valid text is left untouched).
    A genuine U+FFFD is set aside as a noncharacter while the malformed ones go."""
    c = F.col(col)
    aside = F.make_valid_utf8(F.replace(c, F.lit("\ufffd"), F.lit("\ufdd0")))
    return F.when(F.is_valid_utf8(c), c).otherwise(
        F.replace(F.regexp_replace(aside, "\ufffd", ""), F.lit("\ufdd0"), F.lit("\ufffd")))


def read_lines_utf8(spark: SparkSession, paths) -> DataFrame:
    """S1 + S10: text lines read as bytes, malformed sequences ignored."""
    df = spark.read.option("encoding", "UTF-8").text(paths)
    return df.select(repair_utf8("value").alias("value"))

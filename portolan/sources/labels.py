"""Key/value extraction from text, and lookup tables from a label-format text file.

``extract_pairs`` finds every ``key="value"``-like match in a text column; the text is
scanned whole (no prefix) and each row is handled in its own task, so the work
grows only with the text.

``label_entries`` reads a text of ``value <name>`` sections holding
``code = 'label'`` lines (the format code tables are published in) and returns one row
per entry with its section. The section of a line is the last header above it: a
carry-forward computed in two levels, so that no task ever holds a whole file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portolan.session import stage

# Attribute-like pairs: name="value".
DEFAULT_PAIR_PATTERN = r'([A-Za-z-]+)="([^"]*)"'

# A section header line, and an entry line: a quoted or bare code, '=', a quoted label
# (a doubled quote inside quotes stands for one quote).
SECTION_PATTERN = r"^\s*value\s+(\$?\w+)"
ENTRY_PATTERN = r"^\s*(?:'((?:[^']|'')*)'|([^\s=']+))\s*=\s*'((?:[^']|'')*)'"

# Lines per carry-forward chunk: bounds the rows one window group may hold.
CHUNK_LINES = 1 << 20


def extract_pairs(df: DataFrame, text: str, pattern: str = DEFAULT_PAIR_PATTERN,
                  keep: list[str] | None = None) -> DataFrame:
    """One row per match of ``pattern`` in ``text``: ``keep`` columns, ``pos`` (0-based
    match index), ``key`` (group 1) and ``value`` (group 2)."""
    keep = keep or []
    matches = df.select(*keep, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(pattern), 0))
                        .alias("pos", "_match"))
    return matches.select(*keep, "pos",
                          F.regexp_extract("_match", pattern, 1).alias("key"),
                          F.regexp_extract("_match", pattern, 2).alias("value"))


def number_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """(file, line_id, text) from ``spark.read.text``; ids grow with the position in a file.

    The ids depend on how the files are split, so the numbered lines are written once and
    every later scan reads the same ids.
    """
    return stage(lines.select(F.input_file_name().alias("file"),
                        F.monotonically_increasing_id().alias("line_id"),
                        F.col(text).alias("text")), "numbered-lines")


def _unquote(value: Column) -> Column:
    return F.regexp_replace(value, "''", "'")


def label_entries(numbered: DataFrame, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """(section, code, label) for every entry line of ``number_lines`` output."""
    header = F.nullif(F.regexp_extract("text", SECTION_PATTERN, 1), F.lit(""))
    lines = numbered.select("file", "line_id", "text", header.alias("section"),
                            (F.col("line_id") / F.lit(chunk_lines)).cast("long").alias("chunk"))

    # Level 1: the last header of each chunk, carried over to the chunks after it.
    per_chunk = (lines.groupBy("file", "chunk")
                 .agg(F.max_by("section", F.when(F.col("section").isNotNull(), F.col("line_id")))
                      .alias("last_section")))
    earlier = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select("file", "chunk",
                             F.last("last_section", ignorenulls=True).over(earlier).alias("carry_in"))

    # Level 2: within a chunk, the last header so far, else the carried one.
    upto = (Window.partitionBy("file", "chunk").orderBy("line_id")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    located = (lines.join(carry, ["file", "chunk"], "left")
               .withColumn("section", F.coalesce(F.last("section", ignorenulls=True).over(upto),
                                                 F.col("carry_in"))))
    entries = located.where(F.col("text").rlike(ENTRY_PATTERN))
    code = F.coalesce(F.nullif(F.regexp_extract("text", ENTRY_PATTERN, 1), F.lit("")),
                      F.regexp_extract("text", ENTRY_PATTERN, 2))
    return entries.select("section", _unquote(code).alias("code"),
                          _unquote(F.regexp_extract("text", ENTRY_PATTERN, 3)).alias("label"))


def lookup_from_entries(entries: DataFrame, section: str, code_name: str = "Code",
                        label_name: str = "label", code_type: str = "string") -> DataFrame:
    """(code, label) of one section of :func:`label_entries`, the code cast to
    ``code_type`` (non-numeric codes become null for numeric types, and are dropped). Text
    codes are kept as published, blanks included; labels lose their trailing blanks."""
    code = F.col("code") if code_type == "string" else F.trim("code").try_cast(code_type)
    out = entries.where(F.col("section") == F.lit(section)).select(
        code.alias(code_name), F.rtrim("label").alias(label_name))
    return out.where(F.col(code_name).isNotNull())

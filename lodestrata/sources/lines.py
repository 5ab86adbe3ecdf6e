"""Source files as numbered lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions.text import as_col, strip
from lodestrata.operators.windows import before, by, first_wins


#: What ends a line: besides CR and LF the vertical tab, form feed (a page break), the separators 1C to 1E, NEL, LS and PS.
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"


def split_lines(text: Column | str) -> Column:
    """The lines of a text; a final line break begins no line."""
    parts = F.split(as_col(text), LINE_END, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def line_table(files: DataFrame, text: str = "text", key: str = "source_file") -> DataFrame:
    """(key, line_num from 1, line) of each row's text; other columns are kept."""
    rest = [c for c in files.columns if c != text]
    return files.select(*rest, F.posexplode(split_lines(text)).alias("pos", "line")).select(*rest, (F.col("pos") + 1).alias("line_num"), "line")


def file_name() -> Column:
    """The name of the file that a row was read from; metadata escapes blanks and the like as in an address, but no +."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def read_texts(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """(source_file, path, text) of every file: one row a file, bad bytes replaced."""
    reader = spark.read.option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(path, wholetext=True).select(file_name().alias("source_file"), F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(source_file, path, length) of every file below a folder, without reading the contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), "path", "length")


def stem(name: Column | str) -> Column:
    return F.regexp_replace(as_col(name), r"\.[^.]*$", "")


def dedup_stems(files: DataFrame, prefer: str = "lower") -> DataFrame:
    """One file for each upper-cased stem: the lower-case extension first, or the upper-case one, or by path."""
    ext = F.regexp_extract("source_file", r"\.([^.]*)$", 1)
    is_lower = (ext == F.lower(ext)).cast("int")
    order = {"lower": [-is_lower], "upper": [is_lower], "path": []}[prefer]
    return first_wins(files.withColumn("_stem", F.upper(stem("source_file"))), ["_stem"], [*order, "source_file"]).drop("_stem")


def is_comment(line: Column | str) -> Column:
    """Column 7 holds * or /."""
    return F.substring(as_col(line), 7, 1).isin("*", "/")


PARAGRAPH = r"(?i)^[ ]{6,7}([A-Z0-9][A-Z0-9-]{1,29})\s*\.\s*$"


def paragraph_name(line: Column | str) -> Column:
    """The paragraph that a line heads; else null."""
    name = F.regexp_extract(as_col(line), PARAGRAPH, 1)
    return F.when(name != "", F.upper(name))


def prepared(lines: DataFrame) -> DataFrame:
    """Lines with program, comment, header (of lines that are no comments), division and procedure (after the division's line).

    Lines that are prepared already stay as they are, so that one preparation (and its shuffle by file) serves all extractors.
    """
    if {"procedure", "any_header", "stripped"} <= set(lines.columns):
        return lines
    w = by("source_file", "line_num")
    division = ~is_comment("line") & F.upper("line").contains("PROCEDURE DIVISION")
    out = lines.withColumns({"program": F.upper(stem("source_file")), "comment": is_comment("line"), "division": division, "any_header": paragraph_name("line")})
    procedure = F.coalesce(F.max(F.col("division").cast("int")).over(before(w)) == 1, F.lit(False))
    return out.withColumns({"header": F.when(~F.col("comment"), F.col("any_header")), "procedure": procedure & ~F.col("division"), "stripped": strip("line")})


def joined_files(lines: DataFrame, text: Column | str = "line", separator: str = "\n") -> DataFrame:
    """(source_file, text) with a file's lines joined in order; one file is what a task holds."""
    rows = F.array_sort(F.collect_list(F.struct("line_num", as_col(text).alias("text"))))
    return lines.groupBy("source_file").agg(F.array_join(F.transform(rows, lambda r: r["text"]), separator).alias("text"))

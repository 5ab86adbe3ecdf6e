"""COPY expansion with provenance.

Programs and copybooks are tables of lines; a level of nesting is one join with the copybooks. Every
line carries the path of positions that leads to it, and the order of paths is the order of the
expanded program, so levels can be expanded side by side and numbered once at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.text import group, groups, none_if_empty, strip
from lodestrata.operators.windows import by, running
from lodestrata.sources.lines import is_comment

#: Copybooks nest this deep; the next level is found but adds nothing.
DEPTH = 5
_RULES = "array<struct<original:string,replacement:string>>"
COPY = r"(?is)^\s{6,}COPY(?![-\w])\s+['\"]?([A-Z0-9#@$-]+)['\"]?(?:\s+IN\s+[^\s.]+)?(?:\s+REPLACING\s+(.+?))?\s*\."


def replacing_rules(clause: Column | str) -> Column:
    """Pairs ==original== BY ==replacement== in order."""
    pattern = r"(?i)==\s*(.+?)\s*==\s+BY\s+==\s*(.+?)\s*=="
    return F.zip_with(groups(clause, pattern, 1), groups(clause, pattern, 2), lambda a, b: F.struct(a.alias("original"), b.alias("replacement")))


def apply_rules(line: Column, rules: Column) -> Column:
    """Each rule in turn, wherever its original stands between word boundaries (a hyphen is one); not in comments and blank lines."""
    quoted = lambda x: F.concat(F.lit(r"(?i)\b\Q"), x, F.lit(r"\E\b"))
    literal = lambda x: F.regexp_replace(x, r"([\\$])", r"\\$1")
    done = F.aggregate(rules, line, lambda acc, r: F.regexp_replace(acc, quoted(r["original"]), literal(r["replacement"])))
    return F.when(is_comment(line) | (strip(line) == ""), line).otherwise(done)


def copy_statements(lines: DataFrame) -> DataFrame:
    """Lines of (file, line_num, line) with COPY statements gathered: kind line or copy, and copy's name and clause.

    A COPY without a period goes on up to the line with one; the statement stands at its last line. One that
    cannot be read is dropped, as are COPY lines themselves.
    """
    w = by("file", "line_num")
    starts = ~is_comment("line") & F.col("line").rlike(r"(?i)\bCOPY(?![-\w])")
    closed = F.col("line").contains(".")
    # a statement is open after a start without period until the next period; starts inside it are part of it
    mark = F.when(closed, 0).when(starts, 1)
    opened = F.coalesce(F.last(mark, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) == 1
    rows = lines.withColumns({"opened": opened, "starts": starts})
    rows = rows.withColumn("n", running(~F.col("opened"), w))
    parts = F.array_sort(F.collect_list(F.struct("line_num", "line")))
    whole = rows.groupBy("file", "n").agg(F.max("line_num").alias("line_num"), F.bool_or(F.col("starts") & ~F.col("opened")).alias("is_copy"), F.array_join(F.transform(parts, lambda r: r["line"]), " ").alias("line"))
    name = none_if_empty(group("line", COPY))
    out = whole.withColumns({"copybook": F.when(F.col("is_copy"), name), "clause": F.when(F.col("is_copy"), group("line", COPY, 2))})
    return out.where(~F.col("is_copy") | F.col("copybook").isNotNull()).select("file", "line_num", "line", "copybook", "clause")


def expand(programs: DataFrame, copybooks: DataFrame) -> DataFrame:
    """(source_file, expanded_line_num, content, origin_file, origin_line_num, copybook, replacing, copy_depth).

    `programs` is (source_file, line_num, line); `copybooks` is (name, line_num, line). Copybooks match by upper-cased name.
    """
    return _expanded(programs, copybooks)[0]


def copy_uses(programs: DataFrame, copybooks: DataFrame) -> DataFrame:
    """(source_file, copybook, found): the copybooks of each program at any level, once each."""
    return _expanded(programs, copybooks)[1]


def _expanded(programs: DataFrame, copybooks: DataFrame) -> tuple[DataFrame, DataFrame]:
    books = copy_statements(copybooks.select(F.upper("name").alias("file"), "line_num", "line"))
    books = books.select(F.col("file").alias("book"), F.col("line_num").alias("b_num"), F.col("line").alias("b_line"), F.col("copybook").alias("b_copy"), F.col("clause").alias("b_clause"))
    known = copybooks.select(F.upper("name").alias("book")).distinct().withColumn("found", F.lit(True))
    top = copy_statements(programs.select(F.col("source_file").alias("file"), "line_num", "line"))
    none = F.array().cast(_RULES)
    level = top.select(
        F.col("file").alias("source_file"), F.array("line_num").alias("path"), "line", F.col("file").alias("origin_file"), F.col("line_num").alias("origin_line_num"),
        F.lit(None).cast("string").alias("in_copybook"), none.alias("rules"), F.lit(0).alias("depth"), "copybook", "clause",
    )
    out, uses = [], []
    for _ in range(DEPTH + 1):
        plain = level.where("copybook IS NULL")
        out.append(plain.select("source_file", "path", apply_rules(F.col("line"), F.col("rules")).alias("content"), "origin_file", "origin_line_num", F.col("in_copybook").alias("copybook"), F.col("rules").alias("replacing"), F.col("depth").alias("copy_depth")))
        copies = level.where("copybook IS NOT NULL").withColumn("book", F.upper("copybook"))
        uses.append(copies.join(known, "book", "left").select("source_file", F.col("copybook"), F.coalesce("found", F.lit(False)).alias("found")))
        rules = F.concat("rules", replacing_rules(F.coalesce("clause", F.lit(""))))
        level = copies.join(books, "book").select(
            "source_file", F.concat("path", F.array("b_num")).alias("path"), F.col("b_line").alias("line"), F.concat("copybook", F.lit(".cpy")).alias("origin_file"),
            F.col("b_num").alias("origin_line_num"), F.col("copybook").alias("in_copybook"), rules.alias("rules"), (F.col("depth") + 1).alias("depth"), F.col("b_copy").alias("copybook"), F.col("b_clause").alias("clause"),
        )
    union = lambda parts: parts[0] if len(parts) == 1 else union(parts[:-1]).unionByName(parts[-1])
    numbered = union(out).withColumn("expanded_line_num", F.row_number().over(by("source_file", "path")))
    return numbered.drop("path").select("source_file", "expanded_line_num", "content", "origin_file", "origin_line_num", "copybook", "replacing", "copy_depth"), union(uses).distinct()


def summary(expanded: DataFrame) -> DataFrame:
    """Five measures of each program: lines, own lines, copybook lines, replaced lines, and its copybooks."""
    return expanded.groupBy("source_file").agg(
        F.count("*").alias("total_lines"), F.count_if(F.col("copybook").isNull()).alias("original_lines"), F.count_if(F.col("copybook").isNotNull()).alias("copybook_lines"),
        F.count_if(F.size("replacing") > 0).alias("replaced_lines"), F.array_sort(F.collect_set("copybook")).alias("copybooks"),
    )


def line_origin(expanded: DataFrame, source_file: str, line: int) -> DataFrame:
    """Where a line of an expanded program comes from."""
    return expanded.where((F.col("source_file") == source_file) & (F.col("expanded_line_num") == line))


def copybook_lines(expanded: DataFrame, source_file: str, copybook: str) -> DataFrame:
    return expanded.where((F.col("source_file") == source_file) & (F.upper("copybook") == copybook.upper())).orderBy("expanded_line_num")


def with_stubs(copybooks: DataFrame, stubs: DataFrame) -> DataFrame:
    """`copybooks` and the lines of those stubs (name, line_num, line) whose copybook is absent."""
    have = copybooks.select(F.upper("name").alias("_n")).distinct()
    absent = stubs.join(have, F.upper(stubs["name"]) == have["_n"], "left_anti")
    return copybooks.select("name", "line_num", "line").unionByName(absent.select("name", "line_num", "line"))


def strip_dli(lines: DataFrame) -> DataFrame:
    """Lines with EXEC DLI ... END-EXEC turned into comments; a block on one line stays open until a later END-EXEC."""
    w = by("source_file", "line_num")
    start, end = F.col("line").rlike(r"(?i)EXEC\s+DLI"), F.upper("line").contains("END-EXEC")
    mark = F.when(start, 1).when(end, 0)
    inside = start | (F.coalesce(F.last(mark, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) == 1)
    return lines.withColumn("line", F.when(inside, F.concat(F.lit("      *"), F.substring("line", 8, 1 << 20))).otherwise(F.col("line")))

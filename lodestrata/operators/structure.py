"""Programs, paragraphs and symbols of expanded sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.ids import node_id
from lodestrata.functions.pic import normalize_pic
from lodestrata.functions.rewrite import program_type
from lodestrata.functions.text import strip, word
from lodestrata.operators.extract import VERBS, data_items
from lodestrata.operators.windows import by, upto
from lodestrata.sources.lines import prepared, stem

#: Origin lines in a span, by which paragraphs and lines meet.
SPAN = 64


def program_id(source_file: str = "source_file"):
    return node_id(source_file, F.lit("1"), F.lit("ProgramNode"))


def programs(expanded: DataFrame) -> DataFrame:
    """(program_uuid, source_file, program, program_type, start_line, end_line)."""
    whole = expanded.groupBy("source_file").agg(F.max("expanded_line_num").alias("end_line"))
    name = F.upper(stem("source_file"))
    return whole.select(program_id().alias("program_uuid"), "source_file", name.alias("program"), program_type(name).alias("program_type"), F.lit(1).alias("start_line"), "end_line")


def paragraph_names(expanded: DataFrame) -> DataFrame:
    """(source_file, program, idx, name, expanded_line): the paragraphs after PROCEDURE DIVISION, in order."""
    rows = prepared(expanded.select("source_file", F.col("expanded_line_num").alias("line_num"), F.col("content").alias("line")))
    heads = rows.where("procedure AND header IS NOT NULL")
    return heads.select("source_file", "program", (F.row_number().over(by("source_file", "line_num")) - 1).alias("idx"), F.col("header").alias("name"), F.col("line_num").alias("expanded_line"))


def paragraphs(expanded: DataFrame) -> DataFrame:
    """Paragraphs with their extent, statements and complexity; lines are those of the origin.

    A paragraph starts at the first line that begins with its name; the next one's start ends it, and the
    program's length the last. Counting stops at the first line whose origin lies beyond the end.
    """
    names = paragraph_names(expanded)
    lines = expanded.select("source_file", "expanded_line_num", "origin_line_num", F.upper(strip("content")).alias("t"))
    # a header is the first line that begins with its name, then a blank, a tab or a period
    first = F.regexp_extract("t", r"^([A-Z0-9][A-Z0-9-]*)[ \t.]", 1)
    starts = lines.withColumn("name", first).where("name <> ''").join(names.select("source_file", "name").distinct(), ["source_file", "name"])
    starts = starts.groupBy("source_file", "name").agg(F.min_by("origin_line_num", "expanded_line_num").alias("start_line"))
    total = expanded.groupBy("source_file").agg(F.max("expanded_line_num").alias("total_lines"))
    w = by("source_file", "idx")
    placed = names.join(starts, ["source_file", "name"], "left").join(total, "source_file")
    placed = placed.withColumn("start_line", F.coalesce("start_line", (F.col("idx") + 1) * 10))
    placed = placed.withColumn("end_line", F.coalesce(F.lead("start_line").over(w) - 1, "total_lines"))
    # counting stops at the first line whose origin lies beyond the end: the least over lines of that origin or a later one
    beyond = F.greatest("start_line", F.col("end_line") + 1)
    marks = lines.where("origin_line_num IS NOT NULL").select("source_file", F.col("origin_line_num").cast("long").alias("at"), F.col("expanded_line_num").alias("stop"), F.lit(None).cast("int").alias("idx"))
    marks = marks.unionByName(placed.select("source_file", beyond.cast("long").alias("at"), F.lit(None).cast(lines.schema["expanded_line_num"].dataType).alias("stop"), "idx"))
    later = upto(Window.partitionBy("source_file").orderBy(F.desc("at"), F.col("idx").asc_nulls_first()))
    stops = marks.withColumn("stop", F.min("stop").over(later)).where("idx IS NOT NULL").drop("at")
    # a line meets the paragraphs that reach into its span of origins, and not all of its file
    spans = placed.where("start_line <= end_line").select("source_file", "idx", "start_line", "end_line", F.explode(F.sequence(F.expr(f"start_line div {SPAN}"), F.expr(f"end_line div {SPAN}"))).alias("span"))
    near = spans.join(lines.withColumn("span", F.expr(f"origin_line_num div {SPAN}")), ["source_file", "span"]).where("origin_line_num BETWEEN start_line AND end_line")
    inside = near.join(stops, ["source_file", "idx"]).where("stop IS NULL OR expanded_line_num < stop")
    has = lambda p: F.col("t").rlike(p).cast("int")
    branches = has(r"\bIF\b") + has(r"\bEVALUATE\b") + has(r"\bWHEN\b") + has(r"\bPERFORM\s+(UNTIL|VARYING)\b")
    counts = inside.groupBy("source_file", "idx").agg(F.count_if(word("t").isin(*VERBS)).alias("statement_count"), (F.sum(branches) + 1).alias("complexity"))
    out = placed.join(counts, ["source_file", "idx"], "left")
    return out.select(
        node_id("source_file", "start_line", F.lit("ParagraphNode")).alias("uuid"), program_id().alias("program_uuid"), "program", "name", "idx", "source_file", "start_line", "end_line",
        F.greatest(F.lit(0), F.col("end_line") - F.col("start_line") + 1).alias("line_count"), F.coalesce("statement_count", F.lit(0)).cast("int").alias("statement_count"),
        F.coalesce("complexity", F.lit(1)).cast("int").alias("complexity"),
    )


def symbols(expanded: DataFrame) -> DataFrame:
    """Data items with canonical types and where they are defined.

    The definition is the first line that holds the name and PIC, by its origin's number; the copybook is that
    of the expanded line with the same number. Where no line has both, and for FILLER, it is the item's place.
    """
    lines = expanded.select("source_file", "expanded_line_num", "origin_line_num", "copybook", F.upper("content").alias("t"))
    items = data_items(expanded.select("source_file", F.col("expanded_line_num").alias("line_num"), F.col("content").alias("line")))
    defining = lines.where(F.col("t").contains("PIC"))
    found = items.where("name <> 'FILLER'").join(defining, "source_file").where(F.expr("contains(t, name)"))
    found = found.groupBy("source_file", "ordinal").agg(F.min_by("origin_line_num", "expanded_line_num").alias("at"))
    placed = items.join(found, ["source_file", "ordinal"], "left").withColumn("defined_at_line", F.coalesce("at", F.col("ordinal")))
    origin = lines.select("source_file", F.col("expanded_line_num").alias("defined_at_line"), F.col("copybook").alias("copybook_origin"))
    return placed.join(origin, ["source_file", "defined_at_line"], "left").select(
        node_id("source_file", "defined_at_line", F.concat(F.lit("DataItemNode:"), F.col("name"))).alias("uuid"), program_id().alias("program_uuid"), "program", "name", "level", "pic", "usage", "scope",
        normalize_pic("pic", "usage").alias("canonical_type"), "copybook_origin", "source_file", "defined_at_line", "ordinal",
    )


def ast_nodes(expanded: DataFrame) -> DataFrame:
    """Program and paragraph nodes: uuid, kind, source_file, start_line, end_line, parent_uuid, name, children_uuids."""
    paras = paragraphs(expanded)
    kids = paras.groupBy("source_file").agg(F.array_sort(F.collect_list(F.struct("idx", "uuid"))).alias("k"))
    tops = programs(expanded).join(kids, "source_file", "left").select(
        F.col("program_uuid").alias("uuid"), F.lit("ProgramNode").alias("kind"), "source_file", "start_line", "end_line", F.lit(None).cast("string").alias("parent_uuid"), F.col("program").alias("name"),
        F.coalesce(F.transform("k", lambda x: x["uuid"]), F.array().cast("array<string>")).alias("children_uuids"),
    )
    return tops.unionByName(paras.select("uuid", F.lit("ParagraphNode").alias("kind"), "source_file", "start_line", F.col("start_line").alias("end_line"), F.col("program_uuid").alias("parent_uuid"), "name", F.array().cast("array<string>").alias("children_uuids")))

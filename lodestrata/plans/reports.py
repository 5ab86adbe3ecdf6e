"""Reports over the store and the sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.operators import graph
from lodestrata.plans.api import Store

#: Paragraphs where a program begins; utilities that are no business programs.
ENTRIES = ("MAIN-PARA", "0000-MAIN", "MAIN", "000-MAIN", "A000-MAINLINE")
UTILITIES = ("IDCAMS", "SORT", "IEFBR14", "IKJEFT1B", "DFHCSDUP")


def unperformed(s: Store, entries: tuple[str, ...] = ENTRIES) -> DataFrame:
    """Paragraphs that nothing performs."""
    return graph.never_targeted(s["paragraphs"], "name", s["control_flow"], "to_uuid", entries)


def unread_symbols(s: Store) -> DataFrame:
    """Items of levels 5 and 77 that no statement reads."""
    reads = s["def_use"].where("operation = 'READ'").select(F.upper("data_item_uuid").alias("v")).distinct()
    rows = s["symbols"].where(F.col("level").isin(5, 77) & ~F.col("name").like("FILLER%"))
    return rows.join(reads, F.upper("name") == F.col("v"), "left_anti")  # variables are never null in the table


def unaccessed_files(files: DataFrame, s: Store) -> DataFrame:
    """Names of files that no program operates on."""
    return files.select(F.upper("name").alias("name")).subtract(s["file_io"].select(F.upper("file_name").alias("name")))


def empty_paragraphs(s: Store) -> DataFrame:
    return s["paragraphs"].where("statement_count IS NULL OR statement_count = 0").orderBy("source_file", "start_line")


def clones(s: Store, threshold: float = 0.6) -> DataFrame:
    """Programs whose sets of (statements, complexity) of paragraphs are alike."""
    rows = s["paragraphs"].where("statement_count > 0").select(F.expr("left(source_file, length(source_file) - 4)").alias("program"), "statement_count", "complexity")
    return graph.jaccard_pairs(rows, "program", ["statement_count", "complexity"], threshold).orderBy(F.desc("similarity"), "a", "b")


def corpus_tally(files: DataFrame) -> DataFrame:
    """(source_file, text) by kind of program: files, lines, REDEFINES and OCCURS."""
    up = F.upper("text")
    count = lambda w: F.size(F.regexp_extract_all(up, F.lit(rf"\b{w}\b"), F.lit(0)))
    rows = files.select(F.when(up.contains("EXEC CICS"), "online").otherwise("batch").alias("kind"), F.size(F.split("text", "\n")).alias("lines"), count("REDEFINES").alias("redefines"), count("OCCURS").alias("occurs"))
    return rows.groupBy("kind").agg(F.count("*").alias("files"), *(F.sum(c).alias(c) for c in ("lines", "redefines", "occurs")))


def duplicate_stems(files: DataFrame) -> DataFrame:
    """Stems that several files share."""
    return files.groupBy(F.upper(F.regexp_replace("source_file", r"\.[^.]*$", "")).alias("stem")).agg(F.count("*").alias("n"), F.array_sort(F.collect_list("source_file")).alias("files")).where("n > 1")


def program_totals(s: Store, most: int = 10) -> DataFrame:
    """Programs with the most symbols."""
    top = s["symbols"].join(s["nodes"].select(F.col("uuid").alias("program_uuid"), F.col("source_file").alias("f")), "program_uuid")
    return top.groupBy(F.col("f").alias("source_file")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source_file").limit(most)


def copybook_totals(s: Store, most: int = 10) -> DataFrame:
    return s["copybook_use"].groupBy("copybook_name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "copybook_name").limit(most)


def shared_files(s: Store, most: int = 10) -> DataFrame:
    """Files that the most programs use; ties by first appearance."""
    found = s["file_io"].groupBy("file_name").agg(F.count_distinct("program_uuid").alias("programs"), F.min(F.struct("source_file", "line_num")).alias("first"))
    return found.orderBy(F.desc("programs"), "first", "file_name").drop("first").limit(most)


def tally(rows: DataFrame, kind: str, **flags: Column) -> DataFrame:
    """Rows of each kind, and how many of them have each flag."""
    return rows.groupBy(kind).agg(F.count("*").alias("n"), *(F.count_if(c).alias(k) for k, c in flags.items()))


def format_tally(s: Store) -> DataFrame:
    """Data items by kind of their canonical type: how many, signed, packed, binary; most frequent first."""
    part = lambda p: F.get_json_object("canonical_type", f"$.{p}")
    rows = s["symbols"].where("canonical_type IS NOT NULL").select(part("kind").alias("kind"), *((F.coalesce(part(p), F.lit("false")) == "true").alias(p) for p in ("signed", "packed", "binary")))
    return tally(rows, "kind", signed=F.col("signed"), packed=F.col("packed"), binary=F.col("binary")).orderBy(F.desc("n"), "kind")


def module_tally(s: Store) -> DataFrame:
    """(module, item, n) of the optional modules: database tables, hierarchical calls by verb, queue calls by operation."""
    part = lambda t, module, c: s[t].groupBy(F.col(c).alias("item")).agg(F.count("*").alias("n")).select(F.lit(module).alias("module"), "item", "n")
    return reduce(DataFrame.unionByName, [part("db_io", "db2", "table_name"), part("ims_io", "ims", "operation"), part("mq_io", "mq", "operation")])


def category_counts(rows: DataFrame, category: Column | str, **distinct: str) -> DataFrame:
    """Rows by category and over all (a null category), with the distinct values of further columns."""
    return rows.rollup(F.col(category).alias("category") if isinstance(category, str) else category.alias("category")).agg(F.count("*").alias("n"), *(F.count_distinct(c).alias(k) for k, c in distinct.items()))


def nested_totals(rows: DataFrame, key: str, items: Column, flag) -> DataFrame:
    """(key, n, flagged): elements of each row's list, and those that have the flag, summed over the rows of a key."""
    return rows.groupBy(key).agg(F.coalesce(F.sum(F.size(items)), F.lit(0)).alias("n"), F.coalesce(F.sum(F.size(F.filter(items, flag))), F.lit(0)).alias("flagged"))


def parse_status(files: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """(source_file, kind, status, error, paragraphs): a failure is a row, with the reason and no paragraphs.

    `files` is (source_file, kind, text); a program (kind COBOL) needs a procedure division, any other source some text.
    """
    n = paragraphs.groupBy("source_file").agg(F.count("*").alias("paragraphs"))
    empty = F.coalesce(F.trim("text"), F.lit("")) == ""
    error = F.when(empty, "no text").when((F.col("kind") == "COBOL") & ~F.upper("text").contains("PROCEDURE DIVISION"), "no procedure division")
    rows = files.join(n, "source_file", "left").withColumn("error", error)
    return rows.select("source_file", "kind", F.when(F.col("error").isNull(), "success").otherwise("error").alias("status"), "error", F.when(F.col("error").isNull(), F.coalesce("paragraphs", F.lit(0))).otherwise(0).alias("paragraphs"))


def verification(s: Store) -> DataFrame:
    """(check, n): rows of every table, then rows that meet their program: symbols, paragraphs, copybooks."""
    tops = s["nodes"].select(F.col("uuid").alias("program_uuid"))
    joins = [s[t].join(tops, "program_uuid").agg(F.count("*").alias("n")).select(F.lit(f"{t} x nodes").alias("table"), "n") for t in ("symbols", "paragraphs", "copybook_use")]
    return reduce(DataFrame.unionByName, joins, row_counts(s)).withColumnRenamed("table", "check")


def samples(s: Store, name: str) -> DataFrame:
    """(layer, sample) of a program across the layers: its first paragraph, decimal item (else any of level 5), uses, file operations and rule."""
    own = lambda t: s[t].where(F.upper("source_file") == f"{name}.cbl".upper())
    take = lambda df, layer, n, order, *cols: df.orderBy(*order).limit(n).select(F.lit(layer).alias("layer"), F.concat_ws("|", *cols).alias("sample"))
    decimal = (~F.coalesce(F.col("canonical_type").contains("decimal"), F.lit(False))).cast("int")
    return reduce(DataFrame.unionByName, [
        take(own("paragraphs"), "L1", 1, ["start_line", "uuid"], "name", "start_line", "end_line"), take(own("symbols").where("level = 5"), "L2", 1, [decimal, "defined_at_line", "uuid"], "name", "pic"),
        take(own("def_use").where("operation = 'WRITE'"), "L3 writes", 2, ["line_num", "id"], "data_item_uuid", "line_num"), take(own("def_use").where("operation = 'READ'"), "L3 reads", 2, ["line_num", "id"], "data_item_uuid", "line_num"),
        take(s["file_io"].where(F.upper("program_uuid").like(f"%{name.upper()}%")), "L4", 2, ["line_num", "id"], "file_name", "operation"), take(own("business_rules"), "L5", 1, ["line_num", "uuid"], "kind", "predicate_raw"),
    ])


def row_counts(s: Store) -> DataFrame:
    return reduce(DataFrame.unionByName, (df.agg(F.count("*").alias("n")).select(F.lit(t).alias("table"), "n") for t, df in s.items()))


def coverage(files: DataFrame, kind: str, ok: Column) -> DataFrame:
    """Files parsed by kind and over all, with the pass rate to one place (half to even); 0 where there are none."""
    rate = F.when(F.col("total") == 0, 0.0).otherwise(F.bround(100.0 * F.col("passed") / F.col("total"), 1))
    return files.rollup(kind).agg(F.count("*").alias("total"), F.count_if(ok).alias("passed")).withColumn("pass_rate", rate)


def event_counts(events: DataFrame) -> DataFrame:
    """An event log's counts: (SUCCESS, FAILURE, GAP, WARNING) over all rows."""
    return events.agg(*(F.count_if(F.col("type") == t).alias(t.lower()) for t in ("SUCCESS", "FAILURE", "GAP", "WARNING")))


def mermaid(edges: DataFrame, source: str, target: str, label: Column | None = None, head: str = "graph TD") -> DataFrame:
    """(n, text): a chart's header line, then each distinct edge."""
    arrow = F.concat(F.lit("    "), F.col(source), F.lit(" -->"), *([F.lit("|"), label, F.lit("|")] if label is not None else []), F.lit(" "), F.col(target))
    rows = edges.select(arrow.alias("text")).distinct()
    return rows.sparkSession.createDataFrame([(0, head)], "n int, text string").unionByName(rows.select(F.lit(1).alias("n"), "text"))


def mermaid_charts(s: Store) -> dict[str, DataFrame]:
    calls = s["call_graph"].where("callee_uuid <> ''")
    flow = s["transaction_flow"].where("to_program_uuid <> ''")
    jobs = s["jcl_job"].where(F.col("program_name").isNotNull() & ~F.col("program_name").isin(*UTILITIES))
    named = F.concat("edge_type", F.when(F.coalesce("transid", F.lit("")) != "", F.concat(F.lit(":"), F.col("transid"))).otherwise(""))
    return {
        "call_graph": mermaid(calls, "caller_uuid", "callee_uuid", F.col("call_type")), "transaction_flow": mermaid(flow, "from_program_uuid", "to_program_uuid", named, "graph LR"),
        "jcl_chain": mermaid(jobs, "job_name", "program_name"), "file_io": mermaid(s["file_io"], "program_uuid", "file_name", F.col("operation")),
    }

"""A language-neutral intermediate representation of every program at once, its test seeds and its context slice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.functions.pic import CANONICAL, java_type
from lodestrata.functions.rewrite import camel_case, cics_call, file_call, mq_call, perform_call, predicate
from lodestrata.operators.windows import by
from lodestrata.plans.api import Store
from lodestrata.sources.lines import stem

#: Names of paragraphs that are entries.
ENTRIES = ("MAIN-PARA", "0000-MAIN", "MAIN")


def seam(programs: DataFrame, contexts: DataFrame, name: str = "program") -> DataFrame:
    """`programs` with seam: the first context, by `ord`, of (ord, context, member) that lists the program; else Unknown."""
    first = contexts.groupBy(F.upper("member").alias("_m")).agg(F.min_by("context", "ord").alias("seam"))
    return programs.join(first, F.upper(programs[name]) == first["_m"], "left").withColumn("seam", F.coalesce("seam", F.lit("Unknown"))).drop("_m")


def seams(programs: DataFrame, contexts: DataFrame) -> DataFrame:
    """Each context's programs, in order."""
    return seam(programs, contexts).groupBy("seam").agg(F.array_sort(F.collect_list("program")).alias("programs"))


def _program(c: str = "source_file") -> Column:
    return F.upper(stem(c))


def fields(s: Store) -> DataFrame:
    """Items of levels 1, 5 and 77 with their target types."""
    rows = s["symbols"].where(F.col("level").isin(1, 5, 77)).withColumn("ct", F.from_json("canonical_type", T.StructType.fromDDL(CANONICAL[7:-1])))
    rows = rows.withColumn("j", java_type(F.col("ct")))
    return rows.select(_program().alias("program"), "uuid", "name", camel_case("name").alias("java_name"), "level", "pic", "usage", "ct", "j.java_type", "j.python_type", "j.constraint", "j.note", "j.import", "copybook_origin", "defined_at_line")


def imports(rows: DataFrame) -> DataFrame:
    return rows.groupBy("program").agg(F.array_sort(F.collect_set("import")).alias("type_imports"))


def methods(s: Store, screens: DataFrame) -> DataFrame:
    """Paragraphs with the calls they make, their screen statements, and whether a program is entered there."""
    key = lambda f, n: F.concat_ws("\x00", F.upper(f), F.upper(n))
    calls = s["control_flow"].groupBy(key("source_file", "from_uuid").alias("k")).agg(F.array_sort(F.collect_list(F.struct("line_num", F.col("to_uuid").alias("target"), "edge_type", "condition", perform_call("edge_type").alias("call")))).alias("calls"))
    shown = screens.groupBy(key("source_file", "paragraph").alias("k")).agg(F.array_sort(F.collect_list(F.struct("line", "verb", cics_call("verb", F.col("params")).alias("java")))).alias("cics"))
    rows = s["paragraphs"].withColumn("k", key("source_file", "name")).join(calls, "k", "left").join(shown, "k", "left").drop("k")
    empty = lambda c, like: F.coalesce(c, F.slice(like, 1, 0), F.array().cast(rows.schema[c].dataType))
    return rows.select(
        _program().alias("program"), "uuid", "name", camel_case("name").alias("java_name"), "start_line", "end_line", "statement_count", "complexity",
        empty("calls", "calls").alias("calls"), empty("cics", "cics").alias("cics"), F.upper("name").isin(*ENTRIES).alias("is_entry"),
    )


def rules(s: Store) -> DataFrame:
    return s["business_rules"].select(_program().alias("program"), "uuid", "kind", F.col("predicate_raw").alias("predicate"), predicate("predicate_raw").alias("java_pattern"), "then_summary", "else_summary", F.col("line_num").alias("line"))


def io(s: Store) -> DataFrame:
    """(program, kind, resource, operation, java_pattern, line) of files, hierarchical databases, queues and transactions."""
    part = lambda t, kind, resource, java, p="program_uuid": s[t].select(F.upper(p).alias("program"), F.lit(kind).alias("kind"), F.col(resource).alias("resource"), F.col("edge_type" if t == "transaction_flow" else "operation").alias("operation"), java.alias("java_pattern"), F.col("line_num").alias("line"))
    tx = F.when(F.col("edge_type") == "XCTL", F.concat(F.lit('cicsXctl("'), F.col("to_program_uuid"), F.lit('", commArea)'))).otherwise(F.concat(F.lit('return CicsResponse.returnTo("'), F.coalesce("transid", F.lit("")), F.lit('", commArea)')))
    return reduce(DataFrame.unionByName, [
        part("file_io", "file", "file_name", file_call("operation")), part("ims_io", "ims", "segment_name", F.concat(F.lit("imsTemplate."), F.lower("operation"), F.lit('("'), F.col("segment_name"), F.lit('")'))),
        part("mq_io", "mq", "queue_name", mq_call("operation", "queue_name")), part("transaction_flow", "transaction", "to_program_uuid", tx, "from_program_uuid"),
    ])


def summary(s: Store, contexts: DataFrame) -> DataFrame:
    """Programs with their counts of fields, methods and rules, and their context: one job for all."""
    tops = s["nodes"].where("kind = 'ProgramNode'").select(_program().alias("program")).where("program <> ''").distinct()
    count = lambda df, n: df.groupBy("program").agg(F.count("*").alias(n))
    parts = [count(s["symbols"].where(F.col("level").isin(1, 5, 77)).select(_program().alias("program")), "fields"), count(s["paragraphs"].select(_program().alias("program")), "methods"), count(s["business_rules"].select(_program().alias("program")), "rules")]
    out = reduce(lambda a, b: a.join(b, "program", "left"), parts, tops).fillna(0, ["fields", "methods", "rules"])
    return seam(out, contexts)


def field_seeds(rows: DataFrame, name: str = "name", ct: str = "ct") -> DataFrame:
    """(name, case, value) of test values for each field: by the kind of its canonical type."""
    c = F.col(ct)
    n, prec, scale = F.coalesce(c["length"], F.lit(1)), F.coalesce(c["precision"], F.lit(9)), F.coalesce(c["scale"], F.lit(2))
    nines = lambda k: F.when(k > 0, F.repeat(F.lit("9"), k)).otherwise("0")
    # half of 99...9 (k digits) is 4 and then nines
    half = lambda k: F.when(k > 0, F.concat(F.lit("4"), F.repeat(F.lit("9"), k - 1))).otherwise("0")
    s = lambda case, value: F.struct(F.lit(case).alias("case"), value.alias("value"))
    text = F.array(s("empty", F.lit("")), s("max_length", F.repeat(F.lit("A"), n)), s("half_length", F.repeat(F.lit("A"), F.expr(f"coalesce({ct}.length, 1) div 2").cast("int"))), s("all_spaces", F.repeat(F.lit(" "), n)))
    whole = F.array(s("zero", F.lit("0")), s("max", nines(prec)), s("one", F.lit("1")))
    signed = F.array(s("negative_one", F.lit("-1")), s("min", F.concat(F.when(prec > 0, "-").otherwise(""), nines(prec))))
    money = F.array(s("zero", F.lit("0.00")), s("max", F.concat(nines(prec - scale), F.lit("."), F.repeat(F.lit("9"), scale))), s("min_positive", F.lit("0.01")), s("mid", F.concat(half(prec - scale), F.lit(".50"))))
    seeds = (
        F.when(c["kind"] == "alphanumeric", text)
        .when(c["kind"].isin("numeric", "binary"), F.when(F.coalesce(c["signed"], F.lit(False)), F.concat(whole, signed)).otherwise(whole))
        .when(c["kind"].isin("decimal", "packed_decimal"), money)
    )
    return rows.select(name, F.explode(seeds).alias("x")).select(name, "x.*")


def rule_seeds(rows: DataFrame) -> DataFrame:
    note = lambda verb: F.concat(F.lit(f"Inputs {verb}: "), F.left("predicate", F.lit(50)))
    cases = F.array(F.struct(F.lit("predicate_true").alias("scenario"), note("satisfy").alias("note")), F.struct(F.lit("predicate_false").alias("scenario"), note("violate").alias("note")))
    return rows.where(F.coalesce("predicate", F.lit("")) != "").select("program", "uuid", "predicate", "line", F.explode(cases).alias("x")).select("program", "uuid", "predicate", "line", "x.*")


def path_seeds(rows: DataFrame) -> DataFrame:
    """Each method that calls others, with its first three targets."""
    path = F.concat(F.array("name"), F.transform(F.slice("calls", 1, 3), lambda c: c["target"]))
    return rows.where(F.size("calls") > 0).select("program", F.col("name").alias("entry"), "uuid", path.alias("path"), F.concat(F.lit("complexity="), F.col("complexity")).alias("note"))


def prompt_summary(field_rows: DataFrame, method_rows: DataFrame, rule_rows: DataFrame, io_rows: DataFrame) -> DataFrame:
    """(program, section, ord, text): the first 30 fields, 15 methods, 10 rules and 5 file operations of each program, and two screen statements of each method."""
    ranked = lambda df, order, n: df.withColumn("ord", F.row_number().over(by("program", order))).where(F.col("ord") <= n)
    out = lambda df, section, text: df.select("program", F.lit(section).alias("section"), "ord", text.alias("text"))
    targets = F.array_join(F.transform(F.slice("calls", 1, 3), lambda c: F.concat(F.lit("'"), c["target"], F.lit("'"))), ", ")
    screens = method_rows.select("program", "start_line", F.posexplode(F.slice("cics", 1, 2)).alias("k", "c")).withColumn("ord", F.row_number().over(by("program", ["start_line", "k"])))
    return reduce(DataFrame.unionByName, [
        out(ranked(field_rows, ["defined_at_line", "uuid"], 30), "fields", F.concat(F.lit("  "), F.col("name"), F.lit(" ("), F.coalesce(F.nullif("pic", F.lit("")), F.lit("group")), F.lit(") → "), F.col("java_type"), F.lit(" // "), F.col("note"))),
        out(ranked(method_rows, ["start_line", "uuid"], 15), "methods", F.concat(F.lit("  "), F.col("name"), F.lit("() complexity="), F.col("complexity"), F.lit(" calls=["), targets, F.lit("]"))),
        out(ranked(rule_rows, ["line", "uuid"], 10), "rules", F.concat(F.lit("  if ("), F.col("java_pattern"), F.lit(") // line "), F.col("line"))),
        out(ranked(io_rows.where("kind = 'file'"), ["line", "resource"], 5), "io", F.concat(F.lit("  "), F.col("operation"), F.lit(" "), F.col("resource"), F.lit(" → "), F.col("java_pattern"))),
        out(screens, "cics", F.concat(F.lit("  CICS "), F.col("c.verb"), F.lit(" → "), F.col("c.java"))),
    ])


def _pad(c: Column | str, n: int, left: bool = False) -> Column:
    """Padded to n characters, never cut."""
    c = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.when(F.length(c) >= n, c).otherwise(F.lpad(c, n, " ") if left else F.rpad(c, n, " "))


def slice_extras(s: Store, moves: DataFrame) -> DataFrame:
    """(program, part, ord, text): the two parts of a slice that its text does not show, its transactions and its first 20 moves."""
    tx = s["transaction_flow"].select(F.upper("from_program_uuid").alias("program"), F.lit("transaction_flow").alias("part"), F.struct("line_num", "id").alias("o"), F.concat_ws(" ", "edge_type", F.coalesce("transid", F.lit("")), F.coalesce("to_program_uuid", F.lit(""))).alias("text"))
    mv = moves.select(F.upper("program").alias("program"), F.lit("move_chains").alias("part"), F.struct(F.col("line").alias("line_num"), F.col("source").alias("id")).alias("o"), F.concat(F.col("source"), F.lit(" -> "), F.array_join("targets", ",")).alias("text"))
    rows = tx.unionByName(mv).withColumn("ord", F.row_number().over(by(["program", "part"], "o")))
    return rows.where("part <> 'move_chains' OR ord <= 20").select("program", "part", "ord", "text")


def slice_rows(s: Store, screens: DataFrame, comments: DataFrame) -> DataFrame:
    """(program, section, ord, text): the lines of every program's context slice, in ten sections with their limits."""

    def section(df: DataFrame, k: int, title: str, order: list[str], n: int, *parts: Column | str) -> DataFrame:
        rows = df.withColumn("ord", F.row_number().over(Window.partitionBy("program").orderBy(*order))).where(F.col("ord") <= n)
        text = F.concat(*(F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts))
        body = rows.select("program", F.lit(k).alias("section"), "ord", text.alias("text"))
        heads = body.select("program").distinct()
        row = lambda o, t: heads.select("program", F.lit(k).alias("section"), F.lit(o).alias("ord"), F.lit(t).alias("text"))
        return body.unionByName(row(0, f"=== {title} ===")).unionByName(row(1 << 30, ""))

    c, all_ = F.col, 1 << 29
    own = lambda t, p=None: s[t].withColumn("program", _program() if p is None else F.upper(p))
    tops = s["nodes"].where("kind = 'ProgramNode'").withColumn("program", _program())
    books = s["copybook_use"].groupBy(F.col("program_uuid").alias("uuid")).agg(F.array_join(F.array_sort(F.collect_set("copybook_name")), ", ").alias("books"))
    kind = F.when(F.left("program", F.lit(2)) == "CO", "ONLINE").when(F.left("program", F.lit(2)) == "CB", "BATCH").otherwise("UNKNOWN")
    tops = tops.join(books, "uuid", "left").select("program", F.posexplode(F.array(F.concat(F.lit("=== PROGRAM: "), c("program"), F.lit(" ===")), F.concat(F.lit("Type: "), kind), F.concat(F.lit("Lines: "), c("end_line")), F.concat(F.lit("Copybooks: "), F.coalesce("books", F.lit(""))), F.lit(""))).alias("ord", "text"))
    ct = lambda p: F.get_json_object("canonical_type", f"$.{p}")
    typed = F.concat(F.coalesce(ct("kind"), F.lit("")), F.when(F.coalesce(ct("precision").cast("int"), F.lit(0)) > 0, F.concat(F.lit("("), ct("precision"), F.lit(")"))).otherwise(""), F.when(F.coalesce(ct("scale").cast("int"), F.lit(0)) > 0, F.concat(F.lit(" scale="), ct("scale"))).otherwise(""))
    said = F.regexp_replace(F.regexp_replace("text", r"^[*>]+", ""), r"^\s+|\s+$", "")
    noted = comments.withColumn("program", _program()).withColumn("said", said).where(F.length("said") > 5)
    shown = F.left(F.array_join(F.transform(F.map_entries("params"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", "), F.lit(60))
    tag = lambda col: F.concat(F.lit("  [UUID:"), c(col), F.lit("] "))
    parts = [
        section(noted, 1, "PROGRAM COMMENTS (business context)", ["line"], 15, "  Line ", _pad("line", 4, True), ": ", c("said")),
        section(own("paragraphs"), 2, "PARAGRAPHS", ["start_line", "uuid"], all_, tag("uuid"), _pad("name", 40), " lines ", _pad("start_line", 4, True), "-", _pad("end_line", 4, True), " stmts=", _pad("statement_count", 3, True), " complexity=", c("complexity")),
        section(own("symbols"), 3, "KEY DATA ITEMS (Working Storage)", ["defined_at_line", "uuid"], 20, tag("uuid"), "L", F.lpad(c("level").cast("string"), 2, "0"), " ", _pad("name", 35), " PIC ", _pad(F.coalesce("pic", F.lit("None")), 15), " ", typed, F.when(c("copybook_origin").isNotNull(), F.concat(F.lit(" [from "), c("copybook_origin"), F.lit("]"))).otherwise("")),
        section(own("file_io", "program_uuid"), 4, "FILE I/O", ["line_num", "id"], all_, "  ", _pad("operation", 15), " ", c("file_name"), " (line ", c("line_num"), ")"),
        section(screens.withColumn("program", _program()), 5, "EXEC CICS STATEMENTS", ["line"], all_, "  ", _pad("verb", 15), " ", shown, " (line ", c("line"), ", para=", c("paragraph"), ")"),
        section(own("call_graph", "caller_uuid"), 6, "PROGRAM CALLS", ["line_num", "id"], all_, tag("id"), _pad("call_type", 12), " -> ", _pad("call_target", 20), " (line ", c("line_num"), ")"),
        section(own("business_rules"), 7, "BUSINESS RULES (IF/EVALUATE)", ["line_num", "uuid"], 10, tag("uuid"), _pad("kind", 10), " line ", _pad("line_num", 4, True), ": ", F.left("predicate_raw", F.lit(60)), F.when(c("then_summary") != "", F.concat(F.lit("\n    THEN: "), c("then_summary"))).otherwise(""), F.when(c("else_summary") != "", F.concat(F.lit("\n    ELSE: "), c("else_summary"))).otherwise("")),
        section(own("def_use"), 8, "DEF-USE CHAINS", ["line_num", "id"], 15, tag("id"), _pad("operation", 6), " ", _pad("data_item_uuid", 30), " line ", _pad("line_num", 4, True)),
        section(own("control_flow"), 9, "CONTROL FLOW GRAPH", ["line_num", "id"], 15, tag("id"), _pad("from_uuid", 30), " --", c("edge_type"), "--> ", c("to_uuid"), F.when(c("condition").isNotNull(), F.concat(F.lit(" ["), F.left("condition", F.lit(30)), F.lit("]"))).otherwise(""), " (line ", c("line_num"), ")"),
    ]
    return reduce(DataFrame.unionByName, parts, tops.select("program", F.lit(0).alias("section"), "ord", "text"))


def slices(rows: DataFrame) -> DataFrame:
    """(program, context): each program's slice as one text."""
    parts = F.array_sort(F.collect_list(F.struct("section", "ord", "text")))
    return rows.groupBy("program").agg(F.array_join(F.transform(parts, lambda r: r["text"]), "\n").alias("context"))

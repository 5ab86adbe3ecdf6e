"""The queries of the store, one function for each route. What is not found is an empty frame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.ids import node_id
from lodestrata.operators import graph

Store = dict[str, DataFrame]


def either(df: DataFrame, sought: dict[str, str]) -> DataFrame:
    """Rows of which a column holds its value, in any case. A saved table has an upper-cased twin of the column, whose
    comparison with a constant reaches the Parquet reader; the twins are not shown."""
    upper = lambda c: F.col(f"{c}_uc") if f"{c}_uc" in df.columns else F.upper(F.col(c).cast("string"))
    found = df.where(reduce(lambda a, b: a | b, (upper(c) == F.lit(v.upper()) for c, v in sought.items())))
    return shown(found)


def shown(df: DataFrame) -> DataFrame:
    return df.drop(*(c for c in df.columns if c.endswith("_uc")))


def _file(df: DataFrame, program: str) -> DataFrame:
    return either(df, {"source_file": f"{program}.cbl"})


def health(s: Store) -> DataFrame:
    """The store's state: ok where its first table holds a program."""
    some = F.max((F.col("kind") == "ProgramNode").cast("int")) == 1
    return s["nodes"].agg(F.when(some, "ok").otherwise("empty").alias("status"), F.coalesce(some, F.lit(False)).alias("db_exists"))


def ask(s: Store, sql: str, *args: object) -> DataFrame:
    """A statement over the store's tables, written {nodes}, with its parameters (written ?) bound, never pasted."""
    spark = s["nodes"].sparkSession
    return spark.sql(sql, args=list(args), **{k: v for k, v in s.items() if f"{{{k}}}" in sql})


def program(s: Store, name: str) -> DataFrame:
    """A program's node with its paragraphs in order, its symbol count and its copybooks: of that program only."""
    node = _file(s["nodes"].where("kind = 'ProgramNode'"), name)
    own = lambda t: s[t].join(node.select(F.col("uuid").alias("program_uuid")), "program_uuid", "left_semi").groupBy("program_uuid")
    paras = own("paragraphs").agg(F.array_sort(F.collect_list(F.struct("start_line", "name", "uuid", "complexity"))).alias("paragraphs"))
    symbols = own("symbols").agg(F.count("*").alias("symbol_count"))
    books = own("copybook_use").agg(F.array_sort(F.collect_set("copybook_name")).alias("copybooks"))
    return reduce(lambda a, b: a.join(b.withColumnRenamed("program_uuid", "uuid"), "uuid", "left"), [paras, symbols, books], node)


def find_program(s: Store, key: str) -> DataFrame:
    """The program that has the id, or the name, `key`."""
    tops = s["nodes"].where("kind = 'ProgramNode'")
    named = _file(tops, key).select("uuid")
    return shown(tops.where(F.col("uuid") == key).select("uuid").unionByName(named).distinct().join(tops, "uuid"))


def children(s: Store, uuid: str) -> DataFrame:
    """The nodes below a node, in order, with their parent's file."""
    p = shown(s["nodes"]).where(F.col("uuid") == uuid).select(F.col("uuid").alias("parent_uuid"), F.col("source_file").alias("parent_file"))
    return shown(s["nodes"]).join(p, "parent_uuid").orderBy("start_line", "uuid")


def first_symbols(s: Store, program_uuid: str, most: int = 20) -> DataFrame:
    return shown(s["symbols"]).where(F.col("program_uuid") == program_uuid).orderBy("defined_at_line", "uuid").limit(most)


def paragraph_program(s: Store, uuid: str) -> DataFrame:
    """A paragraph with its program's file and end."""
    tops = s["nodes"].select(F.col("uuid").alias("program_uuid"), F.col("source_file").alias("program_file"), F.col("end_line").alias("program_end"))
    return shown(s["paragraphs"]).where(F.col("uuid") == uuid).join(tops, "program_uuid")


def control_flow(s: Store, name: str) -> DataFrame:
    return _file(s["control_flow"], name).orderBy("line_num", "id")


def resolved_flow(s: Store) -> DataFrame:
    """Edges with the paragraph ids of both ends, by name and file."""
    names = s["paragraphs"].select("name", "source_file", F.col("uuid").alias("id"))
    return graph.double_resolve(shown(s["control_flow"]).drop("program_uuid", "id"), "from_uuid", "to_uuid", names, "name", ["source_file"], "id")


def paragraph(s: Store, uuid: str, screens: DataFrame | None = None, statements: DataFrame | None = None) -> DataFrame:
    """A paragraph with its outgoing edges (and the ids that they lead to), the rules in its lines, and, of the frames that
    the extractors give, its screen statements and the statements of the first paragraph of its name. One paragraph is
    looked up first; the other tables meet that row only."""
    one = shown(s["paragraphs"]).where(F.col("uuid") == uuid)
    key = F.broadcast(one.select("uuid", F.upper("name").alias("_n"), F.upper("source_file").alias("_f"), "start_line", "end_line"))

    def mine(df: DataFrame, name: str | None, row: Column, out: str) -> DataFrame:
        rows = df.select(*([F.upper(name).alias("_n")] if name else []), F.upper("source_file").alias("_f"), row.alias("r"))
        return rows.join(key, ["_n", "_f"] if name else ["_f"]).select("uuid", "start_line", "end_line", "r").alias(out)

    ids = shown(s["paragraphs"]).groupBy(F.upper("name").alias("_t"), F.upper("source_file").alias("_tf")).agg(F.min_by("uuid", "start_line").alias("to_id"))
    flow = s["control_flow"].join(ids, (F.upper("to_uuid") == F.col("_t")) & (F.upper("source_file") == F.col("_tf")), "left")
    edges = mine(flow, "from_uuid", F.struct("line_num", "to_uuid", "edge_type", "condition", "to_id"), "e").groupBy("uuid").agg(F.array_sort(F.collect_list("r")).alias("performs"))
    inside = mine(s["business_rules"], None, F.struct("line_num", "kind", "predicate_raw"), "r").where("r.line_num BETWEEN start_line AND end_line")
    parts = [edges, inside.groupBy("uuid").agg(F.array_sort(F.collect_list("r")).alias("rules"))]
    if screens is not None:
        parts.append(mine(screens, "paragraph", F.struct("line", "verb", "params"), "c").groupBy("uuid").agg(F.sort_array(F.collect_list(F.struct("r.line", "r.verb", F.map_entries("r.params").alias("params")))).alias("cics")))
    if statements is not None:
        parts.append(mine(statements, "paragraph", F.struct("line", "type", "raw"), "s").groupBy("uuid").agg(F.array_sort(F.collect_list("r")).alias("statements")))
    return reduce(lambda a, b: a.join(b, "uuid", "left"), parts, one)


def data_item(s: Store, uuid: str) -> DataFrame:
    return shown(s["symbols"]).where(F.col("uuid") == uuid)


def callers(s: Store, name: str) -> DataFrame:
    return either(s["call_graph"], {"callee_uuid": name, "call_target": name})


def callees(s: Store, name: str) -> DataFrame:
    return either(s["call_graph"], {"caller_uuid": name}).orderBy("line_num", "id")


def file_accesses(s: Store, name: str) -> DataFrame:
    return either(s["file_io"], {"program_uuid": name}).orderBy("line_num", "id")


def transaction_flow(s: Store, name: str) -> DataFrame:
    """Edges of a transaction or program: one step."""
    return either(s["transaction_flow"], {"transid": name, "from_program_uuid": name, "to_program_uuid": name})


def job_chain(s: Store, job: str, chains: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """A job's steps, its dependencies on either side, and the known chains (chain_name, jobs) that it is in."""
    steps = either(s["jcl_job"], {"job_name": job})
    deps = either(s["jcl_dependency"], {"producer_job": job, "consumer_job": job})
    known = chains.where(F.exists("jobs", lambda j: F.upper(j) == job.upper())) if chains is not None else None
    return steps, deps, known


def copybook_consumers(s: Store, name: str) -> DataFrame:
    return either(s["copybook_use"], {"copybook_name": name}).select(F.col("program_uuid").alias("program"), "copybook_name", "source_file")


def retrieve(s: Store, uuid: str, screens: DataFrame | None = None) -> DataFrame:
    """The first of the tables that know an id: kind of record, its row as JSON. `screens` (with a column uuid) is the last of them."""
    order = (("nodes", "uuid"), ("symbols", "uuid"), ("paragraphs", "uuid"), ("business_rules", "uuid"), ("control_flow", "id"), ("call_graph", "id"), ("def_use", "id"), ("ims_io", "id"), ("mq_io", "id"), ("transaction_flow", "id"))
    tables = [(t, k, shown(s[t])) for t, k in order] + ([("cics", "uuid", screens)] if screens is not None else [])
    parts = [df.where(F.col(k) == uuid).select(F.lit(n).alias("prio"), F.lit(t).alias("table"), F.col(k).alias("id"), F.to_json(F.struct(*df.columns)).alias("record")) for n, (t, k, df) in enumerate(tables)]
    found = reduce(DataFrame.unionByName, parts)
    return found.withColumn("_rn", F.row_number().over(Window.partitionBy("id").orderBy("prio", "record"))).where("_rn = 1").drop("_rn", "prio")


def def_use(s: Store, name: str, most: int = 50) -> DataFrame:
    """Variables of a program in order of first use: lines that read and write them."""
    rows = _file(s["def_use"], name)
    pick = lambda op: F.array_sort(F.collect_list(F.when(F.col("operation") == op, F.struct("line_num", "stmt_text"))))
    return rows.groupBy(F.col("data_item_uuid").alias("variable")).agg(F.min("line_num").alias("first"), pick("READ").alias("reads"), pick("WRITE").alias("writes")).orderBy("first", "variable").limit(most)


def def_use_totals(s: Store, name: str) -> DataFrame:
    return _file(s["def_use"], name).agg(F.count_distinct("data_item_uuid").alias("total_vars"), F.count_if(F.col("operation") == "READ").alias("total_reads"), F.count_if(F.col("operation") == "WRITE").alias("total_writes"))


def business_rules(s: Store, program_name: str) -> DataFrame:
    return shown(s["business_rules"]).where(F.col("program_uuid") == program_name).orderBy("line_num", "uuid")


def paragraph_class(name: Column, first: Column) -> Column:
    has = lambda *w: reduce(lambda a, b: a | b, (F.upper(name).contains(x) for x in w))
    return F.when(first, "main").when(has("SEND", "RECEIVE", "SCREEN", "RETURN"), "screen").when(has("ABEND", "ERROR", "9999"), "error").otherwise("process")


def flow_chart(s: Store, name: str) -> tuple[DataFrame, DataFrame]:
    """Nodes of a program's flow chart in a grid of 4 columns, with their class and band, and edges between known nodes."""
    paras = _file(s["paragraphs"], name)
    n = F.row_number().over(Window.partitionBy("source_file").orderBy("start_line", "uuid")) - 1
    band = F.when(F.col("complexity") > 15, "high").when(F.col("complexity") > 8, "medium").otherwise("low")
    nodes = paras.withColumn("n", n).select("uuid", "name", "start_line", "complexity", paragraph_class(F.col("name"), F.col("n") == 0).alias("class"), (F.col("n") % 4).alias("grid_col"), F.expr("n div 4").cast("int").alias("grid_row"), band.alias("band"))
    known = nodes.select(F.upper("name").alias("k"))
    edges = control_flow(s, name).join(known, F.upper("from_uuid") == F.col("k"), "left_semi").join(known, F.upper("to_uuid") == F.col("k"), "left_semi")
    return nodes, edges


def connectivity(s: Store, name: str, most: int = 20) -> DataFrame:
    """Rows (relation, other) of all that a program is connected with: calls, transfers, copybooks, their sharers, files, jobs, transactions."""
    own = _file(s["nodes"].where("kind = 'ProgramNode'"), name).select(F.col("uuid").alias("program_uuid"))
    books = s["copybook_use"].join(own, "program_uuid", "left_semi")
    sharers = s["copybook_use"].join(books.select("copybook_name").distinct(), "copybook_name", "left_semi").join(own, "program_uuid", "left_anti").join(s["nodes"].select(F.col("uuid").alias("program_uuid"), F.col("source_file").alias("f")), "program_uuid")
    calls = callees(s, name)
    row = lambda df, kind, c: df.select(F.lit(kind).alias("relation"), F.col(c).alias("other")).distinct()
    parts = [
        row(calls.where("call_type = 'CALL'"), "calls", "callee_uuid"), row(calls.where("call_type <> 'CALL'"), "transfers", "callee_uuid"), row(callers(s, name), "called_by", "caller_uuid"),
        row(books, "copybooks", "copybook_name"), row(sharers, "shares_copybook", "f").orderBy("other").limit(most), row(file_accesses(s, name), "files", "file_name"),
        row(either(s["jcl_job"], {"program_name": name}), "jobs", "job_name"),
        row(transaction_flow(s, name).where("edge_type = 'XCTL'"), "transactions", "to_program_uuid"),
    ]
    return reduce(DataFrame.unionByName, parts)


def connectivity_counts(s: Store, name: str) -> DataFrame:
    return connectivity(s, name).groupBy("relation").agg(F.count("*").alias("n"))


def ims(s: Store, program_name: str | None = None, segment: str | None = None) -> DataFrame:
    rows = s["ims_io"]
    for c, v in (("program_uuid", program_name), ("segment_name", segment)):
        rows = either(rows, {c: v}) if v else rows
    return shown(rows).orderBy("program_uuid", "line_num", "id")


def mq(s: Store, program_name: str | None = None, queue: str | None = None) -> DataFrame:
    rows = s["mq_io"]
    for c, v in (("program_uuid", program_name), ("queue_name", queue)):
        rows = either(rows, {c: v}) if v else rows
    return shown(rows).orderBy("program_uuid", "line_num", "id")


def data_formats(s: Store, name: str) -> DataFrame:
    """Kinds of a program's data items: how many and the first five, most frequent kind first."""
    rows = _file(s["symbols"], name).withColumn("kind", F.coalesce(F.get_json_object("canonical_type", "$.kind"), F.lit("unknown")))
    item = F.struct("defined_at_line", "name", "pic")
    out = rows.groupBy("kind").agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_list(item)), 1, 5).alias("first"), F.min("defined_at_line").alias("at"))
    return out.orderBy(F.desc("n"), "at", "kind").drop("at")


def explore(s: Store) -> DataFrame:
    return s["nodes"].where("kind = 'ProgramNode'").select("uuid", "source_file", "end_line").orderBy("source_file")


def complexity(s: Store, key: str) -> DataFrame:
    """The highest complexity of a program's paragraphs; 1 where it has none."""
    own = find_program(s, key).select(F.col("uuid").alias("program_uuid"))
    return own.join(s["paragraphs"], "program_uuid", "left").groupBy("program_uuid").agg(F.coalesce(F.max("complexity"), F.lit(1)).alias("most"))


def db2(s: Store, indexes: DataFrame | None = None) -> DataFrame:
    """Tables of the relational database with their columns and how many indexes each has."""
    rows = shown(s["db_io"]).where("operation = 'SCHEMA'").select("table_name", "columns")
    if indexes is None:
        return rows.withColumn("indexes", F.lit(0).cast("long")).orderBy("table_name")
    per = indexes.groupBy(F.upper("table_name").alias("_t")).agg(F.count("*").alias("indexes"))
    return rows.join(per, F.upper("table_name") == F.col("_t"), "left").drop("_t").fillna(0, ["indexes"]).orderBy("table_name")


def vsam(schemas: DataFrame) -> DataFrame:
    """The files' schemas, each with the id of its dataset."""
    return schemas.withColumn("uuid", node_id("dsn")).orderBy("dsn", "name")


def gdg(references: DataFrame) -> DataFrame:
    """Data groups and what refers to their generations, both with ids."""
    one = F.struct("job_name", "generation", "dd_name", "disposition", node_id("base_dsn", "job_name", "generation").alias("uuid"))
    return references.groupBy("base_dsn").agg(F.array_sort(F.collect_list(one)).alias("references")).withColumn("uuid", node_id("base_dsn")).orderBy("base_dsn")


def neighbourhood(s: Store, name: str, kind: str = "program") -> tuple[DataFrame, DataFrame]:
    """Nodes and links one step around a program, paragraph, copybook or job, each once: the first of an id, the first of a pair of ends."""
    spark = s["nodes"].sparkSession
    row = lambda df, relation, c: df.select(F.lit(relation).alias("relation"), F.upper(c).alias("other")).distinct()
    if kind == "program":
        around = connectivity(s, name)
    elif kind == "paragraph":
        flow = s["control_flow"]
        around = row(either(flow, {"from_uuid": name}), "performs", "to_uuid").unionByName(row(either(flow, {"to_uuid": name}), "performed_by", "from_uuid"))
    elif kind == "copybook":
        around = row(copybook_consumers(s, name).withColumn("p", F.regexp_replace("source_file", r"\.[^.]*$", "")), "program", "p")
    elif kind == "job":
        steps, deps, _ = job_chain(s, name)
        around = reduce(DataFrame.unionByName, [row(steps.where("coalesce(program_name, '') <> ''"), "program", "program_name"), row(deps.where(F.upper("producer_job") == name.upper()), "feeds", "consumer_job"), row(deps.where(F.upper("consumer_job") == name.upper()), "fed_by", "producer_job")])
    else:
        raise ValueError(f"no such kind of node: {kind}")
    around = around.withColumn("ord", F.struct(F.lit(1).alias("step"), F.col("relation").alias("relation")))
    start = spark.createDataFrame([(name.upper(), kind)], "id string, type string").withColumn("ord", F.struct(F.lit(0).alias("step"), F.lit("").alias("relation")))
    nodes = start.unionByName(around.select(F.col("other").alias("id"), F.col("relation").alias("type"), "ord"))
    links = around.select(F.lit(name.upper()).alias("source"), F.col("other").alias("target"), F.col("relation").alias("type"), "ord")
    return graph.merge_graphs(nodes, links)


def by_type(nodes: DataFrame, links: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Nodes of a type, and links with such a node at either end."""
    kept = nodes.where(F.col("type") == kind)
    ids = kept.select(F.col("id").alias("_id"))
    near = links.join(ids, links["source"] == ids["_id"], "left_semi").unionByName(links.join(ids, links["target"] == ids["_id"], "left_semi"))
    return kept, near.dropDuplicates(["source", "target"])

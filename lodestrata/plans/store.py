"""The 17 fact tables: schemas, loading, and reading back."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.functions.ids import edge_id, node_id
from lodestrata.operators import expand as copy
from lodestrata.operators import extract as x
from lodestrata.operators import graph, structure
from lodestrata.operators.windows import first_wins
from lodestrata.sources import catalogs
from lodestrata.sources.lines import prepared

#: Columns of the tables, in order.
SCHEMAS = {
    "nodes": "uuid string, kind string, source_file string, start_line int, end_line int, start_col int, end_col int, parent_uuid string, copybook string, payload_json string, created_at timestamp_ntz",
    "symbols": "uuid string, program_uuid string, name string, level int, pic string, usage string, scope string, canonical_type string, copybook_origin string, source_file string, defined_at_line int, payload_json string",
    "paragraphs": "uuid string, program_uuid string, name string, source_file string, start_line int, end_line int, line_count int, statement_count int, complexity int, payload_json string",
    "call_graph": "id string, caller_uuid string, callee_uuid string, call_site_uuid string, call_type string, call_target string, is_dynamic boolean, source_file string, line_num int",
    "control_flow": "id string, program_uuid string, from_uuid string, to_uuid string, edge_type string, condition string, source_file string, line_num int",
    "def_use": "id string, data_item_uuid string, operation string, stmt_uuid string, stmt_text string, source_file string, line_num int",
    "file_io": "id string, program_uuid string, file_name string, operation string, record_copybook string, stmt_uuid string, source_file string, line_num int",
    "db_io": "id string, program_uuid string, table_name string, columns string, operation string, cursor_name string, stmt_uuid string, source_file string, line_num int",
    "ims_io": "id string, program_uuid string, segment_name string, operation string, pcb_name string, source_file string, line_num int",
    "mq_io": "id string, program_uuid string, queue_name string, operation string, correlation_id string, source_file string, line_num int",
    "transaction_flow": "id string, from_program_uuid string, to_program_uuid string, edge_type string, transid string, commarea_size int, stmt_uuid string, source_file string, line_num int",
    "screen_map": "id string, program_uuid string, map_name string, mapset_name string, operation string, field_name string, commarea_field string, source_file string, line_num int",
    "jcl_job": "id string, job_name string, step_name string, program_name string, dd_name string, dataset_name string, disposition string, steplib string, parm string, source_file string, line_num int",
    "jcl_dependency": "id string, producer_job string, consumer_job string, dataset_name string, producer_disp string, consumer_disp string",
    "copybook_use": "id string, program_uuid string, copybook_name string, replacing_rules string, source_file string, line_num int",
    "business_rules": "uuid string, program_uuid string, kind string, predicate_raw string, predicate_resolved string, then_summary string, else_summary string, source_file string, line_num int",
    "migration_risk": "uuid string, program_uuid string, kind string, note string, severity string, stmt_uuid string, source_file string, line_num int",
}


#: Columns that look-ups ask for in any case.
LOOKUPS = (
    "source_file", "program_uuid", "caller_uuid", "callee_uuid", "call_target", "job_name", "program_name", "copybook_name", "from_program_uuid", "to_program_uuid", "transid", "producer_job", "consumer_job",
    "segment_name", "queue_name", "table_name", "name",
)


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """`df` in the table's columns and types; columns that it lacks are null."""
    have = set(df.columns)
    return df.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(table)))


@dataclass
class Sources:
    """Tables of lines (source_file, line_num, line); copybooks have name for source_file; ddl is (source_file, text)."""

    programs: DataFrame
    copybooks: DataFrame
    jcl: DataFrame | None = None
    bms: DataFrame | None = None
    csd: DataFrame | None = None
    dbd: DataFrame | None = None
    ddl: DataFrame | None = None
    extra: dict[str, DataFrame] = field(default_factory=dict)


def build(src: Sources, full: DataFrame | None = None) -> dict[str, DataFrame]:
    """All tables; `full` is the expanded programs where the caller has them (persist them: six tables read them). Names stay names where the tables hold names (see the README); ids are hashes of natural keys."""
    spark = src.programs.sparkSession
    full = copy.expand(src.programs, src.copybooks) if full is None else full
    own = prepared(src.programs)
    ids = structure.programs(full).select("source_file", "program_uuid", "program")
    nodes = structure.ast_nodes(full)
    payload = F.to_json(F.struct(F.when(F.col("kind") == "ProgramNode", F.col("name")).alias("program_name"), F.when(F.col("kind") == "ParagraphNode", F.col("name")).alias("name"), "children_uuids"))
    out = {"nodes": first_wins(nodes.withColumns({"payload_json": payload, "start_col": F.lit(1), "end_col": F.lit(72), "created_at": F.localtimestamp()}), ["uuid"], ["source_file", "start_line"])}
    out["symbols"] = first_wins(structure.symbols(full).withColumn("canonical_type", F.to_json("canonical_type")), ["uuid"], ["source_file", "ordinal"])
    out["paragraphs"] = first_wins(structure.paragraphs(full), ["uuid"], ["source_file", "idx"])
    calls, screens = x.call_graph(own), x.cics(own)
    out["call_graph"] = calls.select(edge_id("call", "caller", "callee", "call_type", "line", "source_file").alias("id"), F.col("caller").alias("caller_uuid"), F.col("callee").alias("callee_uuid"), "call_type", F.col("callee").alias("call_target"), "is_dynamic", "source_file", F.col("line").alias("line_num"))
    flow = x.control_flow(own).join(ids.select("source_file", "program_uuid"), "source_file", "left")
    out["control_flow"] = flow.select(edge_id("flow", "source_file", "from_paragraph", "to_paragraph", "line").alias("id"), F.coalesce("program_uuid", "program").alias("program_uuid"), F.col("from_paragraph").alias("from_uuid"), F.col("to_paragraph").alias("to_uuid"), "edge_type", "condition", "source_file", F.col("line").alias("line_num"))
    out["def_use"] = x.def_use(x.statements(own)).select(edge_id("use", "source_file", "line", "variable", "operation").alias("id"), F.col("variable").alias("data_item_uuid"), "operation", "stmt_text", "source_file", F.col("line").alias("line_num"))
    out["file_io"] = x.file_io(own).select(edge_id("file", "source_file", "line", "file_name", "operation").alias("id"), F.col("program").alias("program_uuid"), "file_name", "operation", "source_file", F.col("line").alias("line_num"))
    dli = x.dli(own)
    out["ims_io"] = dli.select(edge_id("ims", "source_file", "line", "verb").alias("id"), F.col("program").alias("program_uuid"), F.col("segment").alias("segment_name"), F.col("verb").alias("operation"), F.when(F.col("pcb") != "", F.col("pcb")).alias("pcb_name"), "source_file", F.col("line").alias("line_num"))
    mq = first_wins(x.mq_calls(own), ["program", "verb", "line"], ["source_file", "using"])
    out["mq_io"] = mq.select(edge_id("mq", "source_file", "line", "verb").alias("id"), F.col("program").alias("program_uuid"), F.col("queue").alias("queue_name"), x.mq_operation(F.col("verb")).alias("operation"), "source_file", F.col("line").alias("line_num"))
    rules = x.business_rules(own)
    out["business_rules"] = rules.select(edge_id("rule", "source_file", "line", "kind").alias("uuid"), F.col("program").alias("program_uuid"), "kind", "predicate_raw", F.lit("{}").alias("predicate_resolved"), "then_summary", "else_summary", "source_file", F.col("line").alias("line_num"))
    uses = copy.copy_uses(own, src.copybooks).where("found").join(ids, "source_file")
    out["copybook_use"] = uses.select(edge_id("copy", "source_file", "copybook").alias("id"), "program_uuid", F.col("copybook").alias("copybook_name"), F.lit("[]").alias("replacing_rules"), "source_file", F.lit(0).alias("line_num"))
    empty = spark.createDataFrame([], "program string, name string, source_file string, ordinal int")
    transactions = catalogs.csd_kind(catalogs.csd(src.csd), "TRANSACTION") if src.csd is not None else empty
    moves = graph.transaction_flow(calls, screens, transactions)
    out["transaction_flow"] = moves.select(edge_id("tx", "source_file", "from_program", "to_program", "edge_type", "line").alias("id"), F.col("from_program").alias("from_program_uuid"), F.col("to_program").alias("to_program_uuid"), "edge_type", F.col("from_transid").alias("transid"), "commarea_size", "source_file", F.col("line").alias("line_num"))
    if src.jcl is not None:
        jobs = catalogs.jcl(src.jcl)
        out["jcl_job"] = jobs.select(edge_id("job", "source_file", "job_name", "step_name", "dd_name", "dataset_name").alias("id"), *(c for c in jobs.columns if c != "line_num"), F.lit(0).alias("line_num"))
        deps = graph.dependencies(jobs, "job_name", graph.base_dataset("dataset_name"), "disposition", order="line_num")
        out["jcl_dependency"] = deps.select(node_id("producer_job", "consumer_job", "dataset_name").alias("id"), "*")
    if src.ddl is not None:
        tables = catalogs.ddl(src.ddl)
        names = F.array_join(F.transform(F.slice("columns", 1, 10), lambda c: c["name"]), ",")
        out["db_io"] = tables.select(edge_id("ddl", "source_file", "table_name").alias("id"), F.lit("DB2_DDL").alias("program_uuid"), "table_name", names.alias("columns"), F.lit("SCHEMA").alias("operation"), "source_file", F.lit(0).alias("line_num"))
    none = lambda t: spark.createDataFrame([], schema(t))
    return {t: conform(out[t], t) if t in out else none(t) for t in SCHEMAS}


def save(tables: dict[str, DataFrame], path: str) -> None:
    """Rebuild the store at `path`, a Parquet folder for each table, with upper-cased look-up columns for pushdown."""
    for name, df in tables.items():
        rebuild(name, df, path)


def rebuild(name: str, df: DataFrame, path: str) -> None:
    """Replace one table of the store at `path`."""
    keys = [c for c in LOOKUPS if c in df.columns]
    df.withColumns({f"{c}_uc": F.upper(c) for c in keys}).write.mode("overwrite").parquet(f"{path}/{name}")


def load(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables with their look-up columns, which the routes filter by and do not show."""
    return {name: spark.read.parquet(f"{path}/{name}") for name in SCHEMAS}


def save_json(df: DataFrame, path: str) -> None:
    """An artifact as JSON, a row a line."""
    df.write.mode("overwrite").json(path)


def load_json(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """An artifact's rows, from JSON lines or one document a file; what is missing is empty, what is no JSON is null."""
    try:
        return spark.read.schema(ddl).option("multiLine", False).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def insert_absent(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """`old` and the rows of `new` whose key it lacks, the first of each."""
    fresh = first_wins(new.join(old.select(key), key, "left_anti"), [key], [F.xxhash64(*new.columns)])
    return old.unionByName(fresh)

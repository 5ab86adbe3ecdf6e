"""Sources, routes, reports and intermediate representation bound to the fixture, with rows checked by hand against its texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata import fixtures as fx
from lodestrata.bindings import _full, _programs, _store, _text, fixture
from lodestrata.functions.text import json_map
from lodestrata.operators import expand, extract, graph
from lodestrata.plans import api, ir, reports
from lodestrata.sources import catalogs
from lodestrata.sources.lines import dedup_stems, inventory


@fixture("source_file VARCHAR", [('part.parquet',), ('nation.parquet',), ('region.parquet',)])
def files_inventory(spark, d):
    return inventory(spark, d, "*.parquet").select("source_file").where(F.col("source_file").rlike("^(nation|region|part)\\."))


@fixture("source_file VARCHAR", [('A1.jcl',), ('B2.JCL',), ('c3.jcl',), ('D4',)])
def stems_once(spark, d):
    names = ["A1.jcl", "a1.JCL", "B2.JCL", "c3.jcl", "C3.JCL", "D4"]
    return dedup_stems(spark.createDataFrame([(n,) for n in names], "source_file string"))


@fixture("source_file VARCHAR, copybook VARCHAR, found BOOLEAN", [('GAP.cbl', 'FIXREC', True), ('GAP.cbl', 'NOBOOK', False), ('GAP.cbl', 'NOOTHER', False)])
def copy_gaps(spark, d):
    lines = fx.lines(spark, {"GAP.cbl": "       COPY FIXREC.\n       COPY NOBOOK.\n           COPY 'NOOTHER'\n               REPLACING ==A== BY ==B==.\n       COPY NOBOOK.\n"})
    return expand.copy_uses(lines, fx.lines(spark, fx.COPYBOOKS, "name"))


@fixture("name VARCHAR, line_num INTEGER, line VARCHAR", [('FIXREC', 1, '       01 FIX-REC.'), ('FIXREC', 2, '          05 FIX-ID PIC 9(11).'), ('FIXREC', 3, '          05 FIX-AMT PIC S9(9)V99 COMP-3.'), ('CMQODV', 1, '       10 MQOD.'), ('CMQODV', 2, '          15 MQOD-ID PIC X(4).')])
def stub_copybooks(spark, d):
    stubs = fx.lines(spark, {"fixrec": "       01 OTHER.\n", "CMQODV": "       10 MQOD.\n          15 MQOD-ID PIC X(4).\n"}, "name")
    return expand.with_stubs(fx.lines(spark, fx.COPYBOOKS, "name"), stubs).where("name NOT LIKE 'FIXN%'")


@fixture("line_num INTEGER, line VARCHAR", [(23, '           MOVE WS-TMP TO WS-OUT-KEY.'), (24, '      *    EXEC DLI GU USING PCB(1)'), (25, '      *        SEGMENT(CUSTSEG) WHERE(CUSTKEY = WS-KEY)'), (26, '      *    END-EXEC'), (27, "           CALL 'MQPUT' USING W-HCONN, REPLY-QUEUE-NAME")])
def dli_stripped(spark, d):
    return expand.strip_dli(_programs(spark).select("source_file", "line_num", "line")).where("source_file = 'COFIX02C.cbl' AND line_num BETWEEN 23 AND 27").select("line_num", "line")


@fixture("source VARCHAR, line INTEGER, origin_file VARCHAR, origin_line_num INTEGER, content VARCHAR", [('line', 7, 'FIXREC.cpy', 2, '05 FIX-ID PIC 9(11).'), ('copybook', 12, 'FIXNEST.cpy', 1, '01 :TAG:-OUTER.'), ('copybook', 13, 'FIXNEST.cpy', 2, '05 :TAG:-KEY PIC X(08).')])
def provenance_lookup(spark, d):
    show = lambda df, k: df.select(F.lit(k).alias("source"), F.col("expanded_line_num").alias("line"), "origin_file", "origin_line_num", F.trim("content").alias("content"))
    full = _full(spark)
    return show(expand.line_origin(full, "FIXA01C.cbl", 7), "line").unionByName(show(expand.copybook_lines(full, "COFIX02C.cbl", "fixnest"), "copybook"))


@fixture("caller VARCHAR, callee VARCHAR, thru VARCHAR, paragraph VARCHAR, line INTEGER", [('COFIX02C', '3000-LOOP', '', 'MAIN-PARA', 17), ('FIXA01C', '1000-OPEN', '', 'MAIN-PARA', 10), ('FIXA01C', '2000-READ', '', 'MAIN-PARA', 11), ('FIXA01C', '9000-CLOSE', '', 'MAIN-PARA', 13), ('FIXA01C', '1100-INIT', '1100-EXIT', '1000-OPEN', 21)])
def perform_targets(spark, d):
    return extract.performs(_programs(spark)).drop("source_file")


@fixture("name VARCHAR, record_length INTEGER, key_field VARCHAR, record_copybook VARCHAR", [('ACCTAIX', 300, 'CARD-NUM', ''), ('ACCTFIL', 120, 'ACCT-ID', 'CVACT01Y')])
def vsam_overrides(spark, d):
    own = spark.createDataFrame([("ACCTAIX", 300, "CARD-NUM", None), ("ACCTFIL", None, None, "CVACT01Y")], "name string, record_length int, key_field string, record_copybook string")
    return catalogs.vsam_schemas(catalogs.csd_kind(catalogs.csd(fx.lines(spark, fx.CSD)), "FILE"), _programs(spark), own).select("name", "record_length", "key_field", "record_copybook")


@fixture("name VARCHAR, dd_name VARCHAR, program VARCHAR", [('ACCTFIL', 'ACCT', 'COFIX02C')])
def vsam_jobs(spark, d):
    schemas = spark.createDataFrame([("ACCTFIL", "FIX.ACCT.KSDS"), ("OTHER", "FIX.OTHER")], "name string, dsn string")
    jobs = spark.createDataFrame([("A.jcl", 1, "ACCTOLD", "FIX.ACCT.KSDS"), ("B.jcl", 2, "ACCT", "FIX.ACCT.KSDS"), ("B.jcl", 3, "SYSUT1", "FIX.ACCT.KSDS"), ("B.jcl", 4, "ZZZ", "FIX.OTHER")], "source_file string, line_num int, dd_name string, dataset_name string")
    return catalogs.vsam_from_jobs(schemas, jobs, _programs(spark))


@fixture("source_file VARCHAR, index_name VARCHAR, table_name VARCHAR", [('FIX.ddl', 'FIX.XACCT', 'FIX.ACCOUNT')])
def ddl_index_list(spark, d):
    return catalogs.ddl_indexes(fx.sources(spark).ddl)


@fixture("job_name VARCHAR, dsn VARCHAR, dd_name VARCHAR", [('JOBB', 'FIX.LOADLIB(MEMBER)', 'LIBDD')])
def pds_members(spark, d):
    return catalogs.pds_references(catalogs.jcl(fx.lines(spark, fx.JCL)))


@fixture("k INTEGER, n INTEGER, kind VARCHAR", [(1, 2, 'a'), (2, 0, ''), (3, 0, ''), (4, 0, '')])
def json_or_empty(spark, d):
    rows = spark.createDataFrame([(1, '{"kind": "a", "n": 2}'), (2, "{broken"), (3, None), (4, "")], "k int, j string")
    m = json_map("j")
    return rows.select("k", F.size(m).alias("n"), F.coalesce(F.try_element_at(m, F.lit("kind")), F.lit("")).alias("kind"))


@fixture("source_file VARCHAR, kind VARCHAR, status VARCHAR, error VARCHAR, paragraphs BIGINT", [('FIXA01C.cbl', 'COBOL', 'success', None, 4), ('COFIX02C.cbl', 'COBOL', 'success', None, 2), ('BAD.cbl', 'COBOL', 'error', 'no procedure division', 0), ('NIL.cbl', 'COBOL', 'error', 'no text', 0), ('JOBA.jcl', 'JCL', 'success', None, 0), ('NIL.jcl', 'JCL', 'error', 'no text', 0)])
def parse_failures(spark, d):
    files = [(k, "COBOL", x) for k, x in fx.PROGRAMS.items()] + [("BAD.cbl", "COBOL", "       IDENTIFICATION DIVISION.\n"), ("NIL.cbl", "COBOL", None), ("JOBA.jcl", "JCL", fx.JCL["JOBA.jcl"]), ("NIL.jcl", "JCL", " ")]
    return reports.parse_status(spark.createDataFrame(files, "source_file string, kind string, text string"), _store(spark)["paragraphs"])


@fixture("kind VARCHAR, total BIGINT, passed BIGINT, pass_rate DOUBLE", [('COBOL', 4, 2, 50.0), (None, 6, 3, 50.0), ('JCL', 2, 1, 50.0)])
def coverage_by_source(spark, d):
    return reports.coverage(parse_failures(spark, d), "kind", F.col("status") == "success")


@fixture("root VARCHAR, origin VARCHAR", [('WS-OUT', 'WS-KEY'), ('WS-OUT', 'WS-IN'), ('WS-OUT-KEY', 'WS-KEY')])
def output_origins(spark, d):
    return graph.output_origins(extract.moves(_programs(spark)), ("OUT-", "WS-OUT", "SEND", "WRITE", "MOVE-TO-SCREEN"))


@fixture("name VARCHAR, start_line INTEGER", [('9000-CLOSE', 30), ('1000-OPEN', 18), ('2000-READ', 22)])
def parameter_binding(spark, d):
    return api.ask(_store(spark), "SELECT p.name, p.start_line FROM {paragraphs} p JOIN {nodes} n ON n.uuid = p.program_uuid WHERE upper(n.source_file) = upper(?) AND p.start_line > ?", "fixa01c.cbl", 10)


@fixture("status VARCHAR, db_exists BOOLEAN", [('ok', True)])
def route_health(spark, d):
    return api.health(_store(spark))


@fixture("caller VARCHAR, call_type VARCHAR, line INTEGER", [('COFIX02C', 'CICS_XCTL', 0)])
def route_callers(spark, d):
    return api.callers(_store(spark), "fixa01c").select(F.col("caller_uuid").alias("caller"), "call_type", F.col("line_num").alias("line"))


@fixture("callee VARCHAR, call_type VARCHAR, line INTEGER", [('SUBPGM1', 'CALL', 17), ('WS-PGM', 'CALL', 28)])
def route_callees(spark, d):
    return api.callees(_store(spark), "fixa01c").select(F.col("callee_uuid").alias("callee"), "call_type", F.col("line_num").alias("line"))


@fixture("name VARCHAR, level INTEGER, pic VARCHAR, scope VARCHAR, defined_at_line INTEGER", [('FIX-AMT', 5, 'S9(9)V99', 'WORKING-STORAGE', 3)])
def route_data_item(spark, d):
    s = _store(spark)
    return api.data_item(s, s["symbols"].where("name = 'FIX-AMT' AND source_file = 'FIXA01C.cbl'").first()["uuid"]).select("name", "level", "pic", "scope", "defined_at_line")


@fixture("from_program VARCHAR, to_program VARCHAR, edge_type VARCHAR, transid VARCHAR", [('FIXA01C', '', 'RETURN', 'FX01')])
def route_transaction_flow(spark, d):
    return api.transaction_flow(_store(spark), "fx01").select(F.col("from_program_uuid").alias("from_program"), F.col("to_program_uuid").alias("to_program"), "edge_type", "transid")


@fixture("part VARCHAR, a VARCHAR, b VARCHAR, c VARCHAR", [('step', 'STEP1', 'FIXA01C', 'OUTDD'), ('dependency', 'JOBA', 'JOBB', 'FIX.DATA'), ('chain', 'night', 'joba,JOBB', '')])
def route_job_chain(spark, d):
    chains = spark.createDataFrame([("night", ["joba", "JOBB"]), ("day", ["JOBC"])], "chain_name string, jobs array<string>")
    steps, deps, known = api.job_chain(_store(spark), "JobA", chains)
    return steps.select(F.lit("step").alias("part"), F.col("step_name").alias("a"), F.col("program_name").alias("b"), F.col("dd_name").alias("c")).unionByName(deps.select(F.lit("dependency").alias("part"), F.col("producer_job").alias("a"), F.col("consumer_job").alias("b"), F.col("dataset_name").alias("c"))).unionByName(known.select(F.lit("chain").alias("part"), F.col("chain_name").alias("a"), _text("jobs").alias("b"), F.lit("").alias("c")))


@fixture("copybook_name VARCHAR, source_file VARCHAR", [('FIXREC', 'COFIX02C.cbl'), ('FIXREC', 'FIXA01C.cbl')])
def route_copybook_consumers(spark, d):
    return api.copybook_consumers(_store(spark), "fixrec").select("copybook_name", "source_file")


@fixture("kind VARCHAR, predicate_raw VARCHAR, line INTEGER", [('IF', "WS-FLAG = 'Y'", 12), ('EVALUATE', "EVALUATE WS-FLAG WHEN 'A'", 24)])
def route_business_rules(spark, d):
    return api.business_rules(_store(spark), "FIXA01C").select("kind", "predicate_raw", F.col("line_num").alias("line"))


@fixture("from_uuid VARCHAR, to_uuid VARCHAR, edge_type VARCHAR, line INTEGER", [('MAIN-PARA', '3000-LOOP', 'PERFORM_VARYING', 17)])
def route_control_flow_rows(spark, d):
    return api.control_flow(_store(spark), "cofix02c").select("from_uuid", "to_uuid", "edge_type", F.col("line_num").alias("line"))


@fixture("program VARCHAR, segment VARCHAR, operation VARCHAR, line INTEGER", [('COFIX02C', 'CUSTSEG', 'GU', 24), ('COFIX02C', 'CUSTSEG', 'GU', 24)])
def route_ims(spark, d):
    s = _store(spark)
    rows = reduce(DataFrame.unionByName, [api.ims(s), api.ims(s, "cofix02c", "custseg"), api.ims(s, segment="none")])
    return rows.select(F.col("program_uuid").alias("program"), F.col("segment_name").alias("segment"), "operation", F.col("line_num").alias("line"))


@fixture("program VARCHAR, queue VARCHAR, operation VARCHAR, line INTEGER", [('COFIX02C', 'REPLY-QUEUE', 'PUT', 27)])
def route_mq(spark, d):
    return api.mq(_store(spark), "cofix02c", "reply-queue").select(F.col("program_uuid").alias("program"), F.col("queue_name").alias("queue"), "operation", F.col("line_num").alias("line"))


@fixture("table_name VARCHAR, columns VARCHAR, indexes BIGINT", [('FIX.ACCOUNT', 'ACCT_ID,BALANCE,OPENED', 1)])
def route_db2(spark, d):
    return api.db2(_store(spark), catalogs.ddl_indexes(fx.sources(spark).ddl))


@fixture("name VARCHAR, dsn VARCHAR, uuid VARCHAR", [('ACCTFIL', 'FIX.ACCT.KSDS', '8c8102e5234b25f02ef8f2cdddea8202'), ('ACCTAIX', 'FIX.ACCT.KSDS.AIX.PATH', '48ab6042eda935663d377382ebb51a52')])
def route_vsam(spark, d):
    return api.vsam(catalogs.vsam_schemas(catalogs.csd_kind(catalogs.csd(fx.lines(spark, fx.CSD)), "FILE"), _programs(spark))).select("name", "dsn", "uuid")


@fixture("base_dsn VARCHAR, refs VARCHAR, uuid VARCHAR", [('FIX.DATA', 'JOBA:+1:f288a0a1d3fa62a3213926be96f385d2,JOBB:0:31bd57d102803cbdeea80c40fa126e38', '2f5131c84a7b64af00fe35cc039dbfbb')])
def route_gdg(spark, d):
    rows = api.gdg(catalogs.gdg_references(catalogs.jcl(fx.lines(spark, fx.JCL))))
    return rows.select("base_dsn", _text(F.transform("references", lambda r: F.concat_ws(":", r["job_name"], r["generation"], r["uuid"]))).alias("refs"), "uuid")


@fixture("source_file VARCHAR, end_line INTEGER", [('COFIX02C.cbl', 31), ('FIXA01C.cbl', 36)])
def route_explore(spark, d):
    return api.explore(_store(spark)).select("source_file", "end_line")


@fixture("kind VARCHAR, id VARCHAR, type VARCHAR", [('node', '1000-OPEN', 'performs'), ('node', '2000-READ', 'performs'), ('node', '3000-LOOP', 'performs'), ('node', '9000-CLOSE', 'performs'), ('node', 'MAIN-PARA', 'paragraph'), ('link', '1000-OPEN', 'performs'), ('link', '2000-READ', 'performs'), ('link', '3000-LOOP', 'performs'), ('link', '9000-CLOSE', 'performs')])
def route_explore_paragraph(spark, d):
    nodes, links = api.neighbourhood(_store(spark), "main-para", "paragraph")
    return nodes.select(F.lit("node").alias("kind"), "id", "type").unionByName(links.select(F.lit("link").alias("kind"), F.col("target").alias("id"), "type"))


@fixture("kind VARCHAR, id VARCHAR, type VARCHAR", [('copybook', 'COFIX02C', 'program'), ('copybook', 'FIXA01C', 'program'), ('copybook', 'FIXREC', 'copybook')])
def route_explore_copybook(spark, d):
    nodes, _ = api.neighbourhood(_store(spark), "fixrec", "copybook")
    return nodes.select(F.lit("copybook").alias("kind"), "id", "type")


@fixture("kind VARCHAR, id VARCHAR, type VARCHAR", [('job', 'FIXB01C', 'program'), ('job', 'JOBA', 'fed_by'), ('job', 'JOBB', 'job')])
def route_explore_job(spark, d):
    nodes, _ = api.neighbourhood(_store(spark), "jobb", "job")
    return nodes.select(F.lit("job").alias("kind"), "id", "type")


@fixture("kind VARCHAR, id VARCHAR, type VARCHAR", [('node', 'FIXNEST', 'copybooks'), ('node', 'FIXREC', 'copybooks'), ('link', 'FIXNEST', 'copybooks'), ('link', 'FIXREC', 'copybooks')])
def route_explore_program(spark, d):
    nodes, links = api.neighbourhood(_store(spark), "cofix02c")
    kept, near = api.by_type(nodes, links, "copybooks")
    return kept.select(F.lit("node").alias("kind"), "id", "type").unionByName(near.select(F.lit("link").alias("kind"), F.col("target").alias("id"), "type"))


@fixture("name VARCHAR, start_line INTEGER", [('MAIN-PARA', 16), ('3000-LOOP', 21)])
def route_children(spark, d):
    s = _store(spark)
    top = api.find_program(s, "cofix02c").first()["uuid"]
    return api.children(s, top).select(F.get_json_object("payload_json", "$.name").alias("name"), "start_line")


@fixture("name VARCHAR, defined_at_line INTEGER", [('FIX-REC', 1), ('FIX-ID', 2), ('FIX-AMT', 3)])
def route_first_symbols(spark, d):
    s = _store(spark)
    return api.first_symbols(s, api.find_program(s, "FIXA01C").first()["uuid"], 3).select("name", "defined_at_line")


@fixture("source_file VARCHAR, by VARCHAR, most INTEGER", [('FIXA01C.cbl', 'name', 5), ('FIXA01C.cbl', 'id', 5)])
def route_find_program(spark, d):
    s = _store(spark)
    top = api.find_program(s, "fixa01c").first()["uuid"]
    one = lambda key, how: api.find_program(s, key).select("uuid", "source_file", F.lit(how).alias("by")).join(api.complexity(s, key).withColumnRenamed("program_uuid", "uuid"), "uuid")
    return one("fixa01c", "name").unionByName(one(top, "id")).select("source_file", "by", "most")


@fixture("name VARCHAR, performs VARCHAR, rules VARCHAR, cics VARCHAR, statements VARCHAR", [('9000-CLOSE', '', '', 'RETURN:FX01', 'CLOSE,EXEC'), ('MAIN-PARA', '1000-OPEN>97bc,2000-READ>161b,9000-CLOSE>f33f', 'IF', '', 'PERFORM,PERFORM,IF,PERFORM,MOVE,CALL')])
def route_paragraph_whole(spark, d):
    s, p = _store(spark), _programs(spark)
    rows = api.paragraph(s, s["paragraphs"].where("name = '9000-CLOSE'").first()["uuid"], extract.cics(p), extract.statements(p)).unionByName(api.paragraph(s, s["paragraphs"].where("name = 'MAIN-PARA' AND source_file LIKE 'FIX%'").first()["uuid"], extract.cics(p), extract.statements(p)))
    part = lambda c, f: F.coalesce(_text(F.transform(c, f)), F.lit(""))
    return rows.select("name", part("performs", lambda e: F.concat_ws(">", e["to_uuid"], F.left(e["to_id"], F.lit(4)))).alias("performs"), part("rules", lambda r: r["kind"]).alias("rules"), part("cics", lambda c: F.concat_ws(":", c["verb"], c["params"][0]["value"])).alias("cics"), part("statements", lambda x: x["type"]).alias("statements"))


@fixture("name VARCHAR, program_file VARCHAR, program_end INTEGER", [('1000-OPEN', 'FIXA01C.cbl', 36)])
def route_paragraph_program(spark, d):
    return api.paragraph_program(_store(spark), "97bc491961244aa222b08722f464976e").select("name", "program_file", "program_end")


@fixture("tbl VARCHAR, id VARCHAR, verb VARCHAR", [('cics', '47ef5944056dbd2f728a6115f3aa80c4', 'RETURN')])
def route_retrieve_screen(spark, d):
    from lodestrata.functions.ids import node_id

    screens = extract.cics(_programs(spark)).withColumn("uuid", node_id("source_file", "line", "verb"))
    return api.retrieve(_store(spark), "47ef5944056dbd2f728a6115f3aa80c4", screens).select(F.col("table").alias("tbl"), "id", F.get_json_object("record", "$.verb").alias("verb"))


@fixture("total_vars BIGINT, total_reads BIGINT, total_writes BIGINT", [(6, 4, 2)])
def def_use_totals(spark, d):
    return api.def_use_totals(_store(spark), "cofix02c")


@fixture("relation VARCHAR, n BIGINT", [('calls', 2), ('transfers', 1), ('copybooks', 2), ('shares_copybook', 1), ('transactions', 1)])
def connectivity_counts(spark, d):
    return api.connectivity_counts(_store(spark), "COFIX02C")


@fixture("from_uuid VARCHAR, to_uuid VARCHAR", [('MAIN-PARA', '1000-OPEN'), ('MAIN-PARA', '2000-READ'), ('MAIN-PARA', '9000-CLOSE')])
def flow_chart_edges(spark, d):
    return api.flow_chart(_store(spark), "FIXA01C")[1].select("from_uuid", "to_uuid")


@fixture("name VARCHAR, source_file VARCHAR", [('FIX-ID', 'COFIX02C.cbl'), ('FIX-AMT', 'COFIX02C.cbl'), ('FIX-ID', 'FIXA01C.cbl'), ('FIX-AMT', 'FIXA01C.cbl')])
def report_unread_symbols(spark, d):
    return reports.unread_symbols(_store(spark)).select("name", "source_file")


@fixture("name VARCHAR", [('ACCTFIL',)])
def report_unaccessed_files(spark, d):
    return reports.unaccessed_files(spark.createDataFrame([("in-file",), ("ACCTFIL",), ("ACCTFIL",)], "name string"), _store(spark))


@fixture("name VARCHAR, source_file VARCHAR", [('3000-LOOP', 'COFIX02C.cbl'), ('1000-OPEN', 'FIXA01C.cbl')])
def report_empty_paragraphs(spark, d):
    s = _store(spark)
    p = s["paragraphs"]
    blank = p.withColumn("statement_count", F.when(F.col("name") == "1000-OPEN", None).when(F.col("name") == "3000-LOOP", 0).otherwise(F.col("statement_count")).cast("int"))
    return reports.empty_paragraphs({**s, "paragraphs": blank}).select("name", "source_file")


@fixture("a VARCHAR, b VARCHAR, shared BIGINT, similarity DOUBLE", [('P1', 'P2', 2, 1.0), ('P1', 'P3', 2, 0.667), ('P2', 'P3', 2, 0.667)])
def report_clones(spark, d):
    rows = [("P1.cbl", 3, 1), ("P1.cbl", 4, 2), ("P1.cbl", 0, 1), ("P2.cbl", 3, 1), ("P2.cbl", 4, 2), ("P3.cbl", 3, 1), ("P3.cbl", 4, 2), ("P3.cbl", 9, 9), ("P4.cbl", 9, 9)]
    return reports.clones({"paragraphs": spark.createDataFrame(rows, "source_file string, statement_count int, complexity int")})


@fixture("kind VARCHAR, files BIGINT, lines BIGINT, redefines BIGINT, occurs BIGINT", [('online', 1, 3, 1, 2), ('batch', 2, 2, 1, 0)])
def report_corpus_tally(spark, d):
    return reports.corpus_tally(spark.createDataFrame([("a", "X REDEFINES Y\nEXEC CICS\nOCCURS 3 occurs 4"), ("b", "NO-REDEFINESX"), ("c", "B REDEFINES C")], "source_file string, text string"))


@fixture("stem VARCHAR, n BIGINT, files VARCHAR", [('A', 2, 'A.cbl,a.CBL')])
def report_duplicate_stems(spark, d):
    return reports.duplicate_stems(spark.createDataFrame([("A.cbl",), ("a.CBL",), ("B.cbl",)], "source_file string")).withColumn("files", _text("files"))


@fixture("source_file VARCHAR, n BIGINT", [('COFIX02C.cbl', 5), ('FIXA01C.cbl', 4)])
def report_program_totals(spark, d):
    return reports.program_totals(_store(spark))


@fixture("copybook_name VARCHAR, n BIGINT", [('FIXREC', 2), ('FIXNEST', 1)])
def report_copybook_totals(spark, d):
    return reports.copybook_totals(_store(spark))


@fixture("file_name VARCHAR, programs BIGINT", [('Z', 2), ('X', 1), ('Y', 1)])
def report_shared_files(spark, d):
    rows = [("Z", "P1", "A.cbl", 1), ("Z", "P2", "B.cbl", 1), ("Y", "P1", "A.cbl", 5), ("X", "P1", "A.cbl", 3), ("X", "P1", "A.cbl", 4)]
    return reports.shared_files({"file_io": spark.createDataFrame(rows, "file_name string, program_uuid string, source_file string, line_num int")})


@fixture("kind VARCHAR, n BIGINT, signed BIGINT, packed BIGINT, binary BIGINT", [('alphanumeric', 2, 0, 0, 0), ('decimal', 2, 2, 2, 0), ('group', 2, 0, 0, 0), ('numeric', 2, 0, 0, 0), ('binary', 1, 1, 0, 1)])
def report_format_tally(spark, d):
    return reports.format_tally(_store(spark))


@fixture("module VARCHAR, item VARCHAR, n BIGINT", [('db2', 'FIX.ACCOUNT', 1), ('ims', 'GU', 1), ('mq', 'PUT', 1), ('mq', 'MQOPEN', 1)])
def report_module_tally(spark, d):
    return reports.module_tally(_store(spark))


@fixture("category VARCHAR, n BIGINT, callers BIGINT", [('CICS_XCTL', 1, 1), ('CALL', 4, 2), (None, 5, 2)])
def report_category_counts(spark, d):
    return reports.category_counts(_store(spark)["call_graph"], "call_type", callers="caller_uuid")


@fixture("source_file VARCHAR, n BIGINT, flagged BIGINT", [('FIXMAP.bms', 2, 1)])
def report_nested_totals(spark, d):
    maps = catalogs.bms(fx.lines(spark, fx.BMS)).groupBy("source_file").agg(F.collect_list(F.struct("name", "is_named")).alias("fields"))
    return reports.nested_totals(maps, "source_file", F.col("fields"), lambda x: x["is_named"])


@fixture("check_ VARCHAR, n BIGINT", [('symbols x nodes', 9), ('paragraphs x nodes', 6), ('copybook_use x nodes', 3)])
def report_verification(spark, d):
    return reports.verification(_store(spark)).where("check LIKE '% x %'").withColumnRenamed("check", "check_")


@fixture("layer VARCHAR, sample VARCHAR", [('L1', 'MAIN-PARA|9|17'), ('L2', 'FIX-AMT|S9(9)V99'), ('L3 writes', 'WS-FLAG|15'), ('L3 writes', 'OTHER|26'), ('L3 reads', 'WS-FLAG|11'), ('L3 reads', 'WS-FLAG|12'), ('L4', 'IN-FILE|OPEN_INPUT'), ('L4', 'IN-FILE|READ'), ('L5', "IF|WS-FLAG = 'Y'")])
def report_samples(spark, d):
    return reports.samples(_store(spark), "FIXA01C")


@fixture("chart VARCHAR, n INTEGER, text VARCHAR", [('call_graph', 0, 'graph TD'), ('call_graph', 1, '    COFIX02C -->|CICS_XCTL| FIXA01C'), ('call_graph', 1, '    COFIX02C -->|CALL| MQOPEN'), ('call_graph', 1, '    COFIX02C -->|CALL| MQPUT'), ('call_graph', 1, '    FIXA01C -->|CALL| SUBPGM1'), ('call_graph', 1, '    FIXA01C -->|CALL| WS-PGM'), ('transaction_flow', 0, 'graph LR'), ('transaction_flow', 1, '    COFIX02C -->|XCTL:FX02| FIXA01C'), ('jcl_chain', 0, 'graph TD'), ('jcl_chain', 1, '    JOBA --> FIXA01C'), ('jcl_chain', 1, '    JOBB --> FIXB01C'), ('file_io', 0, 'graph TD'), ('file_io', 1, '    FIXA01C -->|OPEN_INPUT| IN-FILE'), ('file_io', 1, '    FIXA01C -->|READ| IN-FILE'), ('file_io', 1, '    FIXA01C -->|CLOSE| IN-FILE')])
def report_chart_text(spark, d):
    return reduce(DataFrame.unionByName, (x.select(F.lit(k).alias("chart"), "n", "text") for k, x in reports.mermaid_charts(_store(spark)).items()))


@fixture("seam VARCHAR, programs VARCHAR", [('Intake', 'FIXA01C'), ('Screens', 'COFIX02C')])
def ir_seams(spark, d):
    tops = ir.summary(_store(spark), spark.createDataFrame(fx.CONTEXTS, "ord int, context string, member string")).select("program")
    return ir.seams(tops, spark.createDataFrame(fx.CONTEXTS, "ord int, context string, member string")).withColumn("programs", _text("programs"))


@fixture("program VARCHAR, type_imports VARCHAR", [('FIXA01C', 'java.math.BigDecimal'), ('COFIX02C', 'java.math.BigDecimal')])
def ir_imports(spark, d):
    return ir.imports(ir.fields(_store(spark))).withColumn("type_imports", _text("type_imports"))


@fixture("kind VARCHAR, java_pattern VARCHAR, then_summary VARCHAR, line INTEGER", [('IF', "WS-FLAG == 'Y'", 'PERFORM 9000-CLOSE', 12), ('EVALUATE', "EVALUATE WS-FLAG WHEN 'A'", '2 WHEN clauses', 24)])
def ir_rules(spark, d):
    return ir.rules(_store(spark)).select("kind", "java_pattern", "then_summary", "line")


@fixture("program VARCHAR, kind VARCHAR, resource VARCHAR, operation VARCHAR, java_pattern VARCHAR, line INTEGER", [('FIXA01C', 'file', 'IN-FILE', 'OPEN_INPUT', 'repository.open_input()', 19), ('FIXA01C', 'file', 'IN-FILE', 'READ', 'repository.findById(key)', 23), ('FIXA01C', 'file', 'IN-FILE', 'CLOSE', '// CLOSE — handled by Spring Data lifecycle', 31), ('COFIX02C', 'ims', 'CUSTSEG', 'GU', 'imsTemplate.gu("CUSTSEG")', 24), ('COFIX02C', 'mq', 'REPLY-QUEUE', 'PUT', 'jmsTemplate.send("REPLY-QUEUE", message)', 27), ('COFIX02C', 'mq', 'REQUEST-QUEUE', 'MQOPEN', 'jmsTemplate.setDefaultDestinationName("REQUEST-QUEUE")', 28), ('COFIX02C', 'transaction', 'FIXA01C', 'XCTL', 'cicsXctl("FIXA01C", commArea)', 0), ('FIXA01C', 'transaction', '', 'RETURN', 'return CicsResponse.returnTo("FX01", commArea)', 32)])
def ir_io(spark, d):
    return ir.io(_store(spark))


@fixture("predicate VARCHAR, scenario VARCHAR, note VARCHAR", [("WS-FLAG = 'Y'", 'predicate_true', "Inputs satisfy: WS-FLAG = 'Y'"), ("WS-FLAG = 'Y'", 'predicate_false', "Inputs violate: WS-FLAG = 'Y'")])
def ir_rule_seeds(spark, d):
    return ir.rule_seeds(ir.rules(_store(spark)).where("kind = 'IF'")).select("predicate", "scenario", "note")


@fixture("entry VARCHAR, path VARCHAR, note VARCHAR", [('1000-OPEN', '1000-OPEN,1100-INIT', 'complexity=1'), ('MAIN-PARA', 'MAIN-PARA,1000-OPEN,2000-READ,9000-CLOSE', 'complexity=3')])
def ir_path_seeds(spark, d):
    return ir.path_seeds(ir.methods(_store(spark), extract.cics(_programs(spark))).where("program = 'FIXA01C'")).select("entry", _text("path").alias("path"), "note")


@fixture("program VARCHAR, part VARCHAR, ord INTEGER, text VARCHAR", [('COFIX02C', 'move_chains', 1, 'WS-KEY -> WS-TMP,WS-OUT'), ('COFIX02C', 'move_chains', 2, 'WS-TMP -> WS-OUT-KEY'), ('COFIX02C', 'transaction_flow', 1, 'XCTL FX02 FIXA01C'), ('FIXA01C', 'move_chains', 1, "'N' -> WS-FLAG"), ('FIXA01C', 'move_chains', 2, 'WS-IN -> WS-OUT'), ('FIXA01C', 'transaction_flow', 1, 'RETURN FX01 ')])
def ir_slice_extras(spark, d):
    return ir.slice_extras(_store(spark), extract.moves(_programs(spark)))


@fixture("n BIGINT, without BIGINT", [(8, 0)])
def node_times(spark, d):
    return _store(spark)["nodes"].agg(F.count("*").alias("n"), F.count_if(F.col("created_at").isNull()).alias("without"))


@fixture("program VARCHAR, context VARCHAR", [('FIXA01C', "=== PROGRAM: FIXA01C ===\nType: UNKNOWN\nLines: 36\nCopybooks: FIXREC\n\n=== PROGRAM COMMENTS (business context) ===\n  Line    1: FIXA01C - SYNTHETIC FIXTURE\n  Line   20: PERFORM 9999-COMMENTED\n\n=== PARAGRAPHS ===\n  [UUID:f63132171c4f3483e52fb9b721650e80] MAIN-PARA                                lines    9-  17 stmts=  6 complexity=3\n  [UUID:97bc491961244aa222b08722f464976e] 1000-OPEN                                lines   18-  21 stmts=  2 complexity=1\n  [UUID:161bdabc00a6893ec16ed70fab0b7986] 2000-READ                                lines   22-  29 stmts=  4 complexity=5\n  [UUID:f33f9f5fb9adb672610514cc581a8510] 9000-CLOSE                               lines   30-  36 stmts=  2 complexity=1\n\n=== KEY DATA ITEMS (Working Storage) ===\n  [UUID:020984b9065e4dc2c417a1660fc7e1c1] L01 FIX-REC                             PIC None            group\n  [UUID:457f84f0c73c64aff67f1851e53e2803] L05 FIX-ID                              PIC 9(11)           numeric(11)\n  [UUID:75836718e6d49b88f21fa5cf21cc16b2] L05 FIX-AMT                             PIC S9(9)V99        decimal(11) scale=2\n  [UUID:ef8763847104d67ed080c23417884bcc] L01 WS-FLAG                             PIC X               alphanumeric [from FIXREC]\n\n=== FILE I/O ===\n  OPEN_INPUT      IN-FILE (line 19)\n  READ            IN-FILE (line 23)\n  CLOSE           IN-FILE (line 31)\n\n=== EXEC CICS STATEMENTS ===\n  RETURN          TRANSID=FX01 (line 32, para=9000-CLOSE)\n\n=== PROGRAM CALLS ===\n  [UUID:53448154ee74ccab6297fd44c816ee2b] CALL         -> SUBPGM1              (line 17)\n  [UUID:003cb34ce40a0fff09fd247e3f96ad3d] CALL         -> WS-PGM               (line 28)\n\n=== BUSINESS RULES (IF/EVALUATE) ===\n  [UUID:06c2a1b675c41e36f9a5761c24bade02] IF         line   12: WS-FLAG = 'Y'\n    THEN: PERFORM 9000-CLOSE\n    ELSE: MOVE 'N' TO WS-FLAG\n  [UUID:8586d2ff81ccae4e5590e1f14d89fd22] EVALUATE   line   24: EVALUATE WS-FLAG WHEN 'A'\n    THEN: 2 WHEN clauses\n\n=== DEF-USE CHAINS ===\n  [UUID:71f2323d14786b8cb975bf505b83ad35] READ   WS-FLAG                        line   11\n  [UUID:039232508dbe274a34f913caaae013d8] READ   WS-FLAG                        line   12\n  [UUID:c0722b2a7aff2639055c55869eed1b1b] WRITE  WS-FLAG                        line   15\n  [UUID:eb4f04e22966e8898f2fff2091657f91] READ   INIT                           line   21\n  [UUID:94cecc67f843a2c6f266f65a94ab3539] READ   IN-FILE                        line   23\n  [UUID:47f8198fd3a549116feb9d24aa6ad1d6] READ   WS-FLAG                        line   24\n  [UUID:41f0cde76183dfec44ee92ac703f30d7] WRITE  OTHER                          line   26\n  [UUID:7f15447f0168681b3eae6f37a908f5eb] READ   WS-IN                          line   26\n\n=== CONTROL FLOW GRAPH ===\n  [UUID:29c3a08b92dbad921df90270de3635e8] MAIN-PARA                      --PERFORM--> 1000-OPEN (line 10)\n  [UUID:097dc18873ac4781f08a64fc476c4b32] MAIN-PARA                      --PERFORM_UNTIL--> 2000-READ [WS-FLAG = 'Y'] (line 11)\n  [UUID:da05a39b4d19e29052dc751aeb293095] MAIN-PARA                      --PERFORM_CONDITIONAL--> 9000-CLOSE (line 13)\n  [UUID:089d1fe8d678ba56d172996e38db13ed] 1000-OPEN                      --PERFORM--> 1100-INIT [THRU 1100-EXIT] (line 21)\n"), ('COFIX02C', '=== PROGRAM: COFIX02C ===\nType: ONLINE\nLines: 31\nCopybooks: FIXNEST, FIXREC\n\n=== PARAGRAPHS ===\n  [UUID:afa5dda2b9c10f841db6f2994f4da957] MAIN-PARA                                lines   16-  20 stmts=  2 complexity=1\n  [UUID:8ed7c0ddc5acc61fb6e9e7d0dd98078f] 3000-LOOP                                lines   21-  31 stmts=  5 complexity=1\n\n=== KEY DATA ITEMS (Working Storage) ===\n  [UUID:2ced43da6c22f496411446cb720e4d80] L05 FIX-ID                              PIC 9(11)           numeric(11)\n  [UUID:4c36755011dc21402326d7def3937dee] L01 FIX-REC                             PIC None            group\n  [UUID:2d45baeab494ef95c24879a2fb972637] L05 FIX-AMT                             PIC S9(9)V99        decimal(11) scale=2\n  [UUID:9c2bd592a8cf1f51d1419c51436a5430] L01 ACCT-REC                            PIC X(120)          alphanumeric\n  [UUID:3abe7f458d419e4704f906952e0e237b] L01 WS-COUNT                            PIC S9(4)           binary(4) [from FIXREC]\n\n=== EXEC CICS STATEMENTS ===\n  XCTL            PROGRAM=FIXA01C (line 18, para=MAIN-PARA)\n\n=== PROGRAM CALLS ===\n  [UUID:2fa82b332f6bf5ae2d13e1cce994914d] CICS_XCTL    -> FIXA01C              (line 0)\n  [UUID:a833e3951d1f3b13236fb3f3b3934c5c] CALL         -> MQPUT                (line 27)\n  [UUID:502b9db7cc4b1a0e5f77303e0acc6e05] CALL         -> MQOPEN               (line 28)\n\n=== DEF-USE CHAINS ===\n  [UUID:032bc43fe16952da66e584407b772af8] READ   WS-COUNT                       line   17\n  [UUID:a1842631755752d8a8fe6f1872524422] READ   LOOP                           line   17\n  [UUID:4199730473f670f1d40f6ccef0278f64] READ   WS-KEY                         line   22\n  [UUID:deb1e95207496ef616daaa882390b36c] WRITE  WS-OUT                         line   22\n  [UUID:e499f1bce3e479f1c4853447298c7e05] WRITE  WS-OUT-KEY                     line   23\n  [UUID:f250fc61ee9a4b723305df9feda172a1] READ   WS-TMP                         line   23\n\n=== CONTROL FLOW GRAPH ===\n  [UUID:a97d296e8d0b14ce5af87adb2c729f5d] MAIN-PARA                      --PERFORM_VARYING--> 3000-LOOP (line 17)\n')])
def slice_text(spark, d):
    s, p = _store(spark), _programs(spark)
    return ir.slices(ir.slice_rows(s, extract.cics(p), extract.comments(extract.tokens(p))))


@fixture("program VARCHAR, section VARCHAR, ord INTEGER, text VARCHAR", [('COFIX02C', 'fields', 1, '  FIX-ID (9(11)) → long // PIC 9 zoned decimal'), ('COFIX02C', 'fields', 2, '  FIX-REC (group) → Object // 01-level group → Java class or record'), ('COFIX02C', 'fields', 3, '  FIX-AMT (S9(9)V99) → BigDecimal // PIC S9(9)V9(2) COMP-3'), ('COFIX02C', 'fields', 4, '  ACCT-REC (X(120)) → String // PIC X(120)'), ('COFIX02C', 'fields', 5, '  WS-COUNT (S9(4)) → short // COMP/COMP-4 binary'), ('FIXA01C', 'fields', 1, '  FIX-REC (group) → Object // 01-level group → Java class or record'), ('FIXA01C', 'fields', 2, '  FIX-ID (9(11)) → long // PIC 9 zoned decimal'), ('FIXA01C', 'fields', 3, '  FIX-AMT (S9(9)V99) → BigDecimal // PIC S9(9)V9(2) COMP-3'), ('FIXA01C', 'fields', 4, '  WS-FLAG (X) → String // PIC X(1)'), ('COFIX02C', 'methods', 1, "  MAIN-PARA() complexity=1 calls=['3000-LOOP']"), ('COFIX02C', 'methods', 2, '  3000-LOOP() complexity=1 calls=[]'), ('FIXA01C', 'methods', 1, "  MAIN-PARA() complexity=3 calls=['1000-OPEN', '2000-READ', '9000-CLOSE']"), ('FIXA01C', 'methods', 2, "  1000-OPEN() complexity=1 calls=['1100-INIT']"), ('FIXA01C', 'methods', 3, '  2000-READ() complexity=5 calls=[]'), ('FIXA01C', 'methods', 4, '  9000-CLOSE() complexity=1 calls=[]'), ('FIXA01C', 'rules', 1, "  if (WS-FLAG == 'Y') // line 12"), ('FIXA01C', 'rules', 2, "  if (EVALUATE WS-FLAG WHEN 'A') // line 24"), ('FIXA01C', 'io', 1, '  OPEN_INPUT IN-FILE → repository.open_input()'), ('FIXA01C', 'io', 2, '  READ IN-FILE → repository.findById(key)'), ('FIXA01C', 'io', 3, '  CLOSE IN-FILE → // CLOSE — handled by Spring Data lifecycle'), ('COFIX02C', 'cics', 1, '  CICS XCTL → cicsXctl("FIXA01C", commArea)'), ('FIXA01C', 'cics', 1, '  CICS RETURN → return CicsResponse.returnTo("FX01", commArea)')])
def prompt_summary(spark, d):
    s = _store(spark)
    return ir.prompt_summary(ir.fields(s), ir.methods(s, extract.cics(_programs(spark))), ir.rules(s), ir.io(s))

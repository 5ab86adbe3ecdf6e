"""Ids, windows and graph operators against plain Python on random input; fixture rows are checked through the bindings."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestrata import bindings, fixtures
from lodestrata.functions.ids import node_id
from lodestrata.functions.text import strip
from lodestrata.operators import extract, graph, structure
from lodestrata.operators.windows import blocks, by, clamped
from lodestrata.plans.store import SCHEMAS, schema
from lodestrata.sources.lines import read_texts, split_lines

GOLDEN = {"FIXA01C.cbl:1:ProgramNode": "8b8e6a5d040b60565cdea08b11f22bd5", "FIXA01C.cbl:9:ParagraphNode": "f63132171c4f3483e52fb9b721650e80", "FIXA01C.cbl:32:RETURN": "47ef5944056dbd2f728a6115f3aa80c4"}


def test_golden_ids(spark):
    rows = spark.createDataFrame([(*k.split(":"), v) for k, v in GOLDEN.items()], "f string, l string, k string, id string")
    assert all(r.id == r.got for r in rows.withColumn("got", node_id("f", "l", "k")).collect())


def test_strip_takes_tabs_and_lines_keep_inner_blanks(spark):
    row = spark.createDataFrame([("\t a b \n", "x\r\n\ny\n")], "s string, t string").select(strip("s").alias("s"), split_lines("t").alias("t")).first()
    assert row.s == "a b" and row.t == ["x", "", "y"]


def test_lines_end_where_splitlines_ends_them(spark):
    ends = ["\r\n", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029", "\x1f", " "]
    texts = [f"a{x}b{y}" for x in ends for y in ends]
    got = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, t string").select("k", split_lines("t").alias("t")).collect()
    assert {r.k: r.t for r in got} == {k: x.splitlines() for k, x in enumerate(texts)}


def test_paragraph_counts_equal_the_walk(spark):
    """Origins that jump back (copied lines), repeated names and paragraphs that overlap or are empty."""
    rnd, rows = random.Random(9), []
    for f in range(12):
        rows.append((f"P{f}.cbl", 1, 1, "       PROCEDURE DIVISION."))
        for n in range(2, 120):
            origin = rnd.randrange(1, 300) if rnd.random() < 0.04 * (f % 3) else n + 100 * (f % 2)
            line = f"       {rnd.choice('ABCDEF')}-PARA." if rnd.random() < 0.08 else "           " + rnd.choice(["MOVE A TO B", "IF A = B", "EVALUATE X", "WHEN 1", "PERFORM UNTIL Z", "CONTINUE", "X"])
            rows.append((f"P{f}.cbl", n, origin, line))
    expanded = spark.createDataFrame(rows, "source_file string, expanded_line_num int, origin_line_num int, content string")
    got = structure.paragraphs(expanded).collect()
    assert len(got) > 60
    for p in got:
        statements, branches = 0, 1
        for _, _, origin, line in sorted(r for r in rows if r[0] == p.source_file):
            if origin < p.start_line:
                continue
            if origin > p.end_line:
                break
            words = line.split()
            statements += words[0] in extract.VERBS
            branches += words[0] in ("IF", "EVALUATE", "WHEN") or words[:2] == ["PERFORM", "UNTIL"]
        assert (p.statement_count, p.complexity) == (statements, branches), p


def test_clamped_counter_is_the_naive_walk(spark):
    rnd = random.Random(1)
    rows = [(g, k, rnd.choice([-1, -1, 0, 1])) for g in range(10) for k in range(50)]
    got = {(r.g, r.k): r.depth for r in clamped(spark.createDataFrame(rows, "g int, k int, d int"), "d", by("g", "k"), "depth").collect()}
    for g in range(10):
        depth = 0
        for _, k, d in (r for r in rows if r[0] == g):
            depth = max(0, depth + d)
            assert got[g, k] == depth


def test_blocks_ignore_starts_inside_a_block(spark):
    rnd = random.Random(2)
    cases = [(sorted(rnd.sample(range(40), 8)), sorted(rnd.sample(range(40), 6))) for _ in range(50)]
    rows = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, s array<int>, e array<int>")
    got = {r.k: [(b.start, b.end) for b in r.b] for r in rows.select("k", blocks(F.col("s"), F.col("e")).alias("b")).collect()}
    for k, (starts, ends) in enumerate(cases):
        out, upto = [], -1
        for s in starts:
            if s > upto:
                end = min((e for e in ends if e > s), default=None)
                out.append((s, end))
                upto = end if end is not None else 10**9
        assert got[k] == out


def test_origins_equal_the_recursion(spark):
    rnd = random.Random(3)
    edges = sorted({(rnd.randrange(12), rnd.randrange(12)) for _ in range(20)})
    edges = [e for e in edges if e[0] != e[1]]
    by_target: dict = {}
    for a, b in edges:
        by_target.setdefault(a, []).append(b)

    def trace(v, depth=0):
        return {v} if depth > 5 or v not in by_target else set().union(*(trace(x, depth + 1) for x in by_target[v]))

    df = spark.createDataFrame(edges, "target int, source int")
    got: dict = {}
    for r in graph.origins(df, df.select("target").distinct()).collect():
        got.setdefault(r.root, set()).add(r.origin)
    assert got == {t: trace(t) for t in by_target}


def test_jaccard_pairs_equal_all_pairs(spark):
    rnd = random.Random(4)
    sets = {g: {rnd.randrange(8) for _ in range(rnd.randint(1, 6))} for g in range(40)}
    rows = spark.createDataFrame([(g, x) for g, s in sets.items() for x in s], "g int, x int")
    got = {(r.a, r.b) for r in graph.jaccard_pairs(rows, "g", ["x"], 0.6).collect()}
    assert got == {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6}


def test_jaccard_pairs_of_frequent_and_rare_elements(spark):
    # more elements than bits: sets of frequent elements only, of rare ones only, and of both
    rnd = random.Random(11)
    sets = {g: {rnd.randrange(40) for _ in range(rnd.randint(0, 6))} | {rnd.randrange(40, 400) for _ in range(rnd.randint(0, 4))} for g in range(300)}
    for g in range(300, 600):
        near = set(sets[rnd.randrange(g)])
        sets[g] = (near - {rnd.choice(sorted(near))} if near else near) | {rnd.randrange(400)}
    rows = spark.createDataFrame([(g, x) for g, s in sets.items() for x in s], "g long, x long")
    for threshold in (0.5, 0.6, 0.8):
        pairs, members = graph.jaccard_classes(rows, "g", ["x"], threshold)
        rep = {r.g: r.rep for r in members.collect()}
        got = sorted((r.a, r.b, r.shared) for r in pairs.collect())
        least = sorted(set(rep.values()))
        want = [(a, b, len(sets[a] & sets[b])) for a in least for b in least if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold]
        assert got == want and rep == {g: min(h for h, s in sets.items() if s == sets[g]) for g in sets if sets[g]}


def test_extraction_does_not_depend_on_partitions(spark):
    lines = fixtures.lines(spark, fixtures.PROGRAMS)
    one, many = extract.control_flow(lines.coalesce(1)), extract.control_flow(lines.repartition(7))
    assert sorted(one.collect()) and sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_an_empty_corpus_gives_empty_tables(spark):
    none = fixtures.lines(spark, fixtures.PROGRAMS).where("false")
    assert extract.calls(none).isEmpty() and extract.cics(none).isEmpty() and extract.business_rules(none).isEmpty()


def test_schemas():
    assert len(SCHEMAS) == 17 and all(schema(t).names for t in SCHEMAS)


FIXTURE = ("pic_normalize", "canonical_java", "predicate_rewrite", "verb_maps", "provenance_summary", "copy_expand", "call_edges", "cfg_edges", "business_rules", "file_io_ops", "cics_stmts", "dli_stmts", "mq_calls", "move_edges", "move_origins", "def_use", "paragraph_inventory", "symbol_table", "ast_nodes", "jcl_jobs", "jcl_dependencies", "gdg_references", "bms_fields", "bms_stub_copybook", "csd_resources", "ddl_tables", "dbd_segments", "asm_stubs", "vsam_schemas", "transaction_flow", "token_comments", "store_row_counts", "route_control_flow", "route_paragraph", "route_program", "ir_fields", "ir_methods")


@pytest.mark.parametrize("name", FIXTURE)
def test_fixture_rows(spark, name):
    df = bindings.QUERIES[name](spark, "")
    want = duckdb.connect().execute(bindings.ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(map(str, df.select(*names).collect())) and sorted(repr(tuple(r)) for r in df.select(*names).collect()) == sorted(map(repr, want.fetchall()))


def test_look_ups_reach_the_reader(spark, tmp_path):
    from lodestrata.plans import api, store

    rows = spark.createDataFrame([("1", "A01", "B02"), ("2", "B02", "c03")], "id string, caller_uuid string, callee_uuid string")
    tables = {t: store.conform(rows if t == "call_graph" else rows.where("false").select("id"), t) for t in store.SCHEMAS}
    store.save(tables, str(tmp_path / "s"))
    facts = store.load(spark, str(tmp_path / "s"))
    found = api.callees(facts, "b02")
    assert [r.callee_uuid for r in found.collect()] == ["c03"] and found.columns == store.schema("call_graph").names
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(caller_uuid_uc,B02)" in plan.split("PushedFilters")[1]
    store.rebuild("call_graph", tables["call_graph"].where("id = '1'"), str(tmp_path / "s"))
    assert store.load(spark, str(tmp_path / "s"))["call_graph"].count() == 1
    both = store.insert_absent(tables["call_graph"].where("id = '1'"), tables["call_graph"], "id")
    assert sorted(r.id for r in both.collect()) == ["1", "2"]


def test_files_that_arrive_become_lines_once(spark, tmp_path):
    from lodestrata.streaming.ingest import append_lines, stream_lines

    (tmp_path / "in").mkdir()
    places = str(tmp_path / "out"), str(tmp_path / "state")
    want = set()
    for k, name in enumerate(("A.cbl", "b 2.cbl", "c+%20.cbl", "skipped.txt")):
        (tmp_path / "in" / name).write_text(f"one {k}\n\ntwo")
        append_lines(stream_lines(spark, str(tmp_path / "in"), "*.cbl"), *places).awaitTermination()
        want |= {(name, 1, f"one {k}"), (name, 2, ""), (name, 3, "two")} if name.endswith("cbl") else set()
        got = [tuple(r) for r in spark.read.parquet(places[0]).select("source_file", "line_num", "line").collect()]
        assert sorted(got) == sorted(want)
    assert {r.source_file for r in read_texts(spark, str(tmp_path / "in"), "*.cbl").collect()} == {x[0] for x in want}


def test_artifacts_as_json(spark, tmp_path):
    from lodestrata.plans import store

    rows = spark.createDataFrame([("A", 1), ("B", None)], "name string, n int")
    store.save_json(rows, str(tmp_path / "j"))
    assert sorted(map(tuple, store.load_json(spark, str(tmp_path / "j"), "name string, n int").collect())) == [("A", 1), ("B", None)]
    assert store.load_json(spark, str(tmp_path / "none"), "name string, n int").isEmpty()


def test_files_are_read_as_lines(spark, tmp_path):
    from lodestrata.sources.lines import inventory, line_table, read_texts

    (tmp_path / "deep").mkdir()
    for name, text in (("A.cbl", b"one\r\ntwo\n"), ("b.CBL", b"caf\xff"), ("c.txt", b"no"), ("deep/D.cbl", b"deep")):
        (tmp_path / name).write_bytes(text)
    rows = line_table(read_texts(spark, str(tmp_path), "*.{cbl,CBL}")).select("source_file", "line_num", "line")
    assert sorted(map(tuple, rows.collect())) == [("A.cbl", 1, "one"), ("A.cbl", 2, "two"), ("b.CBL", 1, "caf\ufffd")]
    assert sorted((r.source_file, r.length) for r in inventory(spark, str(tmp_path), "*.cbl").collect()) == [("A.cbl", 9), ("D.cbl", 4)]


def test_blocks_by_parity_equal_a_loop(spark):
    import random

    from pyspark.sql import functions as F

    from lodestrata.operators.windows import block_numbers, by

    rnd = random.Random(4)
    rows = [(g, k, rnd.random() < 0.3, rnd.random() < 0.3) for g in range(40) for k in range(25)]
    want, state = {}, {}
    for g, k, s, e in rows:
        n, is_open = state.get(g, (0, False))
        began = s and not is_open
        n += began
        if is_open or began:
            want[g, k] = n
        state[g] = (n, (is_open or began) and not (e and not began))
    df = spark.createDataFrame(rows, "g int, k int, s boolean, e boolean")
    got = block_numbers(df, F.col("s"), F.col("e"), by("g", "k"), "n").where("n IS NOT NULL").collect()
    assert {(r.g, r.k): r.n for r in got} == want

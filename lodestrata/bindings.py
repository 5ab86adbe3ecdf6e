"""The library's operators bound to the generic test tables and to the fixture, with the SQL that checks each."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata import fixtures as fx
from lodestrata.functions.ids import node_id
from lodestrata.functions.pic import CANONICAL, java_type, normalize_pic
from lodestrata.functions.text import groups
from lodestrata.functions.rewrite import camel_case, cics_call, file_call, mq_call, perform_call, predicate, program_type
from lodestrata.operators import expand, extract, graph, structure
from lodestrata.operators.windows import adjacent_pairs, block_numbers, by, carry_forward, clamped, first_wins, lookahead, running
from lodestrata.plans import api, ir, reports, store
from lodestrata.sources import catalogs
from lodestrata.sources.lines import line_table, prepared

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def bind(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def big(*names: str):
    return [F.col(n).cast("long").alias(n) for n in names]


# --- operators on the test tables


@bind("SELECT o_orderkey, left(sha256('orders.tbl:' || o_orderkey || ':RowNode'), 32) AS uuid FROM orders")
def node_uuid(spark, d):
    return t(spark, d, "orders").select("o_orderkey", node_id(F.lit("orders.tbl"), "o_orderkey", F.lit("RowNode")).alias("uuid"))


@bind("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def first_wins_dedup(spark, d):
    return first_wins(t(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@bind("SELECT c_custkey, c_name FROM customer WHERE upper(c_mktsegment) = upper('building')")
def case_insensitive_lookup(spark, d):
    return api.either(t(spark, d, "customer"), {"c_mktsegment": "building"}).select("c_custkey", "c_name")


@bind("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1 OR n_nationkey = 3")
def or_neighbours(spark, d):
    return api.either(t(spark, d, "nation"), {"n_regionkey": "1", "n_nationkey": "3"}).select("n_nationkey", "n_name")


@bind("""
    WITH names AS (SELECT n_name AS name, 'N' || n_nationkey AS id FROM nation UNION ALL SELECT r_name, 'R' || r_regionkey FROM region),
    e AS (SELECT n_nationkey, lower(n_name) AS a, CASE WHEN n_nationkey % 3 = 0 THEN 'nowhere' ELSE r_name END AS b FROM nation JOIN region ON n_regionkey = r_regionkey)
    SELECT n_nationkey, x.id AS from_id, y.id AS to_id FROM e LEFT JOIN names x ON upper(x.name) = upper(a) LEFT JOIN names y ON upper(y.name) = upper(b)""")  # fmt: skip
def double_left_resolve(spark, d):
    nation, region = t(spark, d, "nation"), t(spark, d, "region")
    one = lambda df, name, mark, key: df.select(F.col(name).alias("name"), F.concat(F.lit(mark), key).alias("id"))
    names = one(nation, "n_name", "N", "n_nationkey").unionByName(one(region, "r_name", "R", "r_regionkey"))
    to = F.when(F.col("n_nationkey") % 3 == 0, "nowhere").otherwise(F.col("r_name"))
    edges = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.lower("n_name").alias("a"), to.alias("b"))
    return graph.double_resolve(edges, "a", "b", names, "name", [], "id").select("n_nationkey", "from_id", "to_id")


@bind("SELECT o_orderkey, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 30 DAY GROUP BY 1")
def range_join(spark, d):
    o, li = t(spark, d, "orders").select("o_orderkey", "o_orderdate"), t(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    on = (F.col("l_orderkey") == F.col("o_orderkey")) & F.col("l_shipdate").between(F.col("o_orderdate"), F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"))
    return o.join(li, on).groupBy("o_orderkey").agg(F.count("*").alias("n"))


@bind("""
    WITH p AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_returnflag = 'N'), c AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_returnflag = 'R')
    SELECT p.l_suppkey AS producer_job, c.l_suppkey AS consumer_job, p.l_partkey AS dataset_name, 'N' AS producer_disp, 'R' AS consumer_disp FROM p JOIN c USING (l_partkey) WHERE p.l_suppkey <> c.l_suppkey""")  # fmt: skip
def producer_consumer_deps(spark, d):
    return graph.dependencies(t(spark, d, "lineitem"), "l_suppkey", "l_partkey", "l_returnflag", ("N",), ("R",))


@bind("SELECT DISTINCT b.l_suppkey FROM lineitem a JOIN lineitem b ON a.l_partkey = b.l_partkey AND a.l_suppkey <> b.l_suppkey WHERE a.l_suppkey = 1 ORDER BY 1 LIMIT 20")
def shared_partner_topn(spark, d):
    li = t(spark, d, "lineitem").select("l_suppkey", "l_partkey").distinct()
    own = li.where("l_suppkey = 1").select("l_partkey")
    return li.where("l_suppkey <> 1").join(own, "l_partkey", "left_semi").select("l_suppkey").distinct().orderBy("l_suppkey").limit(20)


@bind("SELECT c_custkey, c_name FROM customer WHERE c_name NOT LIKE '%7' AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')")
def never_read_not_in(spark, d):
    t(spark, d, "customer").createOrReplaceTempView("_customer")
    t(spark, d, "orders").createOrReplaceTempView("_orders")
    return spark.sql("SELECT c_custkey, c_name FROM _customer WHERE c_name NOT LIKE '%7' AND c_custkey NOT IN (SELECT o_custkey FROM _orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')")


@bind("SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45")
def unaccessed_except(spark, d):
    return t(spark, d, "part").select("p_partkey").subtract(t(spark, d, "lineitem").where("l_returnflag = 'R' AND l_quantity > 45").select("l_partkey"))


@bind("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def dead_targets_anti(spark, d):
    return graph.never_targeted(t(spark, d, "documents").select("doc_id"), "doc_id", t(spark, d, "labels"), "doc_id")


@bind("""
    WITH c AS (SELECT o_custkey AS g, list_sort(list(DISTINCT o_orderstatus || '|' || o_orderpriority)) AS s FROM orders GROUP BY 1), r AS (SELECT s, min(g) AS rep FROM c GROUP BY 1),
    p AS (SELECT x.rep AS a, y.rep AS b, len(list_intersect(x.s, y.s)) AS shared, len(x.s) + len(y.s) AS n FROM r x JOIN r y ON x.rep < y.rep)
    SELECT a, b, shared::BIGINT AS shared, round(shared / (n - shared), 3) AS similarity, 'pair' AS kind FROM p WHERE shared / (n - shared) >= 0.6
    UNION ALL SELECT rep, g, len(s)::BIGINT, 1.0, 'member' FROM c JOIN r USING (s) WHERE g <> rep""")  # fmt: skip
def clone_jaccard(spark, d):
    # customers with equal sets are one class: pairs of its least members, and a row from that member to each of the others
    pairs, members = graph.jaccard_classes(t(spark, d, "orders"), "o_custkey", ["o_orderstatus", "o_orderpriority"], 0.6)
    others = members.where("g <> rep").select(F.col("rep").alias("a"), F.col("g").alias("b"), F.col("size").alias("shared"), F.lit(1.0).alias("similarity"))
    return pairs.withColumn("kind", F.lit("pair")).unionByName(others.withColumn("kind", F.lit("member")))


@bind("""
    SELECT event_type, count(*) AS n, count(*) FILTER (k IS NOT NULL) AS with_k, count(*) FILTER (k % 2 = 0) AS even_k, sum(CASE WHEN k < 10 THEN 1 ELSE 0 END)::BIGINT AS small_k
    FROM (SELECT event_type, (props->>'$.k')::BIGINT AS k FROM events) GROUP BY 1""")  # fmt: skip
def json_type_distribution(spark, d):
    rows = t(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").try_cast("long"))
    return reports.tally(rows, "event_type", with_k=F.col("k").isNotNull(), even_k=F.col("k") % 2 == 0, small_k=F.col("k") < 10)


@bind("SELECT o_custkey, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 5")
def top_groups(spark, d):
    # lines are counted by order first, so orders meet one row each
    per = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("c"))
    return t(spark, d, "orders").select("o_orderkey", "o_custkey").join(per, "o_orderkey").groupBy("o_custkey").agg(F.sum("c").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(5)


@bind("SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 10")
def shared_top10(spark, d):
    return t(spark, d, "lineitem").groupBy("l_partkey").agg(F.count_distinct("l_suppkey").alias("n")).orderBy(F.desc("n"), "l_partkey").limit(10)


@bind("""
    SELECT user_id, coalesce(string_agg(event_id::VARCHAR, ',' ORDER BY event_id) FILTER (event_type = 'click'), '') AS reads,
        coalesce(string_agg(event_id::VARCHAR, ',' ORDER BY event_id) FILTER (event_type = 'purchase'), '') AS writes, count(*) AS n, min(event_id) AS first_seen FROM events GROUP BY 1 ORDER BY first_seen, user_id LIMIT 50""")  # fmt: skip
def group_read_write(spark, d):
    pick = lambda kind: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("event_type") == kind, F.col("event_id")))), lambda x: x.cast("string")), ",")
    return t(spark, d, "events").groupBy("user_id").agg(pick("click").alias("reads"), pick("purchase").alias("writes"), F.count("*").alias("n"), F.min("event_id").alias("first_seen")).orderBy("first_seen", "user_id").limit(50)


@bind("SELECT o_orderpriority, count(*) AS n, array_to_string(list_sort(list(o_orderkey))[1:5], ',') AS first FROM orders GROUP BY 1")
def kind_samples(spark, d):
    # only the first five of each group are gathered; the count is apart
    rows = t(spark, d, "orders").select("o_orderpriority", "o_orderkey")
    n = rows.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    five = rows.withColumn("rn", F.row_number().over(by("o_orderpriority", "o_orderkey"))).where("rn <= 5").groupBy("o_orderpriority").agg(F.array_sort(F.collect_list("o_orderkey")).alias("f"))
    return n.join(five, "o_orderpriority").select("o_orderpriority", "n", F.array_join(F.transform("f", lambda x: x.cast("string")), ",").alias("first"))


@bind("""
    SELECT lang, count(*) AS total, count(*) FILTER (quality = 1) AS passed, round(100.0 * count(*) FILTER (quality = 1) / count(*), 1) AS pass_rate
    FROM documents JOIN labels USING (doc_id) GROUP BY ROLLUP (lang)""")  # fmt: skip
def coverage_rollup(spark, d):
    rows = t(spark, d, "documents").select("doc_id", "lang").join(t(spark, d, "labels"), "doc_id")
    return reports.coverage(rows, "lang", F.col("quality") == 1)


@bind("SELECT event_id, coalesce(last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), -1) AS header FROM events")
def carry_forward_header(spark, d):
    w = by("user_id", ["ts", "event_id"])
    return t(spark, d, "events").select("event_id", F.coalesce(carry_forward(F.when(F.col("event_type") == "signup", F.col("event_id")), w), F.lit(-1)).alias("header"))


@bind("""
    WITH s AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'signup'),
    e AS (SELECT s.user_id, s.event_id, s.ts, min(p.ts) AS stop FROM s LEFT JOIN events p ON p.user_id = s.user_id AND p.event_type = 'purchase' AND p.ts > s.ts GROUP BY 1, 2, 3)
    SELECT user_id, min(event_id) AS block, count(*) AS n FROM (SELECT *, first_value(event_id) OVER (PARTITION BY user_id, stop ORDER BY ts) AS b FROM e) GROUP BY user_id, b""")  # fmt: skip
def block_collect(spark, d):
    rows = t(spark, d, "events")
    found = block_numbers(rows, F.col("event_type") == "signup", F.col("event_type") == "purchase", by("user_id", ["ts", "event_id"]), "block_n")
    return found.where("event_type = 'signup'").groupBy("user_id", "block_n").agg(F.min("event_id").alias("block"), F.count("*").alias("n")).select("user_id", "block", "n")


@bind("""
    WITH w AS (SELECT event_id, user_id, ts, sum(CASE event_type WHEN 'view' THEN 1 WHEN 'error' THEN -1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM events)
    SELECT event_id, (s - least(0, min(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)))::BIGINT AS depth FROM w""")  # fmt: skip
def clamped_depth(spark, d):
    rows = t(spark, d, "events").withColumn("delta", F.when(F.col("event_type") == "view", 1).when(F.col("event_type") == "error", -1).otherwise(0))
    return clamped(rows, "delta", by("user_id", ["ts", "event_id"]), "depth").select("event_id", F.col("depth").cast("long").alias("depth"))


@bind("""
    SELECT conv_id, turn, coalesce((SELECT min(b.turn) FROM conversations b WHERE b.conv_id = a.conv_id AND b.role = 'assistant' AND b.turn > a.turn AND b.turn <= a.turn + 4), -1) AS answer FROM conversations a WHERE role = 'user'""")  # fmt: skip
def lookahead_action(spark, d):
    rows = t(spark, d, "conversations").select("conv_id", "turn", "role").withColumn("next", lookahead(F.struct("turn", "role"), 4, by("conv_id", "turn")))
    near = F.filter("next", lambda x: (x["role"] == "assistant") & (x["turn"] <= F.col("turn") + 4))
    return rows.where("role = 'user'").select("conv_id", "turn", F.coalesce(F.array_min(F.transform(near, lambda x: x["turn"])), F.lit(-1)).alias("answer"))


@bind("SELECT a, b, count(*) AS n FROM (SELECT role AS a, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations) WHERE b IS NOT NULL GROUP BY 1, 2")
def adjacent_pairs_roles(spark, d):
    roles = t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("r"))
    pairs = roles.select(F.explode(adjacent_pairs(F.transform("r", lambda x: x["role"]))).alias("p"))
    return pairs.groupBy("p.a", "p.b").agg(F.count("*").alias("n"))


@bind("""
    WITH l AS (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|[\\n\\r\\x0B\\x0C\\x1C\\x1D\\x1E\\x{85}\\x{2028}\\x{2029}]') AS p FROM documents),
    k AS (SELECT doc_id, CASE WHEN p[-1] = '' THEN p[:-2] ELSE p END AS x FROM l)
    SELECT doc_id, generate_subscripts(x, 1) AS line_num, unnest(x) AS line FROM k""")  # fmt: skip
def line_table_documents(spark, d):
    rows = line_table(t(spark, d, "documents").select("doc_id", "text"), key="doc_id")
    return rows.select("doc_id", F.col("line_num").cast("long").alias("line_num"), "line")


@bind("SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS href FROM pages")
def regex_extract_all(spark, d):
    return t(spark, d, "pages").select("page_id", F.explode(groups("html", 'href="([^"]*)"')).alias("href"))


@bind("SELECT page_id, split_part(kv, '=', 1) AS key, split_part(kv, '=', 2) AS value FROM (SELECT page_id, unnest(string_split(split_part(url, '?', 2), '&')) AS kv FROM pages WHERE contains(url, '?'))")
def keyvalue_params(spark, d):
    rows = t(spark, d, "pages").where(F.col("url").contains("?")).select("page_id", F.explode(F.split(F.get(F.split("url", r"\?"), F.lit(1)), "&")).alias("kv"))
    part = lambda k: F.coalesce(F.get(F.split("kv", "="), F.lit(k)), F.lit(""))
    return rows.select("page_id", part(0).alias("key"), part(1).alias("value"))


@bind("SELECT regexp_extract(url, '^(.*?)([0-9]+)$', 1) AS base_dsn, count(*) AS n, min(regexp_extract(url, '^(.*?)([0-9]+)$', 2)::BIGINT) AS first_generation, max(regexp_extract(url, '^(.*?)([0-9]+)$', 2)::BIGINT) AS last_generation FROM pages WHERE regexp_matches(url, '^(.*?)([0-9]+)$') GROUP BY 1")
def gdg_registry(spark, d):
    p = r"^(.*?)([0-9]+)$"
    rows = t(spark, d, "pages").where(F.col("url").rlike(p)).select(F.regexp_extract("url", p, 1).alias("base_dsn"), F.regexp_extract("url", p, 2).cast("long").alias("g"))
    return rows.groupBy("base_dsn").agg(F.count("*").alias("n"), F.min("g").alias("first_generation"), F.max("g").alias("last_generation"))


@bind("""
    WITH RECURSIVE e AS (SELECT DISTINCT p_size AS target, (p_size * 7 + p_partkey) % 11 AS source FROM part WHERE p_size <> (p_size * 7 + p_partkey) % 11),
    w AS (SELECT DISTINCT target AS root, target AS place, 0 AS d FROM e UNION SELECT root, e.source, d + 1 FROM w JOIN e ON e.target = w.place WHERE d <= 5)
    SELECT DISTINCT root::BIGINT AS root, place::BIGINT AS origin FROM w WHERE d > 5 OR place NOT IN (SELECT target FROM e)""")  # fmt: skip
def lineage_origins(spark, d):
    edges = t(spark, d, "part").select(F.col("p_size").cast("long").alias("target"), ((F.col("p_size") * 7 + F.col("p_partkey")) % 11).alias("source")).where("target <> source")
    return graph.origins(edges, edges.select("target").distinct())


@bind("""
    SELECT "table", id, name FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY prio) AS rn FROM (SELECT 0 AS prio, 'customer' AS "table", c_custkey AS id, c_name AS name FROM customer
    UNION ALL SELECT 1, 'supplier', s_suppkey, s_name FROM supplier UNION ALL SELECT 2, 'part', p_partkey, p_name FROM part)) WHERE rn = 1""")  # fmt: skip
def priority_union(spark, d):
    sides = (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"), ("part", "p_partkey", "p_name"))
    rows = reduce(DataFrame.unionByName, (t(spark, d, n).select(F.lit(p).alias("prio"), F.lit(n).alias("table"), F.col(k).alias("id"), F.col(c).alias("name")) for p, (n, k, c) in enumerate(sides)))
    return first_wins(rows, ["id"], ["prio"]).select("table", "id", "name")


@bind("SELECT 0 AS n, 'graph TD' AS text UNION ALL SELECT DISTINCT 1, '    ' || n_name || ' -->|in| ' || r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def distinct_edges_text(spark, d):
    edges = t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return reports.mermaid(edges, "n_name", "r_name", F.lit("in"))


@bind("""
    SELECT DISTINCT p_type, list_aggregate(list_transform(string_split(replace(replace(upper(p_type), ' ', '-'), '_', '-'), '-'), lambda x, i: CASE WHEN i = 1 THEN lower(x) ELSE upper(x[1:1]) || lower(x[2:]) END), 'string_agg', '') AS camel FROM part""")  # fmt: skip
def camel_case_types(spark, d):
    return t(spark, d, "part").select("p_type").distinct().withColumn("camel", camel_case(F.replace(F.upper("p_type"), F.lit(" "), F.lit("-"))))


@bind("SELECT p_brand, coalesce(min_by(context, ord), 'Unknown') AS seam FROM (SELECT DISTINCT p_brand FROM part) LEFT JOIN (VALUES (1, 'First', 'BRAND#11'), (2, 'Second', 'BRAND#11'), (2, 'Second', 'BRAND#12'), (3, 'Third', 'BRAND#21')) v(ord, context, member) ON member = upper(p_brand) GROUP BY 1")
def seam_first_match(spark, d):
    contexts = spark.createDataFrame([(1, "First", "Brand#11"), (2, "Second", "Brand#11"), (2, "Second", "Brand#12"), (3, "Third", "Brand#21")], "ord int, context string, member string")
    return ir.seam(t(spark, d, "part").select("p_brand").distinct(), contexts, "p_brand")


@bind("SELECT node, sum(o)::BIGINT AS n_out, sum(i)::BIGINT AS n_in FROM (SELECT o_custkey AS node, 1 AS o, 0 AS i FROM orders UNION ALL SELECT o_orderkey, 0, 1 FROM orders) GROUP BY 1")
def graph_degrees(spark, d):
    return graph.degrees(t(spark, d, "orders"), "o_custkey", "o_orderkey")


@bind("""
    WITH RECURSIVE w AS (SELECT 1::BIGINT AS node, 0 AS hops UNION SELECT l.l_partkey, hops + 1 FROM w JOIN lineitem l ON l.l_suppkey = w.node WHERE hops < 3)
    SELECT node, min(hops) AS hops FROM w GROUP BY 1""")  # fmt: skip
def k_hop_reach(spark, d):
    edges = t(spark, d, "lineitem").select("l_suppkey", "l_partkey")
    return graph.reach(edges, spark.createDataFrame([(1,)], "node long"), "l_suppkey", "l_partkey", 3)


@bind("SELECT count(*) FILTER (event_type = 'signup') AS success, count(*) FILTER (event_type = 'error') AS failure, 0::BIGINT AS gap, count(*) FILTER (event_type = 'view') AS warning FROM events")
def event_log_counts(spark, d):
    kinds = F.when(F.col("event_type") == "signup", "SUCCESS").when(F.col("event_type") == "error", "FAILURE").when(F.col("event_type") == "view", "WARNING")
    return reports.event_counts(t(spark, d, "events").select(kinds.alias("type")))


@bind("SELECT l_returnflag, floor(sum(l_quantity) / greatest(1, count(*)))::BIGINT AS mean_floor, coalesce(max(l_linenumber), 1)::INTEGER AS most FROM lineitem GROUP BY 1")
def floor_mean_and_max(spark, d):
    return t(spark, d, "lineitem").groupBy("l_returnflag").agg(F.floor(F.sum("l_quantity") / F.greatest(F.lit(1), F.count("*"))).alias("mean_floor"), F.coalesce(F.max("l_linenumber"), F.lit(1)).alias("most"))


# --- operators on the fixture: expected rows are VALUES


def fixture(columns: str, rows: list[tuple]) -> Callable[[Query], Query]:
    """Bind a fixture query to its hand-derived rows."""

    def lit(x: object) -> str:
        if x is None:
            return "NULL"
        return str(x).upper() if isinstance(x, bool) else str(x) if isinstance(x, (int, float)) else "'" + str(x).replace("'", "''") + "'"

    names, kinds = zip(*(c.strip().split() for c in columns.split(",")), strict=True)
    values = ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)
    quoted = [f'"{n}"' for n in names]
    return bind(f"SELECT {', '.join(f'{n}::{k} AS {n}' for n, k in zip(quoted, kinds, strict=True))} FROM (VALUES {values}) v({', '.join(quoted)})")


# the fixture is a few kilobytes: read, expanded and stored once for a session, as rows without the plans that made them


def _settled(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.collect(), df.schema).coalesce(1)


@lru_cache(maxsize=1)
def _programs(spark):
    return _settled(prepared(fx.lines(spark, fx.PROGRAMS)))


@lru_cache(maxsize=1)
def _full(spark):
    return _settled(expand.expand(_programs(spark), fx.lines(spark, fx.COPYBOOKS, "name")))


def _text(c):
    return F.array_join(c, ",")


PICS = [
    ("X(08)", None, "alphanumeric", 8, None, None, False), ("XX", None, "alphanumeric", 1, None, None, False), ("9(11)", None, "numeric", None, 11, 0, False), ("S9(9)V99", "COMP-3", "decimal", None, 11, 2, True),
    ("S9(09)", "COMP", "binary", None, 9, 0, True), ("999V99", None, "decimal", None, 7, 2, False), ("99V9(3)", None, "decimal", None, 6, 3, False), ("Z,ZZZ", None, "edited_numeric", None, None, None, False),
    (None, None, "group", 0, None, None, None), ("B", None, "unknown", None, None, None, None), ("S9(5)", "COMP-3", "packed_decimal", None, 5, 0, True),
]


@fixture("pic VARCHAR, kind VARCHAR, length INTEGER, precision INTEGER, scale INTEGER, signed BOOLEAN", [(p, *(x if x is not None else False if k == 4 else -1 for k, x in enumerate(r))) for p, _, *r in PICS])
def pic_normalize(spark, d):
    rows = spark.createDataFrame([(p, u) for p, u, *_ in PICS], "pic string, usage string")
    return rows.withColumn("c", normalize_pic("pic", "usage")).select("pic", "c.kind", *(F.coalesce(f"c.{x}", F.lit(-1)).alias(x) for x in ("length", "precision", "scale")), F.coalesce("c.signed", F.lit(False)).alias("signed"))


@fixture("pic VARCHAR, java_type VARCHAR, note VARCHAR", [("X(08)", "String", "PIC X(8)"), ("9(11)", "long", "PIC 9 zoned decimal"), ("S9(9)V99", "BigDecimal", "PIC S9(9)V9(2) COMP-3"), ("S9(09)", "int", "COMP/COMP-4 binary")])
def canonical_java(spark, d):
    rows = spark.createDataFrame([(p, u) for p, u, *_ in PICS if p in ("X(08)", "9(11)", "S9(9)V99", "S9(09)")], "pic string, usage string")
    typed = rows.withColumn("c", F.from_json(F.to_json(normalize_pic("pic", "usage")), CANONICAL))  # keeps the optimizer from copying the type's expression
    return typed.withColumn("j", java_type(F.col("c"))).select("pic", "j.java_type", "j.note")


@fixture("p VARCHAR, java VARCHAR", [("WS-A NOT = SPACES", 'WS-A != ""'), ("RECORD = ZEROS AND X > 1", "REC||D == 0 && X > 1"), ("NOT FLAG", "!FLAG")])
def predicate_rewrite(spark, d):
    return spark.createDataFrame([("WS-A NOT = SPACES",), ("RECORD = ZEROS AND X > 1",), ("NOT FLAG",)], "p string").withColumn("java", predicate("p"))


@fixture("verb VARCHAR, java VARCHAR", [("XCTL", 'cicsXctl("P1", commArea)'), ("READ", "repository.findById(key)"), ("OPEN_INPUT", "repository.open_input()"), ("GET", 'jmsTemplate.receive("Q")'), ("PERFORM_UNTIL", "whileLoop"), ("ODD", "methodCall"), ("COX", "online")])
def verb_maps(spark, d):
    one = spark.range(1).select(F.create_map(F.lit("PROGRAM"), F.lit("P1")).alias("p"))
    pairs = [("XCTL", cics_call(F.lit("XCTL"), F.col("p"))), ("READ", file_call(F.lit("READ"))), ("OPEN_INPUT", file_call(F.lit("OPEN_INPUT"))), ("GET", mq_call(F.lit("GET"), F.lit("Q"))), ("PERFORM_UNTIL", perform_call(F.lit("PERFORM_UNTIL"))), ("ODD", perform_call(F.lit("ODD"))), ("COX", program_type(F.lit("COX")))]
    return one.select(F.explode(F.array(*(F.struct(F.lit(v).alias("verb"), j.alias("java")) for v, j in pairs))).alias("x")).select("x.*")


@fixture("source_file VARCHAR, total_lines BIGINT, original_lines BIGINT, copybook_lines BIGINT, replaced_lines BIGINT, copybooks VARCHAR", [("FIXA01C.cbl", 36, 33, 3, 0, "FIXREC"), ("COFIX02C.cbl", 31, 26, 5, 5, "FIXNEST,FIXREC")])
def provenance_summary(spark, d):
    return expand.summary(_full(spark)).withColumn("copybooks", _text("copybooks"))


@fixture("expanded_line_num INTEGER, content VARCHAR, origin_file VARCHAR, origin_line_num INTEGER, copy_depth INTEGER", [(12, "       01 :TAG:-OUTER.", "FIXNEST.cpy", 1, 1), (13, "          05 :TAG:-KEY PIC X(08).", "FIXNEST.cpy", 2, 1), (14, "       01 FIX-REC.", "FIXREC.cpy", 1, 2), (15, "          05 FIX-ID PIC 9(11).", "FIXREC.cpy", 2, 2), (16, "          05 FIX-AMT PIC S9(9)V99 COMP-3.", "FIXREC.cpy", 3, 2)])
def copy_expand(spark, d):
    rows = _full(spark).where("source_file = 'COFIX02C.cbl' AND copybook IS NOT NULL")
    return rows.select("expanded_line_num", "content", "origin_file", "origin_line_num", "copy_depth")


@fixture("caller VARCHAR, callee VARCHAR, call_type VARCHAR, is_dynamic BOOLEAN, paragraph VARCHAR, line INTEGER", [("FIXA01C", "SUBPGM1", "CALL", False, "MAIN-PARA", 17), ("FIXA01C", "WS-PGM", "CALL", True, "2000-READ", 28), ("COFIX02C", "MQPUT", "CALL", False, "3000-LOOP", 27), ("COFIX02C", "MQOPEN", "CALL", False, "3000-LOOP", 28), ("COFIX02C", "FIXA01C", "CICS_XCTL", False, "UNKNOWN", 0)])
def call_edges(spark, d):
    return extract.call_graph(_programs(spark)).drop("source_file")


@fixture("from_paragraph VARCHAR, to_paragraph VARCHAR, edge_type VARCHAR, condition VARCHAR, line INTEGER", [("MAIN-PARA", "1000-OPEN", "PERFORM", None, 10), ("MAIN-PARA", "2000-READ", "PERFORM_UNTIL", "WS-FLAG = 'Y'", 11), ("MAIN-PARA", "9000-CLOSE", "PERFORM_CONDITIONAL", None, 13), ("1000-OPEN", "1100-INIT", "PERFORM", "THRU 1100-EXIT", 21), ("MAIN-PARA", "3000-LOOP", "PERFORM_VARYING", None, 17)])
def cfg_edges(spark, d):
    return extract.control_flow(_programs(spark)).drop("program", "source_file")


@fixture("kind VARCHAR, predicate_raw VARCHAR, then_summary VARCHAR, else_summary VARCHAR, paragraph VARCHAR, line INTEGER", [("IF", "WS-FLAG = 'Y'", "PERFORM 9000-CLOSE", "MOVE 'N' TO WS-FLAG", "MAIN-PARA", 12), ("EVALUATE", "EVALUATE WS-FLAG WHEN 'A'", "2 WHEN clauses", "", "2000-READ", 24)])
def business_rules(spark, d):
    return extract.business_rules(_programs(spark)).drop("program", "source_file")


@fixture("file_name VARCHAR, operation VARCHAR, paragraph VARCHAR, line INTEGER", [("IN-FILE", "OPEN_INPUT", "1000-OPEN", 19), ("IN-FILE", "READ", "2000-READ", 23), ("IN-FILE", "CLOSE", "9000-CLOSE", 31)])
def file_io_ops(spark, d):
    return extract.file_io(_programs(spark)).drop("program", "source_file")


@fixture("verb VARCHAR, paragraph VARCHAR, line INTEGER, params VARCHAR, uuid VARCHAR", [("RETURN", "9000-CLOSE", 32, "TRANSID=FX01", "47ef5944056dbd2f728a6115f3aa80c4"), ("XCTL", "MAIN-PARA", 18, "PROGRAM=FIXA01C", "60eb8e0866c67b60cea975ff70e04400")])
def cics_stmts(spark, d):
    rows = extract.cics(_programs(spark))
    shown = _text(F.transform(F.map_entries("params"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return rows.select("verb", "paragraph", "line", shown.alias("params"), node_id("source_file", "line", "verb").alias("uuid"))


@fixture("verb VARCHAR, pcb VARCHAR, segment VARCHAR, where_ VARCHAR, line INTEGER", [("GU", "1", "CUSTSEG", "CUSTKEY = WS-KEY", 24)])
def dli_stmts(spark, d):
    return extract.dli(_programs(spark)).select("verb", "pcb", "segment", F.col("where").alias("where_"), "line")


@fixture("verb VARCHAR, operation VARCHAR, queue VARCHAR, paragraph VARCHAR, line INTEGER", [("MQPUT", "PUT", "REPLY-QUEUE", "3000-LOOP", 27), ("MQOPEN", "MQOPEN", "REQUEST-QUEUE", "3000-LOOP", 28)])
def mq_calls(spark, d):
    return extract.mq_calls(_programs(spark)).select("verb", extract.mq_operation(F.col("verb")).alias("operation"), "queue", "paragraph", "line")


@fixture("source VARCHAR, targets VARCHAR, is_literal BOOLEAN, line INTEGER", [("'N'", "WS-FLAG", True, 15), ("WS-IN", "WS-OUT", False, 26), ("WS-KEY", "WS-TMP,WS-OUT", False, 22), ("WS-TMP", "WS-OUT-KEY", False, 23)])
def move_edges(spark, d):
    return extract.moves(_programs(spark)).select("source", _text("targets").alias("targets"), "is_literal", "line")


@fixture("root VARCHAR, origin VARCHAR", [("WS-OUT", "WS-IN"), ("WS-OUT", "WS-KEY"), ("WS-OUT-KEY", "WS-KEY")])
def move_origins(spark, d):
    edges = graph.lineage(extract.moves(_programs(spark)))
    return graph.origins(edges, edges.where("target LIKE 'WS-OUT%'").select("target").distinct())


@fixture("variable VARCHAR, operation VARCHAR, stmt_type VARCHAR, line INTEGER", [("WS-OUT", "WRITE", "MOVE", 22), ("WS-KEY", "READ", "MOVE", 22), ("WS-OUT-KEY", "WRITE", "MOVE", 23), ("WS-TMP", "READ", "MOVE", 23), ("LOOP", "READ", "PERFORM", 17), ("WS-COUNT", "READ", "PERFORM", 17)])
def def_use(spark, d):
    rows = extract.def_use(extract.statements(_programs(spark)))
    return rows.where("source_file = 'COFIX02C.cbl'").select("variable", "operation", "stmt_type", "line")


@fixture("name VARCHAR, start_line INTEGER, end_line INTEGER, statement_count INTEGER, complexity INTEGER, uuid VARCHAR", [("MAIN-PARA", 9, 17, 6, 3, "f63132171c4f3483e52fb9b721650e80"), ("1000-OPEN", 18, 21, 2, 1, "97bc491961244aa222b08722f464976e"), ("2000-READ", 22, 29, 4, 5, "161bdabc00a6893ec16ed70fab0b7986"), ("9000-CLOSE", 30, 36, 2, 1, "f33f9f5fb9adb672610514cc581a8510")])
def paragraph_inventory(spark, d):
    rows = structure.paragraphs(_full(spark)).where("source_file = 'FIXA01C.cbl'")
    return rows.select("name", "start_line", "end_line", "statement_count", "complexity", "uuid")


@fixture("name VARCHAR, defined_at_line INTEGER, copybook_origin VARCHAR, kind VARCHAR", [("FIX-REC", 1, None, "group"), ("FIX-ID", 2, None, "numeric"), ("FIX-AMT", 3, None, "decimal"), ("WS-FLAG", 7, "FIXREC", "alphanumeric")])
def symbol_table(spark, d):
    rows = structure.symbols(_full(spark)).where("source_file = 'FIXA01C.cbl'")
    return rows.select("name", "defined_at_line", "copybook_origin", F.col("canonical_type.kind").alias("kind"))


@fixture("kind VARCHAR, n BIGINT, children BIGINT", [("ProgramNode", 2, 6), ("ParagraphNode", 6, 0)])
def ast_nodes(spark, d):
    return structure.ast_nodes(_full(spark)).groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.size("children_uuids")).alias("children"))


@fixture("job_name VARCHAR, step_name VARCHAR, program_name VARCHAR, dd_name VARCHAR, dataset_name VARCHAR, disposition VARCHAR, steplib VARCHAR", [("JOBA", "STEP1", "FIXA01C", "OUTDD", "FIX.DATA(+1)", "NEW", "FIX.LOADLIB"), ("JOBB", "STEP1", "FIXB01C", "INDD", "FIX.DATA(0)", "SHR", ""), ("JOBB", "STEP1", "FIXB01C", "LIBDD", "FIX.LOADLIB(MEMBER)", "OLD", "")])
def jcl_jobs(spark, d):
    return catalogs.jcl(fx.lines(spark, fx.JCL)).drop("parm", "line_num", "source_file")


@fixture("producer_job VARCHAR, consumer_job VARCHAR, dataset_name VARCHAR, producer_disp VARCHAR, consumer_disp VARCHAR", [("JOBA", "JOBB", "FIX.DATA", "NEW", "SHR")])
def jcl_dependencies(spark, d):
    return graph.dependencies(catalogs.jcl(fx.lines(spark, fx.JCL)), "job_name", graph.base_dataset("dataset_name"), "disposition", order="line_num")


@fixture("base_dsn VARCHAR, job_name VARCHAR, dd_name VARCHAR, generation VARCHAR, disposition VARCHAR", [("FIX.DATA", "JOBA", "OUTDD", "+1", "NEW"), ("FIX.DATA", "JOBB", "INDD", "0", "SHR")])
def gdg_references(spark, d):
    return catalogs.gdg_references(catalogs.jcl(fx.lines(spark, fx.JCL)))


@fixture("name VARCHAR, is_named BOOLEAN, row INTEGER, col INTEGER, length INTEGER, protected BOOLEAN, input BOOLEAN, color VARCHAR", [("FILLER000", False, 1, 1, 5, True, False, ""), ("ACCT", True, 2, 10, 11, True, True, "GREEN")])
def bms_fields(spark, d):
    return catalogs.bms(fx.lines(spark, fx.BMS)).select("name", "is_named", "row", "col", "length", "protected", "input", "color")


@fixture("line_num INTEGER, line VARCHAR", [(1, "       01 FIXMAPI."), (2, "           02 ACCTL COMP PIC S9(4)."), (3, "           02 ACCTA PIC X."), (4, "           02 ACCTI PIC X(11)."), (5, "       01 FIXMAPO REDEFINES FIXMAPI."), (6, "           02 FILLER PIC X(3)."), (7, "           02 ACCTO PIC X(11).")])
def bms_stub_copybook(spark, d):
    return catalogs.bms_stubs(catalogs.bms(fx.lines(spark, fx.BMS))).select("line_num", "line")


@fixture("kind VARCHAR, name VARCHAR, grp VARCHAR, n_params INTEGER", [("FILE", "ACCTFIL", "FIX", 5), ("FILE", "ACCTAIX", "FIX", 3), ("TRANSACTION", "FX01", "FIX", 3), ("TRANSACTION", "FX02", "FIX", 3), ("PROGRAM", "FIXA01C", "FIX", 2), ("MAPSET", "FIXSET", "FIX", 3)])
def csd_resources(spark, d):
    return catalogs.csd(fx.lines(spark, fx.CSD)).select("kind", "name", F.col("group").alias("grp"), F.size("params").alias("n_params"))


@fixture("table_name VARCHAR, columns VARCHAR, primary_key VARCHAR, references_table VARCHAR", [("FIX.ACCOUNT", "ACCT_ID CHAR 11 true,BALANCE DECIMAL 9,2 false,OPENED DATE  false", "ACCT_ID", "FIX.CUSTOMER")])
def ddl_tables(spark, d):
    shown = _text(F.transform("columns", lambda c: F.concat_ws(" ", c["name"], c["type"], c["size"], c["not_null"].cast("string"))))
    return catalogs.ddl(fx.sources(spark).ddl).select("table_name", shown.alias("columns"), _text("primary_key").alias("primary_key"), "references_table")


@fixture("segment VARCHAR, parent VARCHAR, bytes INTEGER, n_fields BIGINT, key_field VARCHAR", [("ROOTSEG", "ROOT", 100, 2, "ROOTKEY,U"), ("CHILDSEG", "ROOTSEG", 50, 0, "")])
def dbd_segments(spark, d):
    return catalogs.dbd_segments(catalogs.dbd(fx.lines(spark, fx.DBD))).select("segment", "parent", "bytes", "n_fields", "key_field")


@fixture("name VARCHAR, source_file VARCHAR, entry_type VARCHAR, description VARCHAR", [("FIXDATE", "FIXDATE.asm", "CSECT", "Dates"), ("FIXWAIT", "FIXWAIT.asm", "START", "Assembler routine")])
def asm_stubs(spark, d):
    return catalogs.assembler_stubs(fx.lines(spark, fx.ASM), {"FIXDATE": "Dates"})


@fixture("name VARCHAR, vsam_type VARCHAR, record_length INTEGER, key_field VARCHAR, programs VARCHAR, indexes VARCHAR", [("ACCTFIL", "KSDS", 120, "ACCT-ID", "COFIX02C", "ACCTAIX"), ("ACCTAIX", "AIX", 0, None, "", "")])
def vsam_schemas(spark, d):
    rows = catalogs.vsam_schemas(catalogs.csd_kind(catalogs.csd(fx.lines(spark, fx.CSD)), "FILE"), _programs(spark))
    return rows.select("name", "vsam_type", "record_length", "key_field", _text("programs_using").alias("programs"), _text("alternate_indexes").alias("indexes"))


@fixture("from_program VARCHAR, to_program VARCHAR, edge_type VARCHAR, from_transid VARCHAR, to_transid VARCHAR", [("FIXA01C", "", "RETURN", "FX01", "FX01"), ("COFIX02C", "FIXA01C", "XCTL", "FX02", "FX01")])
def transaction_flow(spark, d):
    p = _programs(spark)
    rows = graph.transaction_flow(extract.call_graph(p), extract.cics(p), catalogs.csd_kind(catalogs.csd(fx.lines(spark, fx.CSD)), "TRANSACTION"))
    return rows.select("from_program", "to_program", "edge_type", "from_transid", "to_transid")


@fixture("source_file VARCHAR, line INTEGER, text VARCHAR", [("FIXA01C.cbl", 1, "* FIXA01C - SYNTHETIC FIXTURE"), ("FIXA01C.cbl", 20, "*    PERFORM 9999-COMMENTED")])
def token_comments(spark, d):
    return extract.comments(extract.tokens(_programs(spark))).select("source_file", "line", "text")


# --- the store, its routes, reports and the intermediate representation, over the fixture


@lru_cache(maxsize=1)
def _store(spark) -> dict[str, DataFrame]:
    src = fx.sources(spark)
    src.programs = _programs(spark)
    return {k: _settled(df) for k, df in store.build(src, _full(spark)).items()}


COUNTS = {
    "nodes": 8, "symbols": 9, "paragraphs": 6, "call_graph": 5, "control_flow": 5, "def_use": 14, "file_io": 3, "db_io": 1, "ims_io": 1, "mq_io": 2, "transaction_flow": 2, "screen_map": 0, "jcl_job": 3,
    "jcl_dependency": 1, "copybook_use": 3, "business_rules": 2, "migration_risk": 0,
}


@fixture("name VARCHAR, n BIGINT", list(COUNTS.items()))
def store_row_counts(spark, d):
    return reports.row_counts(_store(spark)).withColumnRenamed("table", "name")


@fixture("from_uuid VARCHAR, to_uuid VARCHAR, edge_type VARCHAR, from_id VARCHAR, to_id VARCHAR", [("MAIN-PARA", "1000-OPEN", "PERFORM", "f63132171c4f3483e52fb9b721650e80", "97bc491961244aa222b08722f464976e"), ("MAIN-PARA", "2000-READ", "PERFORM_UNTIL", "f63132171c4f3483e52fb9b721650e80", "161bdabc00a6893ec16ed70fab0b7986"), ("MAIN-PARA", "9000-CLOSE", "PERFORM_CONDITIONAL", "f63132171c4f3483e52fb9b721650e80", "f33f9f5fb9adb672610514cc581a8510"), ("1000-OPEN", "1100-INIT", "PERFORM", "97bc491961244aa222b08722f464976e", None)])
def route_control_flow(spark, d):
    rows = api.resolved_flow(_store(spark)).where("source_file = 'FIXA01C.cbl'")
    return rows.select("from_uuid", "to_uuid", "edge_type", "from_id", "to_id")


@fixture("name VARCHAR, performs INTEGER, rules INTEGER", [("MAIN-PARA", 3, 1)])
def route_paragraph(spark, d):
    rows = api.paragraph(_store(spark), "f63132171c4f3483e52fb9b721650e80")
    return rows.select("name", F.size("performs").alias("performs"), F.size("rules").alias("rules"))


@fixture("uuid VARCHAR, symbol_count BIGINT, paragraphs INTEGER, copybooks VARCHAR", [("8b8e6a5d040b60565cdea08b11f22bd5", 4, 4, "FIXREC")])
def route_program(spark, d):
    return api.program(_store(spark), "fixa01c").select("uuid", "symbol_count", F.size("paragraphs").alias("paragraphs"), _text("copybooks").alias("copybooks"))


@fixture("relation VARCHAR, other VARCHAR", [("calls", "MQPUT"), ("calls", "MQOPEN"), ("transfers", "FIXA01C"), ("copybooks", "FIXNEST"), ("copybooks", "FIXREC"), ("shares_copybook", "FIXA01C.cbl"), ("transactions", "FIXA01C")])
def route_connectivity(spark, d):
    return api.connectivity(_store(spark), "cofix02c")


@fixture("tbl VARCHAR, id VARCHAR", [("nodes", "f63132171c4f3483e52fb9b721650e80")])
def route_retrieve(spark, d):
    return api.retrieve(_store(spark), "f63132171c4f3483e52fb9b721650e80").select(F.col("table").alias("tbl"), "id")


@fixture("name VARCHAR, class VARCHAR, grid_row INTEGER, grid_col INTEGER, band VARCHAR", [("MAIN-PARA", "main", 0, 0, "low"), ("1000-OPEN", "process", 0, 1, "low"), ("2000-READ", "process", 0, 2, "low"), ("9000-CLOSE", "process", 0, 3, "low")])
def route_flow_chart(spark, d):
    return api.flow_chart(_store(spark), "FIXA01C")[0].select("name", "class", "grid_row", "grid_col", "band")


@fixture("kind VARCHAR, n BIGINT, first VARCHAR", [("group", 1, "FIX-REC"), ("numeric", 1, "FIX-ID"), ("decimal", 1, "FIX-AMT"), ("alphanumeric", 1, "WS-FLAG")])
def route_data_formats(spark, d):
    return api.data_formats(_store(spark), "FIXA01C").select("kind", "n", _text(F.transform("first", lambda x: x["name"])).alias("first"))


@fixture("program VARCHAR, name VARCHAR", [("FIXA01C", "IN-FILE")])
def route_file_accesses(spark, d):
    return api.file_accesses(_store(spark), "fixa01c").select(F.col("program_uuid").alias("program"), F.col("file_name").alias("name")).distinct()


@fixture("variable VARCHAR, reads INTEGER, writes INTEGER", [("WS-FLAG", 3, 1), ("INIT", 1, 0), ("IN-FILE", 1, 0), ("OTHER", 0, 1), ("WS-IN", 1, 0)])
def route_def_use(spark, d):
    return api.def_use(_store(spark), "FIXA01C").select("variable", F.size("reads").alias("reads"), F.size("writes").alias("writes"))


@fixture("name VARCHAR, source_file VARCHAR", [("9000-CLOSE", "FIXA01C.cbl")])
def report_unperformed(spark, d):
    s = _store(spark)
    return reports.unperformed({**s, "control_flow": s["control_flow"].where("to_uuid <> '9000-CLOSE'")}).select("name", "source_file")


@fixture("chart VARCHAR, n BIGINT", [("call_graph", 6), ("transaction_flow", 2), ("jcl_chain", 3), ("file_io", 4)])
def report_mermaid(spark, d):
    return reduce(DataFrame.unionByName, (x.agg(F.count("*").alias("n")).select(F.lit(k).alias("chart"), "n") for k, x in reports.mermaid_charts(_store(spark)).items()))


@fixture("program VARCHAR, fields BIGINT, methods BIGINT, rules BIGINT, seam VARCHAR", [("FIXA01C", 4, 4, 2, "Intake"), ("COFIX02C", 5, 2, 0, "Screens")])
def ir_summary(spark, d):
    return ir.summary(_store(spark), spark.createDataFrame(fx.CONTEXTS, "ord int, context string, member string"))


@fixture("name VARCHAR, java_name VARCHAR, java_type VARCHAR", [("FIX-REC", "fixRec", "Object"), ("FIX-ID", "fixId", "long"), ("FIX-AMT", "fixAmt", "BigDecimal"), ("WS-FLAG", "wsFlag", "String")])
def ir_fields(spark, d):
    return ir.fields(_store(spark)).where("program = 'FIXA01C'").select("name", "java_name", "java_type")


@fixture("name VARCHAR, calls VARCHAR, cics VARCHAR, is_entry BOOLEAN", [("MAIN-PARA", "methodCall,whileLoop,conditionalMethodCall", "", True), ("1000-OPEN", "methodCall", "", False), ("2000-READ", "", "", False), ("9000-CLOSE", "", 'return CicsResponse.returnTo("FX01", commArea)', False)])
def ir_methods(spark, d):
    rows = ir.methods(_store(spark), extract.cics(_programs(spark))).where("program = 'FIXA01C'")
    return rows.select("name", _text(F.transform("calls", lambda c: c["call"])).alias("calls"), _text(F.transform("cics", lambda c: c["java"])).alias("cics"), "is_entry")


@fixture("name VARCHAR, case_ VARCHAR, value VARCHAR", [("FIX-ID", "zero", "0"), ("FIX-ID", "max", "99999999999"), ("FIX-ID", "one", "1"), ("FIX-AMT", "zero", "0.00"), ("FIX-AMT", "max", "999999999.99"), ("FIX-AMT", "min_positive", "0.01"), ("FIX-AMT", "mid", "499999999.50"), ("WS-FLAG", "empty", ""), ("WS-FLAG", "max_length", "A"), ("WS-FLAG", "half_length", ""), ("WS-FLAG", "all_spaces", " ")])
def test_seeds(spark, d):
    rows = ir.field_seeds(ir.fields(_store(spark)).where("program = 'FIXA01C'"))
    return rows.select("name", F.col("case").alias("case_"), "value")


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return producer_consumer_deps(spark, d)

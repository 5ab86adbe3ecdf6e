"""Registered queries over tables whose keys lie beyond any bound: every row counts."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from lodestrata import bindings


def put(spark, d, name, rows, columns):
    spark.createDataFrame(rows, columns).write.parquet(f"{d}/{name}.parquet")


def test_clones_of_all_customers(spark, tmp_path):
    rnd = random.Random(6)
    sets = {g: {(rnd.choice("OFP"), rnd.choice("1234")) for _ in range(rnd.randint(1, 9))} for g in [*range(20), *range(190, 230), *range(5000, 5040)]}
    put(spark, tmp_path, "orders", [(g, *x) for g, s in sets.items() for x in s], "o_custkey long, o_orderstatus string, o_orderpriority string")
    rows = bindings.QUERIES["clone_jaccard"](spark, str(tmp_path)).collect()
    of = {r.b: r.a for r in rows if r.kind == "member"}
    groups = {}
    for g in sets:
        groups.setdefault(of.get(g, g), []).append(g)
    got = {(a, b): (len(sets[a]), 1.0) for s in groups.values() for a in s for b in s if a < b}
    for r in rows:
        if r.kind == "pair":
            got |= {(min(a, b), max(a, b)): (r.shared, r.similarity) for a in groups[r.a] for b in groups[r.b]}
    want = {}
    for a in sets:
        for b in sets:
            both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if a < b and both / either >= 0.6:
                want[a, b] = (both, round(both / either, 3))
    assert got == want and any(a >= 200 for a, _ in want)
    assert len([r for r in rows if r.kind == "pair"]) == len({(r.a, r.b) for r in rows if r.kind == "pair"}) and len(of) == len([r for r in rows if r.kind == "member"])


def test_clones_among_all_subsets_of_few_elements(spark, tmp_path):
    # 8,191 classes that nearly all share an element: each pair is found once, at the first element that both have
    elements, sets = [(s, p) for s in "OFP" for p in "12345"][:13], np.arange(1, 8192)
    put(spark, tmp_path, "orders", [(int(g), *x) for g in sets for k, x in enumerate(elements) if g >> k & 1], "o_custkey long, o_orderstatus string, o_orderpriority string")
    began = time.perf_counter()
    got = bindings.QUERIES["clone_jaccard"](spark, str(tmp_path)).groupBy("kind").agg(F.count("*").alias("n"), F.sum("shared").alias("shared"), F.count_distinct("a", "b").alias("pairs")).collect()
    took = time.perf_counter() - began
    both = [(np.bitwise_count(sets[:g] & g).astype(int), np.bitwise_count(sets[:g] | g)) for g in sets]
    alike = [shared[(shared / either >= 0.6) & (shared < either)] for shared, either in both]
    n = sum(map(len, alike))
    assert [tuple(r) for r in got] == [("pair", n, sum(int(x.sum()) for x in alike), n)]
    assert took < 25, took  # 4 cores; as long as pairs met at every element that they share it took several times as long


def test_dependencies_through_lines_of_any_quantity(spark, tmp_path):
    rnd = random.Random(7)
    lines = [(rnd.randrange(8), rnd.randrange(30), rnd.choice("NRA"), float(rnd.randint(1, 50))) for _ in range(300)]
    put(spark, tmp_path, "lineitem", lines, "l_suppkey long, l_partkey long, l_returnflag string, l_quantity double")
    got = [tuple(r) for r in bindings.QUERIES["producer_consumer_deps"](spark, str(tmp_path)).collect()]
    want = {(p, c, x, "N", "R") for p, x, f, _ in lines if f == "N" for c, y, g, _ in lines if g == "R" and x == y and p != c}
    assert sorted(got) == sorted(want)


def test_the_first_table_wins_for_large_keys(spark, tmp_path):
    names = {"customer": ("c", [1, 299, 301, 900]), "supplier": ("s", [1, 2, 301, 700]), "part": ("p", [2, 3, 700, 900, 10**9])}
    keys = {"customer": "custkey", "supplier": "suppkey", "part": "partkey"}
    for name, (p, ids) in names.items():
        put(spark, tmp_path, name, [(k, f"{name} {k}") for k in ids], f"{p}_{keys[name]} long, {p}_name string")
    got = sorted(tuple(r) for r in bindings.QUERIES["priority_union"](spark, str(tmp_path)).collect())
    want: dict = {}
    for name, (_, ids) in names.items():
        for k in ids:
            want.setdefault(k, (name, k, f"{name} {k}"))
    assert got == sorted(want.values())


def test_origins_over_all_parts(spark, tmp_path):
    parts = [(3, 17), (39, 20), (40, 31), (77, 45), (1234, 5), (99999, 50)]
    put(spark, tmp_path, "part", parts, "p_partkey long, p_size int")
    edges: dict = {}
    for key, size in parts:
        if (source := (size * 7 + key) % 11) != size:
            edges.setdefault(size, set()).add(source)

    def trace(v, depth=0):
        return {v} if depth > 5 or v not in edges else set().union(*(trace(x, depth + 1) for x in edges[v]))

    got = sorted(tuple(r) for r in bindings.QUERIES["lineage_origins"](spark, str(tmp_path)).collect())
    assert got == sorted((root, x) for root in edges for x in trace(root)) and {31, 45, 50} <= set(edges)


def test_reach_keeps_large_node_ids(spark, tmp_path):
    put(spark, tmp_path, "lineitem", [(1, 2), (1, 450), (450, 999), (999, 7), (7, 8), (2, 201), (3, 4)], "l_suppkey long, l_partkey long")
    got = {r.node: r.hops for r in bindings.QUERIES["k_hop_reach"](spark, str(tmp_path)).collect()}
    assert got == {1: 0, 2: 1, 450: 1, 999: 2, 201: 2, 7: 3}

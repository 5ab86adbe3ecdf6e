"""Edges and what they reach: lineage of moves, job dependencies, transaction flow, neighbours, clones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.windows import by, first_wins
from lodestrata.sources.lines import stem

#: Dispositions of producers and consumers; names of paragraphs where a program begins.
PRODUCES, CONSUMES = ("NEW", "MOD"), ("SHR", "OLD")


def lineage(moves: DataFrame) -> DataFrame:
    """Edges (target, source, line, paragraph, source_file) of moves between different variables."""
    rows = moves.where("NOT is_literal").select("source", F.explode("targets").alias("target"), "line", "paragraph", "source_file")
    return rows.where(F.col("source") != F.col("target"))


def origins(edges: DataFrame, roots: DataFrame, target: str = "target", source: str = "source", depth: int = 5) -> DataFrame:
    """(root, origin): where the values of each root come from: variables with no source, or those reached beyond `depth` steps.

    Unrolled joins, with duplicates removed at each step, so a step's size is bounded by roots times variables.
    """
    steps = edges.select(F.col(target).alias("at"), F.col(source).alias("next")).distinct()
    now = roots.select(F.col(roots.columns[0]).alias("root"), F.col(roots.columns[0]).alias("at")).distinct()
    done = []
    for _ in range(depth + 1):
        done.append(now.join(steps.select("at").distinct(), "at", "left_anti").select("root", F.col("at").alias("origin")))
        now = now.join(steps, "at").select("root", F.col("next").alias("at")).distinct()
    done.append(now.select("root", F.col("at").alias("origin")))
    return reduce(DataFrame.unionByName, done).distinct()


def output_origins(moves: DataFrame, prefixes: tuple[str, ...], most: int = 50, depth: int = 5) -> DataFrame:
    """(root, origin) of output variables: of the first `most` targets, by first appearance, those that begin with a prefix,
    where they come from something other than themselves alone."""
    edges = lineage(moves)
    first = edges.groupBy("target").agg(F.min(F.struct("source_file", "line", "target")).alias("at")).orderBy("at").limit(most)
    roots = first.where(reduce(lambda a, b: a | b, (F.col("target").startswith(p) for p in prefixes))).select("target")
    found = origins(edges, roots, depth=depth)
    other = found.groupBy("root").agg(F.count_if(F.col("origin") != F.col("root")).alias("n")).where("n > 0").select("root")
    return found.join(other, "root", "left_semi")


def reach(edges: DataFrame, seeds: DataFrame, source: str, target: str, hops: int) -> DataFrame:
    """(node, hops): nodes that the seeds reach within `hops` steps, each at its least distance."""
    steps = edges.select(F.col(source).alias("node"), F.col(target).alias("next")).distinct()
    seen = seeds.select(F.col(seeds.columns[0]).alias("node")).distinct().withColumn("hops", F.lit(0))
    front = seen
    for k in range(1, hops + 1):
        front = front.join(steps, "node").select(F.col("next").alias("node")).distinct().join(seen, "node", "left_anti").withColumn("hops", F.lit(k))
        seen = seen.unionByName(front)
    return seen


def dependencies(rows: DataFrame, job: str, dataset: Column | str, disp: str, produces: tuple = PRODUCES, consumes: tuple = CONSUMES, order: str | None = None) -> DataFrame:
    """Producer and consumer jobs of the same dataset: producer_job, consumer_job, dataset_name, producer_disp, consumer_disp.

    The first of each pair and dataset; each side is reduced to one row for a job and dataset before they meet.
    """
    name = F.col(dataset) if isinstance(dataset, str) else dataset
    base = rows.select(F.col(job).alias("job"), name.alias("dataset_name"), F.col(disp).alias("disp"), (F.col(order) if order else F.lit(0)).alias("o"))
    side = lambda kinds, p: base.where(F.col("disp").isin(*kinds)).groupBy("job", "dataset_name").agg(F.min_by("disp", F.struct("o", "disp")).alias("disp")).select("dataset_name", F.col("job").alias(f"{p}_job"), F.col("disp").alias(f"{p}_disp"))
    met = side(produces, "producer").join(side(consumes, "consumer"), "dataset_name").where("producer_job <> consumer_job")
    return met.select("producer_job", "consumer_job", "dataset_name", "producer_disp", "consumer_disp")


def base_dataset(name: Column | str) -> Column:
    """A dataset's name without generation or member."""
    return F.get(F.split(F.col(name) if isinstance(name, str) else name, r"\("), F.lit(0))


def transaction_flow(calls: DataFrame, cics: DataFrame, transactions: DataFrame) -> DataFrame:
    """XCTLs and RETURNs with the transactions of both ends: the last catalogue entry of a program names its transaction."""
    ids = first_wins(transactions.where("program <> '' AND name <> ''").select(F.upper("program").alias("p"), F.upper("name").alias("tid"), "source_file", "ordinal"), ["p"], [F.desc("source_file"), F.desc("ordinal")]).select("p", "tid")
    moves = calls.where("call_type = 'CICS_XCTL'").select(F.col("caller").alias("from_program"), F.col("callee").alias("to_program"), F.lit("XCTL").alias("edge_type"), F.lit(None).cast("string").alias("given"), "paragraph", "line", "source_file")
    ends = cics.where("verb = 'RETURN'").select(F.upper(stem("source_file")).alias("from_program"), F.lit("").alias("to_program"), F.lit("RETURN").alias("edge_type"), F.coalesce(F.try_element_at("params", F.lit("TRANSID")), F.lit("")).alias("given"), "paragraph", "line", "source_file")
    rows = moves.unionByName(ends)
    rows = rows.join(ids.select(F.col("p").alias("from_program"), F.col("tid").alias("f")), "from_program", "left").join(ids.select(F.col("p").alias("to_program"), F.col("tid").alias("t")), "to_program", "left")
    none = F.lit("")
    return rows.select("from_program", "to_program", "edge_type", F.coalesce("f", none).alias("from_transid"), F.coalesce("given", "t", none).alias("to_transid"), F.lit(None).cast("int").alias("commarea_size"), "paragraph", "line", "source_file")


#: Classes of a block, which meets another in one task where they share an element; parts in which elements are numbered;
#: tasks in which classes meet, at least; most frequent elements, which are bits of one number.
BLOCK, PARTS, TASKS, BITS = 1024, 1024, 64, 63


def jaccard_classes(rows: DataFrame, group: str, element: list[str], threshold: float, digits: int = 3) -> tuple[DataFrame, DataFrame]:
    """(a, b, shared, similarity) of classes whose sets of distinct elements are alike, a < b; (rep, g, size) of every group.

    Groups with equal sets are one class, named by its least group. A set is a mask `m` of the most frequent elements and the
    sorted numbers `s` of the others, which come first in the common order, rare ones before frequent ones. Classes meet only
    at an element that both have among their first ones: the smaller set, of n elements, up to n - ceil(2t / (1 + t) * n) + 1,
    the larger up to n - ceil(t * n) + 1, and count only at the first that they share, so each pair is found once. Classes of
    a common element are dealt out as blocks, each meets each. Where they meet, sizes, `m` and a hashed mask `h` of `s` rule
    out most pairs.
    """
    items = rows.select(F.col(group).alias("g"), F.struct(*element).alias("e")).where("g IS NOT NULL").distinct()
    counts = items.groupBy("e").agg(F.count("*").alias("n"))
    frequent = counts.orderBy(F.desc("n"), "e").limit(BITS).agg(F.array_sort(F.collect_list(F.struct("n", "e"))).alias("l"))
    bits = F.broadcast(frequent.select(F.posexplode("l").alias("bit", "l")).select(F.col("l.e").alias("e"), "bit"))
    rare = counts.join(bits, "e", "left_anti").withColumn("part", F.pmod(F.xxhash64("e"), F.lit(PARTS)))
    numbered = rare.select("e", (F.row_number().over(by("part", ["n", "e"])) * PARTS + F.col("part")).alias("x"))
    masks = items.join(bits, "e").select("g", F.expr("shiftleft(1L, bit)").alias("m"), F.lit(None).cast("long").alias("x"))
    others = items.join(bits, "e", "left_anti").join(numbered, "e").select("g", F.lit(0).cast("long").alias("m"), "x")
    sets = masks.unionByName(others).groupBy("g").agg(F.bit_or("m").alias("m"), F.array_sort(F.collect_list("x")).alias("s"))
    reps = sets.groupBy("m", "s").agg(F.min("g").alias("rep"))
    members = sets.join(reps, ["m", "s"]).select("rep", "g", (F.bit_count("m") + F.size("s")).cast("long").alias("size"))

    ordered = F.expr(f"concat(s, filter(sequence(0L, {BITS - 1}L), i -> (shiftright(m, cast(i AS int)) & 1L) = 1L))")
    hashed = F.expr("aggregate(s, 0L, (h, x) -> h | shiftleft(1L, cast(pmod(xxhash64(x), 64) AS int)))")
    whole = reps.select("rep", "m", "s", hashed.alias("h"), ordered.alias("o")).withColumn("k", F.size("o"))
    heads = lambda least: whole.select("rep", "k", "m", "h", "s", F.explode(F.slice("o", F.lit(1), F.col("k") - F.ceil(least * F.col("k") - 1e-9).cast("int") + 1)).alias("x"))
    small, large = heads(2 * threshold / (1 + threshold)), heads(threshold)
    blocks = F.broadcast(large.groupBy("x").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).where("blocks > 1"))
    tasks = max(TASKS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n = F.coalesce("blocks", F.lit(1).cast("long"))
    own = F.pmod(F.xxhash64("rep"), n)
    met_by = lambda cell: F.explode(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), cell))
    side = lambda heads, p, block: heads.join(blocks, "x", "left").select("x", block.alias("block"), *(F.col(c).alias(c + p) for c in ("rep", *"kmhs"))).repartition(tasks, "x", "block")
    met = side(large, "b", met_by(lambda i: i * n + own)).join(side(small, "a", met_by(lambda i: own * n + i)), ["x", "block"])
    most = F.expr("bit_count(ma & mb) + least(size(sa) - bit_count(ha & ~hb), size(sb) - bit_count(hb & ~ha))")
    met = met.where("(ka < kb OR (ka = kb AND repa < repb))").where(F.col("kb") * threshold <= F.col("ka") + 1e-9)
    met = met.where(f"x >= {BITS} OR (ma & mb & (shiftleft(1L, cast(least(x, {BITS - 1}L) AS int)) - 1L)) = 0L")
    met = met.where(most * (1 + threshold) >= threshold * (F.col("ka") + F.col("kb")) - 1e-9)
    both = met.withColumn("i", F.expr("if(size(sa) = 0 OR size(sb) = 0, array(), array_intersect(sa, sb))"))
    both = both.where(f"if(size(i) = 0, x < {BITS}, x = array_min(i))").withColumn("shared", F.expr("bit_count(ma & mb) + size(i)"))
    both = both.withColumn("raw", F.col("shared") / (F.col("ka") + F.col("kb") - F.col("shared"))).where(F.col("raw") >= threshold)
    return both.select(F.least("repa", "repb").alias("a"), F.greatest("repa", "repb").alias("b"), F.col("shared").cast("long").alias("shared"), F.round("raw", digits).alias("similarity")), members


def jaccard_pairs(rows: DataFrame, group: str, element: list[str], threshold: float, digits: int = 3) -> DataFrame:
    """(a, b, shared, similarity) of groups whose sets of distinct elements are alike, a < b: every pair, so its size is that of the answer."""
    pairs, members = jaccard_classes(rows, group, element, threshold, digits)
    of = lambda p: members.select(F.col("rep").alias(p), F.col("g").alias(f"g_{p}"))
    apart = pairs.join(of("a"), "a").join(of("b"), "b").select(F.least("g_a", "g_b").alias("a"), F.greatest("g_a", "g_b").alias("b"), "shared", "similarity")
    one = members.select("rep", F.col("g").alias("a")).join(members.select("rep", F.col("g").alias("b"), "size"), "rep").where("a < b")
    return apart.unionByName(one.select("a", "b", F.col("size").alias("shared"), F.lit(1.0).alias("similarity")))


def degrees(edges: DataFrame, source: str, target: str) -> DataFrame:
    """(node, n_out, n_in) of every node of the edges."""
    out = edges.select(F.col(source).alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i"))
    into = edges.select(F.col(target).alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"))
    return out.unionByName(into).groupBy("node").agg(F.sum("o").alias("n_out"), F.sum("i").alias("n_in"))


def merge_graphs(nodes: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes unique by id and links unique by their ends, the first by `ord` of each."""
    return first_wins(nodes, ["id"], ["ord"]), first_wins(links, ["source", "target"], ["ord"])


def never_targeted(names: DataFrame, name: str, edges: DataFrame, target: str, entry: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose upper-cased name no edge targets and that are no entry."""
    targets = edges.select(F.upper(target).alias("_t")).distinct()
    return names.where(~F.upper(name).isin(*entry) if entry else F.lit(True)).join(targets, F.upper(names[name]) == targets["_t"], "left_anti")


def double_resolve(edges: DataFrame, left: str, right: str, names: DataFrame, name: str, extra: list[str], take: str) -> DataFrame:
    """`edges` with the ids of both ends, by upper-cased name and the columns `extra`, where there are any: two left joins."""
    key = lambda p: names.select(F.upper(name).alias(f"_{p}"), *(F.upper(F.col(c)).alias(f"_{p}_{c}") for c in extra), F.col(take).alias(f"{p}_{take}"))
    out = edges
    for p, c in (("from", left), ("to", right)):
        k = key(p)
        on = reduce(lambda a, b: a & b, [F.upper(out[c]) == k[f"_{p}"], *(F.upper(out[x]) == k[f"_{p}_{x}"] for x in extra)])
        out = out.join(k, on, "left").drop(f"_{p}", *(f"_{p}_{x}" for x in extra))
    return out

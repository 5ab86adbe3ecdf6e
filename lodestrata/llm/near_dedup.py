"""Near-duplicate detection by SuperMinHash, banding, verification and union-find.

1. Each text becomes its set of distinct five-word shingles (64-bit hashes) and a SuperMinHash
   signature: each shingle ranks the registers by a permutation drawn step by step, and register
   p keeps the least (step, random) that reaches it; a document stops at the first step that can
   no longer lower any register, so long texts need one or two.
2. Equal sets collapse into a class; all that follows moves one row for each class.
3. Signatures are cut into bands. Each member of a bucket meets the bucket's most central member
   (the one whose bands meet most others); of these each class keeps the one most like it by its
   signature, and full sets confirm the link. A central member's texts are dealt out in parts.
4. Links are grouped by distributed union-find (alternating large-star and small-star).
5. Only pairs of one bucket that still lie in different groups are left. Their signatures are
   compared within the bucket, each pair in the first band it shares; what may reach the threshold
   is confirmed by full sets in the same way, and only links leave a task, never pairs. A large
   bucket is dealt into blocks, those of a large group apart: blocks of one group never meet, so a
   group of n near copies beside m others costs about n tests and n * m / BLOCK rows. A bucket of n
   that are all unlike by a little (no links, yet near the threshold) costs n * n / BLOCK rows.

Joins that move long rows (texts, signatures) move them once, and only those of documents that have a likely partner.
A pair at the threshold shares none of the bands with probability (1 - 0.85 ** 6) ** 42 = 2e-9 (at 0.80 3e-6), and its
signatures fall below the estimate that is tested in full with 5e-7.

Defined results: a null or empty text has an empty set and is linked with nothing; with fewer
words than a shingle, the whole sequence is the one shingle; rows with a null id take part in no
link and have a null component; rows that repeat an id are one document, linked by any of its
texts; an empty table gives an empty result; columns beside id and text are ignored. A task holds
about BLOCK documents of two blocks or SHINGLES shingles of each, or one text that is longer.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.common import Scratch, bound_batches, dealt, giving_back, in_parts, text_or_empty

#: Words in a shingle; links need 100 * intersection >= percent * union, PERCENT unless given; bands and registers in each.
WORDS, PERCENT, BANDS, ROWS = 5, 85, 42, 6
REGISTERS = BANDS * ROWS
#: Members of a bucket, and shingles of all of them, that one task compares with as many others; steps after which permutations are held in full.
BLOCK, SHINGLES, DENSE = 1024, 2_000_000, 6
#: Members that meet a central member in one part.
PART = 512
_CACHE = 100_000
_MASK = np.uint64(0xFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _words() -> dict[bytes, int]:
    import xxhash

    class Hashes(dict):
        def __missing__(self, word: bytes) -> int:
            if len(self) > _CACHE:
                self.clear()
            self[word] = out = xxhash.xxh64_intdigest(word, 7)
            return out

    return Hashes()


def shingles(text: str) -> np.ndarray:
    """Sorted hashes of the distinct shingles; bytes.lower and bytes.split know only ASCII letters and white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_words().__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    n = len(words) - width + 1
    acc = np.full(n, len(words) if len(words) < WORDS else WORDS, np.uint64)
    for k in range(width):
        acc = _mix(acc ^ w[k : k + n])
    return np.unique(acc)


def signatures(sets: list[np.ndarray], m: int = REGISTERS) -> np.ndarray:
    """SuperMinHash registers (step << 32 | random) of each set, a row each; an empty set's stay at the largest value."""
    h = np.concatenate([*sets, np.zeros(0, np.uint64)])
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    out = np.full(len(sets) * m, np.iinfo(np.int64).max)
    drawn: list[np.ndarray] = []
    held: np.ndarray | None = None
    for step in range(m):
        if step:
            live = out.reshape(-1, m).max(1) >= step << 32
            on = live[doc]
            if not on.all():
                h, doc = h[on], doc[on]
                drawn = [r[on] for r in drawn]
                held = held[on] if held is not None else None
        if not len(h):
            break
        x = _mix(h ^ np.uint64((step + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
        r = step + ((x >> np.uint64(32)) % np.uint64(m - step)).astype(np.int64)
        if step < DENSE:  # where position r comes from, back through the earlier swaps
            place = r.copy()
            for t in range(step - 1, -1, -1):
                place[place == drawn[t]] = t
            drawn.append(r)
        else:
            rows = np.arange(len(h))
            if held is None:
                held = np.tile(np.arange(m, dtype=np.int16), (len(h), 1))
                for t, past in enumerate(drawn):
                    held[rows, past], held[rows, t] = held[rows, t].copy(), held[rows, past].copy()
                drawn = []
            place = held[rows, r].astype(np.int64)
            held[rows, r] = held[rows, step]
            held[rows, step] = place
        np.minimum.at(out, doc * m + place, (step << 32) | (x & _MASK).astype(np.int64))
    return out.reshape(-1, m)


def band_keys(signature: np.ndarray) -> np.ndarray:
    parts = signature.astype(np.uint64).reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(signature), BANDS))
    for k in range(ROWS):
        key = _mix(key ^ _mix(parts[:, :, k]))
    return key.astype(np.int64)


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, set_key, bands, sig) of every whole text; set_key is a 128-bit digest of the set, sig has 16 bits of each register."""
    bound_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64())), ("sig", pa.binary())])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for part in in_parts(batch, 1, 250):
                sets = [shingles(x) for x in part.column(1).to_pylist()]
                registers = signatures(sets)
                short = (_mix(registers.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)
                keys = band_keys(short)  # of the short registers, so that sig alone tells which bands two texts share
                offsets = np.arange(0, (len(sets) + 1) * BANDS, BANDS, dtype=np.int32)
                bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), bands, pa.array([x.tobytes() for x in short], pa.binary())], schema=schema
                )

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return chosen.mapInArrow(giving_back(rows), "doc_id long, n_shingles long, set_key binary, bands array<long>, sig binary")


def likely_from(percent: int) -> float:
    """Estimated similarity from which a pair is tested in full: five standard deviations below the threshold."""
    p = percent / 100
    return round(p - 5 * (p * (1 - p) / REGISTERS) ** 0.5, 2)


def _linked(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    if 100 * min(len(s), len(t)) < percent * max(len(s), len(t)):
        return False
    both = len(np.intersect1d(s, t, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(s) + len(t) - both)


def verify(pairs: DataFrame, texts: DataFrame, scratch: Scratch, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold; `texts` is (doc_id, text). The texts of all a meet that of
    their b in parts of about PART, streamed behind it: each text of an a moves once."""
    parts = pairs.groupBy("b").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    own = pairs.join(parts.hint("merge"), "b").select(F.col("a").alias("doc_id"), F.col("b").alias("centre"), F.pmod(F.xxhash64("a"), "parts").cast("int").alias("part"), F.lit(1).alias("role"))
    centres = parts.select(F.col("b").alias("doc_id"), F.col("b").alias("centre"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"))
    assigned = scratch.table(own.unionByName(centres), "assigned")
    placed = dealt(texts, assigned, "doc_id", "inner").select("doc_id", "centre", "part", "role", "text")
    ordered = placed.repartition("centre", "part").sortWithinPartitions("centre", "part", "role")

    def test(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sets = None, []
        for batch in batches:
            found: list[tuple[int, int]] = []
            ids, centre, part, role = (batch.column(k).to_pylist() for k in range(4))
            for a, b, p, r, text in zip(ids, centre, part, role, batch.column(4), strict=True):
                if (b, p) != now:
                    now, sets = (b, p), []
                if r == 0:
                    sets.append(shingles(text.as_py()))
                else:
                    mine = shingles(text.as_py())
                    if any(_linked(mine, x, percent) for x in sets):
                        found.append((a, b))
            yield _as_links(found)

    return ordered.mapInArrow(giving_back(test), "a long, b long")


def _as_links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, label): the least node that each node of the edges (a, b) reaches. Large-star and small-star until nothing moves.

    Each step aggregates by node with partial sums before the shuffle and joins the small result back.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    now = scratch.table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    last = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        now = scratch.table(small.where("u <> v").distinct(), "links")
        state = now.agg(F.count("*"), F.sum(F.col("u").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == last or not state[0]:
            break
        last = state
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), written: the least id that each document reaches over links of near duplicates."""
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    sketches = scratch.table(sketch(docs, id_col, text_col), "sketches")
    linkable = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # members of a class have equal sets and so equal bands
    classes = scratch.table(linkable.groupBy("set_key").agg(F.min("doc_id").alias("cid"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")), "classes")
    members = classes.select("cid", F.posexplode("bands").alias("band", "key"))
    shared = scratch.table(members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    members = scratch.table(members.join(shared.hint("merge"), "key").select("key", "band", "cid", "size"), "members")
    whole = sketches.select("doc_id", "n_shingles", "set_key").join(classes.select("set_key", "cid").hint("merge"), "set_key", "left")
    if members.isEmpty():
        whole = whole.withColumn("label", F.col("cid"))
    else:
        labels = _grouped(members, classes, texts, percent, scratch)
        whole = whole.join(labels.withColumnRenamed("node", "cid").hint("merge"), "cid", "left")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("label", "cid")).otherwise(F.col("doc_id"))
    out = whole.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))
    out = scratch.table(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), "linked")
    scratch.drop(out)
    return out


def _likely(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Share of equal registers of short signatures: an estimate of the similarity."""
    return (x == y).mean(axis=-1)


def _likeliest(pairs: DataFrame, classes: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Of the pairs (a, b) whose sizes and signatures allow a link, the one of each a whose signatures agree most."""
    ids = scratch.table(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), "ids")
    facts = scratch.table(dealt(classes.select("cid", "n", "sig"), ids, "cid", "left_semi"), "facts")
    side = lambda name: facts.select(F.col("cid").alias(name), F.col("n").alias(f"n_{name}"), F.col("sig").alias(f"sig_{name}")).hint("merge")
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b", "sig_a", "sig_b")
    likely = likely_from(percent)

    def test(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in (2, 3))
            share = _likely(x, y)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(share)], names=["a", "b", "share"]).filter(pa.array(share >= likely, pa.bool_()))

    near = both.mapInArrow(giving_back(test), "a long, b long, share double")
    return near.groupBy("a").agg(F.max_by("b", F.struct(F.col("share"), -F.col("b"))).alias("b"))


def _candidates(sig: np.ndarray, n: np.ndarray, label: np.ndarray, block: np.ndarray, band: int, p: int, q: int, percent: int) -> Iterator[tuple[int, int]]:
    """Places of pairs of one bucket that may be linked: in different groups, alike enough, of blocks p and q, and
    with no earlier band in common (that band's bucket tests them)."""
    rows, cols, likely = np.flatnonzero(block == p), np.flatnonzero(block == q), likely_from(percent)
    for i in rows:
        js = cols[cols > i] if p == q else cols
        js = js[(label[js] != label[i]) & (100 * np.minimum(n[js], n[i]) >= percent * np.maximum(n[js], n[i]))]
        for at in range(0, len(js), 4096):
            part = js[at : at + 4096]
            equal = sig[part] == sig[i]
            close = equal.mean(1) >= likely
            part, equal = part[close], equal[close]
            if len(part):
                first = equal.reshape(len(part), BANDS, ROWS).all(2).argmax(1)
                yield from ((int(i), int(j)) for j in part[first == band])


def _of_group(t: pa.Table) -> tuple:
    sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint16).reshape(-1, REGISTERS)
    get = lambda c: t.column(c).to_numpy()
    return sig, get("n"), get("label"), get("block"), int(t.column("band")[0].as_py()), int(t.column("p")[0].as_py()), int(t.column("q")[0].as_py())


_OPEN = "key long, band int, p int, q int, block int, cid long, n long, label long, sig binary"


def _flag(t: pa.Table, percent: int) -> pa.Table:
    """The members of a bucket's pair of blocks that have a partner to be tested."""
    t = t.sort_by("cid")
    found = sorted({x for pair in _candidates(*_of_group(t), percent) for x in pair})
    return t.take(pa.array(found, pa.int64()))


def _confirm(t: pa.Table, percent: int) -> pa.Table:
    """Links of a bucket's pair of blocks, by full sets; a pair that earlier links of the task connect is not tested."""
    t = t.sort_by("cid")
    ids, label = t.column("cid").to_pylist(), t.column("label").to_pylist()
    sets = [shingles(x) for x in t.column("text").to_pylist()]
    parent: dict[int, int] = {x: x for x in label}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out: list[tuple[int, int]] = []
    for i, j in _candidates(*_of_group(t), percent):
        x, y = root(label[i]), root(label[j])
        if x != y and _linked(sets[i], sets[j], percent):
            parent[max(x, y)] = min(x, y)
            out.append((ids[i], ids[j]))
    return pa.Table.from_batches([_as_links(out)])


def _grouped(members: DataFrame, classes: DataFrame, texts: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(node, label) of the classes that have links; members is (key, band, cid, size) of buckets with several members."""
    degrees = members.groupBy("cid").agg(F.sum("size").alias("degree"))
    ranked = scratch.table(members.join(degrees.hint("merge"), "cid").select("key", "band", "cid", "degree"), "members")
    centres = ranked.groupBy("key").agg(F.max_by("cid", F.struct(F.col("degree"), -F.col("cid"))).alias("b"))
    pairs = scratch.table(ranked.select("key", F.col("cid").alias("a")).join(centres.hint("merge"), "key").where("a <> b").select("a", "b").distinct(), "pairs")
    likely = scratch.table(_likeliest(pairs, classes, percent, scratch), "likely")
    links = scratch.table(verify(likely, texts, scratch, percent), "found")
    labels = scratch.table(components(links, scratch), "labels")
    # only buckets that hold several groups have pairs left
    own = labels.withColumnRenamed("node", "cid").hint("merge")
    grouped = scratch.table(ranked.join(own, "cid", "left").select("key", "band", "cid", F.coalesce("label", "cid").alias("label")), "grouped")
    mixed = grouped.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    rest = scratch.table(grouped.join(mixed.hint("merge"), "key", "left_semi"), "rest")
    ids = scratch.table(rest.select("cid").distinct(), "ids")
    facts = dealt(classes.select("cid", "n", "sig"), ids, "cid", "left_semi")
    flagged = scratch.table(_in_blocks(rest.join(facts.hint("merge"), "cid")).groupBy("key", "p", "q").applyInArrow(lambda t: _flag(t, percent), _OPEN), "flagged")
    ids = scratch.table(flagged.select("cid").distinct(), "ids")
    whole = dealt(texts.withColumnRenamed("doc_id", "cid"), ids, "cid", "left_semi")
    more = scratch.table(flagged.join(whole.hint("merge"), "cid").groupBy("key", "p", "q").applyInArrow(lambda t: _confirm(t, percent), "a long, b long"), "found")
    return labels if more.isEmpty() else scratch.table(components(links.unionByName(more), scratch), "labels")


def _in_blocks(rest: DataFrame) -> DataFrame:
    """`rest` (key, band, cid, label, n, sig) once for each pair of blocks (p, q) that its block is one of. A group (label)
    larger than a block has blocks of its own, which meet all but one another; the other groups of a bucket share blocks."""
    units = F.ceil(F.greatest(F.col("rows") / BLOCK, F.col("size") / SHINGLES)).cast("int")
    by_label = rest.groupBy("key", "label").agg(F.count("*").alias("rows"), F.sum("n").alias("size")).withColumn("units", units)
    upto = Window.partitionBy("key").orderBy("label")
    large = by_label.where("units > 1").select("key", "label", "units", (F.sum("units").over(upto) - F.col("units")).cast("int").alias("first"))
    pooled = F.struct(F.sum(F.when(F.col("units") == 1, F.col("rows"))).alias("rows"), F.sum(F.when(F.col("units") == 1, F.col("size"))).alias("size"))
    plan = by_label.groupBy("key").agg(pooled.alias("pool"), F.sum(F.when(F.col("units") > 1, F.col("units"))).alias("own")).select("key", "pool.*", F.coalesce("own", F.lit(0)).cast("int").alias("own"))
    plan = plan.select("key", F.coalesce(units, F.lit(0)).alias("pool"), "own")
    placed = rest.join(plan.hint("merge"), "key").join(large.hint("merge"), ["key", "label"], "left").withColumn("first", F.col("pool") + F.col("first"))
    code = F.xxhash64("cid")
    placed = placed.withColumn("block", F.when(F.col("units").isNotNull(), F.col("first") + F.pmod(code, "units")).otherwise(F.pmod(code, "pool")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("pool") + F.col("own") - 1), lambda x: F.col("units").isNull() | (x < F.col("first")) | (x >= F.col("first") + F.col("units")))
    dealt_out = placed.select("key", "band", "cid", "n", "label", "sig", "block", F.explode(others).alias("other"))
    return dealt_out.select("key", "band", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "cid", "n", "label", "sig")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """`docs` without the near duplicates: of each component the document with the least id stays; of rows that repeat an
    id, the one with the least text."""
    found = link(docs, id_col, text_col, percent)
    again = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    gone = Scratch(docs.sparkSession).table(found.where("NOT kept").select(F.col("doc_id").alias("_nd_id")).distinct(), "gone")
    rest = dealt(docs.withColumn("_nd_id", F.col(id_col).cast("long")), gone, "_nd_id", "left_anti").select(*docs.columns)
    if again.isEmpty():
        return rest
    plain = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]  # a map has no hash
    first = Window.partitionBy(id_col).orderBy(text_col, F.xxhash64(*plain))
    once = rest.where(F.col(id_col).isNotNull()).withColumn("_nd_place", F.row_number().over(first)).where("_nd_place = 1").drop("_nd_place")
    return once.unionByName(rest.where(F.col(id_col).isNull()))

"""Exact top-k search by distributed histogram selection.

Candidates and queries are packed into blocks of vectors; a task meets one candidate block
with one query block and scores all of it by a blocked product. No score is kept: the first
passes only histogram them. A query's k-th highest score is known as an interval that holds
it; a pass cuts the interval into `BINS` bins, adds up the blocks' histograms, and goes on in
the bin that holds the k-th score, until the interval is one integer. A block reports only the
bins down to its own k-th score (none below can hold the k-th of all), so a pass sends at most
k bins for each query and block. The last pass sends what lies above the k-th score and, of the
scores equal to it, the smallest ids that are still needed; a window over at most k rows for each
query and block ranks them.

The query side is broadcast in parts of at most about `BROADCAST_BYTES`, measured, so candidates
stay where they are at any size.

Defined results: vectors that are null or hold a null, NaN or infinite component take no part;
vectors of different lengths never meet; a query with fewer than k candidates gets them all; a query
row never meets itself but meets other rows that repeat its id, and a query row that repeats is
answered each time; scores are exact up to 55 bits and stay at that bound beyond (floor(scale * x)
itself stays within 64 bits); null ids take no part; an empty table gives an empty result. All vectors
of a block are held at once; a vector of any length is held whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.common import bound_batches, table

#: Vectors in a block of candidates and of queries; bins of one pass; bytes of the query side that are broadcast at once.
BLOCK, QUERY_BLOCK, BINS, BROADCAST_BYTES = 2048, 1024, 256, 16 << 20
#: Lower than any score; the largest score that is told apart.
ALL, MOST = -(2**61), 2**55 - 1


def quantize(vectors: DataFrame, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, q, row): floor(scale * x) of each component as a double, and a number for each row; only vectors whose components
    are all finite. Written, so that the numbers stay."""
    x = F.col(vector_col)
    fit = F.col(id_col).isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = vectors.where(F.coalesce(fit, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double"))).alias("q"), F.monotonically_increasing_id().alias("row")
    )
    return table(whole, "vectors")


def _blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Blocks (dim, ids, data, l1, top) of up to `size` vectors of one length, as they lie in a partition; ids and row numbers
    in turn; l1, top: the largest sum of absolute values and component."""
    schema = pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("data", pa.binary()), ("l1", pa.float64()), ("top", pa.float64())])

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(dim: int, rows: list) -> pa.RecordBatch:
            ids = np.array([r[:2] for r in rows], np.int64)
            data = np.array([r[2] for r in rows], np.int64).reshape(len(rows), dim)
            size = np.abs(data.astype(np.float64))
            row = {"dim": dim, "ids": ids.tobytes(), "data": data.tobytes(), "l1": float(size.sum(1).max(initial=0)), "top": float(size.max(initial=0))}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for key, row, q in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                rows = held.setdefault(len(q), [])
                rows.append((key, row, q))
                if len(rows) == size:
                    yield block(len(q), held.pop(len(q)))
        for dim, rows in held.items():
            yield block(dim, rows)

    return vectors.select("vec_id", "row", "q").mapInArrow(build, "dim int, ids binary, data binary, l1 double, top double")


def _scores(cand: np.ndarray, query: np.ndarray, bound: float) -> np.ndarray:
    """Exact integer products, queries by candidates; by floating point where no partial sum can round, by Python's integers
    where 63 bits may not do. What lies beyond MOST stays there."""
    if bound < 2.0**52:
        return (query.astype(np.float64) @ cand.astype(np.float64).T).astype(np.int64)
    if bound < 2.0**62:
        return np.clip(query @ cand.T, -MOST, MOST)
    return np.clip(query.astype(object) @ cand.astype(object).T, -MOST, MOST).astype(np.int64).reshape(len(query), len(cand))


def _meet(candidates: DataFrame, queries: DataFrame, parts: int) -> DataFrame:
    """Every candidate block beside every query block of its length, the queries broadcast in so many parts."""
    side = queries.select("dim", "qb", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.col("l1").alias("q_l1"), "lo", "width", "need")
    own = [side if parts == 1 else side.where(F.pmod(F.xxhash64("qb"), F.lit(parts)) == k) for k in range(parts)]
    return reduce(DataFrame.unionByName, (candidates.join(F.broadcast(x), "dim") for x in own))


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids, q_ids = np.frombuffer(row["ids"], np.int64).reshape(-1, 2), np.frombuffer(row["q_ids"], np.int64).reshape(-1, 2)
    shape = lambda x, n: np.frombuffer(x, np.int64).reshape(n, row["dim"])
    scores = _scores(shape(row["data"], len(ids)), shape(row["q_data"], len(q_ids)), row["q_l1"] * row["top"])
    return ids, q_ids, scores, *(np.frombuffer(row[k], np.int64) for k in ("lo", "width", "need"))


def _histogram(rows: DataFrame, k: int) -> DataFrame:
    """(qb, place, bin, n): counts of a block's scores by bin of the interval of the query at a place, down to the block's own k-th."""
    schema = pa.schema([("qb", pa.int64()), ("place", pa.int64()), ("bin", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, q_ids, scores, lo, width, need = _unpack(row)
                out: list[list] = [[], [], []]
                for j, q in enumerate(q_ids):
                    own = scores[j][ids[:, 1] != q[1]]
                    own = own[(own >= lo[j]) & (own - lo[j] < width[j] * BINS)]
                    if len(own) > k:  # below a block's own k-th no bin can hold the k-th of all
                        own = own[own >= np.partition(own, len(own) - k)[len(own) - k]]
                    bins, n = np.unique((own - lo[j]) // width[j], return_counts=True)
                    for column, x in zip(out, ([j] * len(bins), bins, n), strict=True):
                        column.extend(x)
                if out[0]:
                    cols = [np.full(len(out[0]), row["qb"]), *out]
                    yield pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in cols], schema=schema)

    return rows.mapInArrow(count, "qb long, place long, bin long, n long")


def _select(rows: DataFrame) -> DataFrame:
    """What lies above each query's k-th score, and of the scores equal to it the smallest ids that are needed."""
    schema = pa.schema([("qb", pa.int64()), ("place", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, q_ids, scores, lo, _, need = _unpack(row)
                out: list[list] = [[], [], [], []]
                for j, q in enumerate(q_ids):
                    other = ids[:, 1] != q[1]
                    above = np.flatnonzero(other & (scores[j] > lo[j]))
                    ties = np.flatnonzero(other & (scores[j] == lo[j]))
                    if len(ties) > need[j]:
                        ties = ties[np.argsort(ids[ties, 0], kind="stable")[: need[j]]]
                    at = np.concatenate([above, ties])
                    for column, x in zip(out, ([j] * len(at), [q[0]] * len(at), ids[at, 0], scores[j][at]), strict=True):
                        column.extend(x)
                if out[0]:
                    cols = [np.full(len(out[0]), row["qb"]), *out]
                    yield pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in cols], schema=schema)

    return rows.mapInArrow(pick, "qb long, place long, query_id long, vec_id long, score long")


def _narrowed(queries: DataFrame, histogram: DataFrame) -> DataFrame:
    """The query blocks with each interval narrowed to the bin that holds the k-th score."""
    total = histogram.groupBy("qb", "place", "bin").agg(F.sum("n").alias("n"))
    found = total.groupBy("qb").applyInArrow(_per_block, "qb long, f_places binary, f_bins binary, f_ns binary")
    joined = queries.join(found, "qb", "left")
    schema = pa.schema([("qb", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("data", pa.binary()), ("l1", pa.float64()), ("top", pa.float64()), ("lo", pa.binary()), ("width", pa.binary()), ("need", pa.binary())])

    def move(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64).reshape(-1, 2)
                lo, width, need = (np.frombuffer(row[k], np.int64).copy() for k in ("lo", "width", "need"))
                f = [np.frombuffer(row[k] or b"", np.int64) for k in ("f_places", "f_bins", "f_ns")]
                places = np.arange(len(ids))
                edges = np.searchsorted(f[0], places), np.searchsorted(f[0], places, "right")
                for j, (a, b) in enumerate(zip(*edges, strict=True)):
                    bins, ns = f[1][a:b][::-1], np.cumsum(f[2][a:b][::-1])  # from the top
                    at = int(np.searchsorted(ns, need[j]))
                    if at < len(bins):
                        need[j] -= ns[at - 1] if at else 0
                        lo[j] += bins[at] * width[j]
                    else:  # fewer than k in all: they are above this
                        lo[j], need[j] = ALL, 0
                    width[j] = max(1, width[j] // BINS)
                yield pa.RecordBatch.from_pylist([{k: row[k] for k in ("qb", "dim", "ids", "data", "l1", "top")} | {"lo": lo.tobytes(), "width": width.tobytes(), "need": need.tobytes()}], schema=schema)

    return joined.mapInArrow(move, "qb long, dim int, ids binary, data binary, l1 double, top double, lo binary, width binary, need binary")


def _per_block(t: pa.Table) -> pa.Table:
    order = np.lexsort((t.column("bin").to_numpy(), t.column("place").to_numpy()))
    cols = {f"f_{n}s": [t.column(c).to_numpy()[order].astype(np.int64).tobytes()] for n, c in (("place", "place"), ("bin", "bin"), ("n", "n"))}
    schema = pa.schema([("qb", pa.int64()), ("f_places", pa.binary()), ("f_bins", pa.binary()), ("f_ns", pa.binary())])
    return pa.Table.from_pydict({"qb": [t.column("qb")[0].as_py()], **cols}, schema=schema)


def search(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products with the other rows of `vectors`, ties to the
    smaller id. Both are (vec_id, q, row); a query is a row of `vectors` and meets all but the row of its number."""
    bound_batches(vectors.sparkSession)
    candidates = table(_blocks(vectors, BLOCK), "blocks")
    packed = table(_blocks(queries, QUERY_BLOCK), "queries").withColumn("qb", F.monotonically_increasing_id())
    facts = packed.agg(F.sum(F.length("data") + 2 * F.length("ids")).alias("bytes"), F.max("l1").alias("l1")).first()
    top = candidates.agg(F.max("top")).first()[0]
    reach = int((facts["l1"] or 0) * (top or 0))
    width = 1
    while width * BINS < 2 * reach + 1:
        width *= BINS
    if width * BINS >= 2**62:
        width, reach = BINS**6, 2**55  # scores of up to 56 bits are told apart; larger ones do not fit an exact score
    schema = pa.schema([("qb", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("data", pa.binary()), ("l1", pa.float64()), ("top", pa.float64()), ("lo", pa.binary()), ("width", pa.binary()), ("need", pa.binary())])

    def begin(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["ids"]) // 16
                state = {"lo": -reach, "width": width, "need": k}
                yield pa.RecordBatch.from_pylist([row | {c: np.full(n, x, np.int64).tobytes() for c, x in state.items()}], schema=schema)

    state = packed.select("qb", "dim", "ids", "data", "l1", "top").mapInArrow(begin, "qb long, dim int, ids binary, data binary, l1 double, top double, lo binary, width binary, need binary")
    parts = max(1, -(-(facts["bytes"] or 0) // BROADCAST_BYTES))
    state = table(state, "queries")
    while True:
        state = table(_narrowed(state, _histogram(_meet(candidates, state, parts), k)), "queries")
        if width == 1:
            break
        width //= BINS
    found = _select(_meet(candidates, state, parts))
    order = Window.partitionBy("qb", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

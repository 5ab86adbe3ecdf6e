"""Best-fit packing of token pieces into sequences of a fixed capacity.

Hierarchical residual packing: every partition best-fits its own pieces (longest
first) and closes the bins that are nearly full; the underfull bins then climb a
tree of nodes as items of their own and are best-fitted again at every level.
Neither texts nor ids climb: a node sees how many underfull bins its children have
of each fill, at most `capacity` numbers for each child, and best-fits them by
count, so its work is bounded at any size and no bin is left behind.

Defined results: a null or empty text is one piece holding only the end id; rows
that repeat are packed once for each row; a null id is carried along; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.common import Scratch, bound_batches, dealt, giving_back, in_parts, single_threaded, text_or_empty

CAPACITY = 2048
#: A bin with at most this much room is closed where it stands.
SLACK = 16
#: Pieces that are best-fitted together in a partition; nodes under one parent.
CHUNK, FAN = 200_000, 8
#: Pieces handed on together; bytes of texts that are encoded together, which takes some 25 times as many.
PIECE_ROWS, PART_BYTES = 1024, 1 << 20
#: Distinct words whose ids a worker keeps.
WORDS = 400_000
_BIN_BITS = 32

PIECES = "doc_id long, piece int, start long, length long, ids binary"


class WordEncoder:
    """Ids of whole texts, by a tokenizer that never joins text across white space, each distinct word encoded once.

    Words are split and numbered in Arrow, so Python sees only distinct parts of a batch's words, and the ids of a
    batch are gathered from one array. A word of plain letters with plain punctuation after it is two parts; the new
    letter parts of a batch are encoded in one call and told apart by the word-end mark. Any other word is one part
    that goes to the tokenizer as it is.
    """

    #: Letters whose lower case and normal form are certain: ASCII and most of the first two Latin blocks.
    PLAIN = r"^(?P<core>[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}]+)(?P<tail>[!-/:-@\[-`{-~]*)$"
    #: str.split and Arrow take these for white space, the tokenizer does not.
    ODD = "[\x1c-\x1f]"

    def __init__(self, path: str, most: int = WORDS, end_id: int = 0) -> None:
        single_threaded()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.most, self.end_id = most, end_id
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, k in vocabulary.items():
            self.ends[k] = token.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        """Part 0 is empty, part 1 is the end of a text."""
        self.parts: dict[str, int] = {"": 0}
        self.ids, self.starts, self.lengths = np.array([self.end_id], np.uint32), np.zeros(2, np.int64), np.array([0, 1])

    def _append(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])

    def _whole(self, texts: list[str]) -> None:
        """Append the ids of each text as a part of its own."""
        found = [self.tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
        self._append(np.array([k for ids in found for k in ids], np.uint32), np.array([len(x) for x in found], np.int64))

    def _number(self, seen: pa.Array, joined: bool) -> np.ndarray:
        """The numbers of the parts, which are learned where new; `joined`: plain letters, which can be encoded in one call."""
        seen = seen.to_pylist()
        if new := [x for x in seen if x not in self.parts]:
            at = len(self.starts)
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids if joined else [], np.int64)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(new):
                self._append(ids, np.diff(cuts, prepend=0))
            else:
                self._whole(new)
            self.parts.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(self.parts.__getitem__, seen), np.int64, len(seen))

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (none null), one after the other, each with the end id behind it; how many each has."""
        if len(self.parts) > self.most:
            self.forget()
        odd = pc.match_substring_regex(texts, self.ODD)
        extra = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        split = pc.utf8_split_whitespace(pc.if_else(odd, "", texts) if len(extra) else texts)
        words = pc.dictionary_encode(split.flatten())
        match = pc.extract_regex(words.dictionary, self.PLAIN)
        plain = pc.is_valid(match)
        at = np.flatnonzero(plain.to_numpy(zero_copy_only=False))
        first, second = np.zeros((2, len(words.dictionary)), np.int64)
        match = match.filter(plain)
        for out, name in ((first, "core"), (second, "tail")):
            part = pc.struct_field(match, name)
            part = pc.dictionary_encode(pc.utf8_lower(part) if name == "core" else part)
            out[at] = self._number(part.dictionary, name == "core")[part.indices.to_numpy()]
        first[~plain.to_numpy(zero_copy_only=False)] = self._number(words.dictionary.filter(pc.invert(plain)), False)
        word = words.indices.to_numpy()
        edges = split.offsets.to_numpy().astype(np.int64)
        edges = 2 * (edges - edges[0])
        number = np.empty(2 * len(word), np.int64)
        number[::2], number[1::2] = first[word], second[word]
        known = len(self.starts)
        if len(extra):  # such a text is one part, known for this batch only
            self._whole([texts[int(k)].as_py() for k in extra])
            number[edges[extra]] = known + np.arange(len(extra))
        number = np.insert(number, edges[1:], 1)
        lengths = self.lengths[number]
        upto = np.cumsum(lengths)
        total = int(upto[-1]) if len(upto) else 0
        ids = self.ids[np.repeat(self.starts[number] - upto + lengths, lengths) + np.arange(total)]
        if len(extra):
            self.ids, self.starts, self.lengths = self.ids[: self.starts[known]], self.starts[:known], self.lengths[:known]
        return ids, np.diff(upto[edges[1:] + np.arange(len(texts))], prepend=0)


@lru_cache(maxsize=2)
def word_encoder(path: str, end_id: int = 0) -> WordEncoder:
    """One for each worker process."""
    return WordEncoder(path, end_id=end_id)


def tokenize(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids) of every whole text: its ids, then `end_id`, cut only where longer than `capacity`.

    `ids` holds little-endian unsigned 32-bit ids. `tokenizer` is the path of a tokenizers JSON file that every executor has.
    """
    bound_batches(docs.sparkSession)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer, end_id)
        try:
            for batch in (part for whole in batches for part in in_parts(whole, 1, 4096, PART_BYTES)):
                ids, counts = encoder.encode_batch(batch.column(1))
                pieces = -(-counts // capacity)
                of = np.repeat(np.arange(len(counts)), pieces)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(counts[of] - start, capacity)
                place = np.r_[0, np.cumsum(length)]
                for at in range(0, len(of), PIECE_ROWS):
                    to = min(at + PIECE_ROWS, len(of))
                    edges = (4 * (place[at : to + 1] - place[at])).astype(np.int32)
                    data = pa.BinaryArray.from_buffers(pa.binary(), to - at, [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(ids[place[at] : place[to]]))])
                    columns = [batch.column(0).take(pa.array(of[at:to])), pa.array(piece[at:to], pa.int32()), pa.array(start[at:to], pa.int64()), pa.array(length[at:to], pa.int64()), data]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids"])
        finally:
            encoder.forget()  # the worker goes on to other work; the next task meets other words anyway

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(giving_back(cut), PIECES)


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each size, and the bins' fills: longest first, each into the fullest bin that has room."""
    order = sorted(range(len(sizes)), key=lambda k: -sizes[k])
    of, offset, fill = [0] * len(sizes), [0] * len(sizes), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: a bin with room r stands open
    for k in order:
        size = sizes[k]
        if fits := rooms >> size:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        of[k], offset[k] = b, fill[b]
        fill[b] += size
        by_room[room - size].append(b)
        rooms |= 1 << (room - size)
    return of, offset, fill


def pack_locally(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`items` (a long column `length` from 1 to capacity) with _pk_bin, _pk_offset and _pk_fill; each task numbers bins of its own."""

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << _BIN_BITS
        held: list[pa.RecordBatch] = []

        def out(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal first
            t = pa.Table.from_batches(held)
            of, offset, fill = best_fit(t.column("length").to_pylist(), capacity)
            new = {"_pk_bin": [first + b for b in of], "_pk_offset": offset, "_pk_fill": [fill[b] for b in of]}
            first += len(fill)
            for name, x in new.items():
                t = t.append_column(name, pa.array(x, pa.int64()))
            yield from t.to_batches(max_chunksize=20_000)

        rows = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= CHUNK:
                yield from out(held)
                held, rows = [], 0
        if held:
            yield from out(held)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return items.mapInArrow(place, f"{kinds}, _pk_bin long, _pk_offset long, _pk_fill long")


class _Bins:
    """Bins with the same pattern: `count` bins of one fill; bin j holds of each run (size, first, each, base) the items
    of that size from the rank first + j * each on, `each` of them, the first at the offset base."""

    __slots__ = ("count", "fill", "runs")

    def __init__(self, count: int, fill: int, runs: list[tuple[int, int, int, int]]) -> None:
        self.count, self.fill, self.runs = count, fill, runs

    def split(self, count: int) -> _Bins:
        """Take off the first `count` bins."""
        front = _Bins(count, self.fill, list(self.runs))
        self.runs = [(size, first + count * each, each, base) for size, first, each, base in self.runs]
        self.count -= count
        return front


def best_fit_counts(sizes: dict[int, int], capacity: int) -> list[_Bins]:
    """What best_fit makes of so many items of each size, without listing the items: work and result grow with the number
    of distinct sizes. Items of a size are told apart by rank, from 0."""
    by_room: dict[int, list[_Bins]] = {}
    rooms = 0  # bit r: bins with room r stand open

    def put(b: _Bins) -> None:
        nonlocal rooms
        by_room.setdefault(capacity - b.fill, []).append(b)
        rooms |= 1 << (capacity - b.fill)

    for size in sorted(sizes, reverse=True):
        rank, left = 0, sizes[size]
        while left:
            if fits := rooms >> size:
                room = size + (fits & -fits).bit_length() - 1
                held = by_room[room].pop()
                if not by_room[room]:
                    rooms &= ~(1 << room)
            else:
                room, held = capacity, _Bins(left, 0, [])
            each = room // size
            whole = min(held.count, left // each)
            if whole:
                front = held.split(whole)
                front.runs.append((size, rank, each, front.fill))
                front.fill += each * size
                rank, left = rank + whole * each, left - whole * each
                put(front)
            if held.count and 0 < left < each:  # the last few items share a bin that keeps room
                front = held.split(1)
                front.runs.append((size, rank, left, front.fill))
                front.fill += left * size
                rank, left = rank + left, 0
                put(front)
            if held.count and held.fill:
                put(held)
    return [b for open_ in by_room.values() for b in open_]


_MOVES = "node long, fill long, lo long, hi long, first long, each long, base long, up long, to_fill long, to_rank long, number long, live boolean"


def _merge(capacity: int):
    """One node of the tree: counts of its children's underfull bins by fill become moves of ranges of them into new bins.

    Bins (node, fill, rank) with lo <= rank < hi move: the item (rank - first) // each of a range goes into the bin that
    has the rank to_rank + that in its new fill, and the number `number` + that in its node, at base + (rank - first) % each * fill.
    """

    def node(t: pa.Table) -> pa.Table:
        rows = sorted(t.select(["up", "node", "fill", "n"]).to_pylist(), key=lambda r: (r["fill"], r["node"]))
        children: dict[int, list[tuple[int, int, int]]] = {}  # of a fill: child, its ranks from, to
        for r in rows:
            own = children.setdefault(r["fill"], [])
            at = own[-1][2] if own else 0
            own.append((r["node"], at, at + r["n"]))
        made = best_fit_counts({fill: own[-1][2] for fill, own in children.items()}, capacity)
        out, ranks, number = [], {}, 0
        starts = {fill: [c[1] for c in own] for fill, own in children.items()}
        for b in made:
            rank = ranks.get(b.fill, 0)
            ranks[b.fill] = rank + b.count
            for size, first, each, base in b.runs:
                end = first + b.count * each
                own = children[size]
                for child, at, to in own[bisect_right(starts[size], first) - 1 :]:
                    if at >= end:
                        break
                    lo, hi = max(first, at), min(end, to)
                    out.append((child, size, lo - at, hi - at, first - at, each, base, rows[0]["up"], b.fill, rank, number, b.fill < capacity - SLACK))
            number += b.count
        return pa.Table.from_pylist([dict(zip(_MOVE_NAMES, x, strict=True)) for x in out], schema=_MOVE_SCHEMA)

    return node


_MOVE_NAMES = [x.split()[0] for x in _MOVES.split(", ")]
_MOVE_SCHEMA = pa.schema([(x, pa.bool_() if x == "live" else pa.int64()) for x in _MOVE_NAMES])


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`items` with sequence_id and offset: each sequence holds at most `capacity`, gapless from 0.

    `items` is written, packed where it lies and written again; then underfull bins are merged up the tree. A node of the tree sees
    no bins but how many there are of each fill, `capacity` numbers for each child at most, so none has to be left behind.
    """
    scratch = Scratch(items.sparkSession)
    # written first: where the items come from Python too, a task has one Python worker at a time and not two
    items = scratch.table(items, "items")
    local = scratch.table(pack_locally(items, capacity), "packed")
    mine = {c: f"_pk_{c}" for c in ("bin", "fill", "offset")}
    bins = local.where(F.col(mine["fill"]) < capacity - SLACK).groupBy(F.col(mine["bin"]).alias("bin")).agg(F.max(mine["fill"]).alias("fill"))
    bins = bins.withColumn("node", F.shiftright("bin", _BIN_BITS))
    rank = F.row_number().over(Window.partitionBy("node", "fill").orderBy("bin")) - 1
    live = scratch.table(bins.select("bin", "node", "fill", rank.cast("long").alias("rank"), F.lit(0).cast("long").alias("base")), "bins")
    nodes, level = (live.agg(F.max("node")).first()[0] or 0) + 1, 0
    closed: list[DataFrame] = []
    while True:
        nodes, level = -(-nodes // FAN), level + 1
        counts = live.groupBy("node", "fill").agg((F.max("rank") + 1).alias("n")).withColumn("up", F.expr(f"node div {FAN}"))
        moves = scratch.table(counts.groupBy("up").applyInArrow(_merge(capacity), _MOVES), "moves")
        met = dealt(live.withColumnRenamed("base", "own_base"), moves, ["node", "fill"], "inner").where("rank >= lo AND rank < hi")
        at, place = F.expr("(rank - first) % each"), F.expr("(rank - first) div each")
        merged = met.select(
            "bin", F.col("up").alias("node"), F.col("to_fill").alias("fill"), (F.col("to_rank") + place).alias("rank"),
            (F.col("own_base") + F.col("base") + at * F.col("fill")).alias("base"), (F.col("number") + place).alias("number"), "live",
        )
        merged = scratch.table(merged, "bins")
        done = merged if nodes == 1 else merged.where("NOT live")
        closed.append(done.select(F.col("bin").alias("_pk_id"), (F.lit(level << 58) + F.shiftleft("node", _BIN_BITS) + F.col("number")).alias("_pk_sequence"), F.col("base").alias("_pk_base")))
        if nodes == 1:
            break
        live = merged.where("live").drop("number", "live")
    moved = closed[0]
    for x in closed[1:]:
        moved = moved.unionByName(x)
    joined = local.join(moved, local[mine["bin"]] == moved["_pk_id"], "left")
    keep = [local[c] for c in items.columns if c not in ("sequence_id", "offset")]
    return joined.select(*keep, F.coalesce("_pk_sequence", mine["bin"]).alias("sequence_id"), (F.col(mine["offset"]) + F.coalesce("_pk_base", F.lit(0))).alias("offset"))


def assemble(packed: DataFrame) -> DataFrame:
    """Token ids of every sequence, in order of offset: at most `capacity` ids are gathered for one."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(whole.alias("ids"), F.sum("length").alias("length"))

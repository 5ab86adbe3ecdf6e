"""Document fingerprints by invertible Bloom lookup sketches.

A text's paragraphs (lines, and sentences within them) are hashed; its sketch has CELLS cells,
and each paragraph's digest is added to one cell of each of three subtables: a count, the
exclusive or of the digests, the exclusive or of their checks. Subtracting two sketches leaves
only the digests that differ, and peeling recovers them: a cell that holds one digest gives it
up, which empties its other cells by one, and so on. Where peeling stalls, the digests are dealt
by three of their bits to eight times as many cells and peeled again, and so on to LEVELS.

All of it is DataFrame expressions. Pairing each document with the next takes one shuffle of the
texts, by ranges of ids: the row with the largest id of each range also goes to the range above,
so no row needs to look beyond its own.

Defined results: a null text is empty: no paragraphs, likeness 1 to another empty text; null ids
stand last, and rows that repeat an id follow one another in order of text; the only row of a
table is its own next; an empty table gives an empty result; columns beside id and text are
ignored. A text is hashed whole, however long: a row holds three texts and some 50 bytes for each of their paragraphs.
Rows that repeat one id lie in one range, sorted with spilling.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.common import text_or_empty

#: Cells of a sketch, in three subtables of eight; rounds of peeling; times that a stalled peeling is dealt out anew.
CELLS, ROUNDS, LEVELS = 24, 10, 5
#: A difference of more digests than this is not worth peeling at this size.
MOST = 18
#: Rows in a range of ids, and ranges at most.
RANGE_ROWS, RANGES = 500, 1 << 16

_CELL = "struct<n:int,key:bigint,check:int>"
_FOUND = "array<struct<sign:int,key:bigint>>"


def _let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x), with x evaluated once."""
    return F.transform(F.array(x), f)[0]


def entries(text: Column) -> Column:
    """The distinct digests of a text's paragraphs, each with its check and the bits of its three cells."""
    parts = F.filter(F.split(text, r"\n+|(?<=[.!?]) +"), lambda p: p != "")

    return F.transform(F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p))), lambda key: F.struct(key.alias("key"), F.hash(key).alias("check"), _cells_of(key).alias("cells")))


def _cells_of(key: Column) -> Column:
    """The bits of a digest's three cells."""
    bit = lambda k: F.call_function("shiftleft", F.lit(1), (F.shiftright(key, 3 * k).bitwiseAND(F.lit(7).cast("long")) + 8 * k).cast("int"))
    return bit(0).bitwiseOR(bit(1)).bitwiseOR(bit(2))


def _bits() -> Column:
    return F.array(*(F.lit(1 << k) for k in range(CELLS)))


def sketch(of: Column) -> Column:
    """The cells of `entries`."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("key"), F.lit(0).alias("check"))

    def cell(bit: Column) -> Column:
        def add(c: Column, e: Column) -> Column:
            grown = F.struct((c["n"] + 1).alias("n"), c["key"].bitwiseXOR(e["key"]).alias("key"), c["check"].bitwiseXOR(e["check"]).alias("check"))
            return F.when(e["cells"].bitwiseAND(bit) != 0, grown).otherwise(c)

        return F.aggregate(of, zero, add)

    return F.transform(_bits(), cell)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["key"].bitwiseXOR(y["key"]).alias("key"), x["check"].bitwiseXOR(y["check"]).alias("check")))


def peel(cells: Column) -> Column:
    """(cells, found, on): what is left of the cells, and the digests that were recovered with the sign of their side."""
    start = F.struct(cells.alias("cells"), F.array().cast(_FOUND).alias("found"), F.lit(True).alias("on"))

    def turn(state: Column, _: Column) -> Column:
        pure = F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["check"] == F.hash(c["key"])))
        fresh = F.array_distinct(F.transform(pure, lambda c: F.struct(c["n"].alias("sign"), c["key"].alias("key"), c["check"].alias("check"), _cells_of(c["key"]).alias("cells"))))

        def take(fresh: Column) -> Column:
            def empty(c: Column, bit: Column) -> Column:
                less = lambda c, f: F.struct((c["n"] - f["sign"]).alias("n"), c["key"].bitwiseXOR(f["key"]).alias("key"), c["check"].bitwiseXOR(f["check"]).alias("check"))
                return F.aggregate(fresh, c, lambda c, f: F.when(f["cells"].bitwiseAND(bit) != 0, less(c, f)).otherwise(c))

            found = F.concat(state["found"], F.transform(fresh, lambda f: F.struct(f["sign"].alias("sign"), f["key"].alias("key"))))
            return F.struct(F.zip_with(state["cells"], _bits(), empty).alias("cells"), found.alias("found"), F.lit(True).alias("on"))

        still = F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(False).alias("on"))
        return F.when(state["on"], _let(fresh, lambda x: F.when(F.size(x) == 0, still).otherwise(take(x)))).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _clean(cells: Column) -> Column:
    return F.forall(cells, lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0))


def difference(a: Column, b: Column, level: int = 0, cells: tuple[Column, Column] | None = None) -> Column:
    """The digests (sign 1: only in a, -1: only in b) by which two arrays of entries differ."""

    def signed(x: Column, y: Column, sign: int) -> Column:
        return F.transform(F.array_except(x, y), lambda e: F.struct(F.lit(sign).alias("sign"), e["key"].alias("key")))

    if level == LEVELS:  # digests that agree in 24 bits and more
        return F.concat(signed(a, b, 1), signed(b, a, -1))

    def larger(a: Column, b: Column) -> Column:
        def dealt(x: Column, g: Column) -> Column:
            return F.filter(x, lambda e: F.shiftright(e["key"], 9 + 3 * level).bitwiseAND(F.lit(7).cast("long")) == g)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda g: _let(F.struct(dealt(a, g).alias("a"), dealt(b, g).alias("b")), lambda p: difference(p["a"], p["b"], level + 1))))

    def attempt(left: Column) -> Column:
        heavy = F.aggregate(F.slice(left, 1, 8), F.lit(0), lambda s, c: s + F.abs(c["n"])) > MOST
        return F.when(~heavy, _let(peel(left), lambda s: F.when(_clean(s["cells"]), s["found"])))

    own = cells or (sketch(a), sketch(b))
    both = F.coalesce(_let(subtract(*own), attempt), larger(a, b))  # the second is only evaluated where the first failed
    return F.when(a == b, F.array().cast(_FOUND)).otherwise(both)


def likeness(a: Column, b: Column, differing: Column) -> Column:
    """Shared paragraphs by all paragraphs of two texts, from how many each has and how many differ; 1 where neither has any."""
    total = a + b
    return F.when(total == 0, F.lit(1.0)).otherwise((total - differing) / (total + differing))


def fingerprint(cells: Column, of: Column) -> Column:
    """The sketch as text: paragraphs, then each cell's count, digests and checks."""
    each = F.transform(cells, lambda c: F.concat_ws(".", c["n"], F.hex(c["key"]), F.hex(c["check"])))
    return F.concat_ws(":", F.size(of), F.array_join(each, ":"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sketched: bool = False) -> DataFrame:
    """(doc_id, text, next_text): the text of the next row in descending id; after the last comes the first. If `sketched`,
    also own and next_own: the (entries, cells) of both."""
    least = -(2**63)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("sid"))
    n = rows.count()
    ranges = max(1, min(RANGES, n // RANGE_ROWS))
    cuts = rows.agg(F.percentile_approx("sid", [k / ranges for k in range(1, ranges)] or [0.5], max(10_000, 4 * ranges)).alias("q")).first()["q"] or []
    cuts = sorted(set(cuts))
    bounds = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>") if cuts else F.array().cast("array<bigint>")

    def search(acc: Column, step: Column) -> Column:
        at = acc + step
        return F.when((at <= len(cuts)) & (F.get(bounds, at - 1) < F.col("sid")), at).otherwise(acc)

    steps = F.array(*(F.lit(1 << k) for k in reversed(range(max(1, len(cuts).bit_length())))))
    ranged = rows.withColumn("range", F.aggregate(steps, F.lit(0), search))  # how many bounds are less: a binary search
    tops = ranged.groupBy("range").agg(F.max("sid").alias("sid"))  # a row for each range, RANGES at most
    w = Window.orderBy("range")
    up = tops.select("range", "sid", F.coalesce(F.lead("range").over(w), F.first("range").over(w)).alias("up"))
    ghosts = ranged.join(F.broadcast(up), ["range", "sid"]).select("doc_id", "text", "sid", F.col("up").alias("range"), F.lit(1).alias("ghost"))
    both = ranged.select("doc_id", "text", "sid", "range", F.lit(0).alias("ghost")).unionByName(ghosts).repartition("range")
    if sketched:  # where the rows lie now, so that neither moves; each text is hashed once for itself and as a next one
        both = both.withColumn("own", _let(entries(F.col("text")), lambda e: F.struct(e.alias("entries"), sketch(e).alias("cells"))))
    order = Window.partitionBy("range").orderBy("ghost", F.desc("sid"), "text")
    led = [F.lead(x).over(order).alias(f"next_{x}") for x in ("text", "own")[: 1 + sketched]]
    return both.select(*(("doc_id", "text", "own") if sketched else ("doc_id", "text")), "ghost", *led).where("ghost = 0").drop("ghost")


def edited(text: Column, following: Column) -> Column:
    """`text` with its last third replaced by as much, or all, of the beginning of `following`."""
    third = F.floor(F.char_length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - third), F.substring(following, F.lit(1), third))


def compare_versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and its edited version, and the digests by which it differs from that and from the next text."""
    paired = with_next(docs, id_col, text_col, sketched=True).withColumn("edited_text", edited(F.col("text"), F.col("next_text")))
    hashed = paired.withColumn("edited_own", _let(entries(F.col("edited_text")), lambda e: F.struct(e.alias("entries"), sketch(e).alias("cells"))))
    own = {"text": F.col("own"), "edited_text": F.col("edited_own"), "next_text": F.col("next_own")}

    def differing(x: Column) -> Column:
        return difference(own["text"]["entries"], x["entries"], cells=(own["text"]["cells"], x["cells"]))

    return hashed.select(
        "doc_id", *own,
        fingerprint(own["text"]["cells"], own["text"]["entries"]).alias("fingerprint"), fingerprint(own["edited_text"]["cells"], own["edited_text"]["entries"]).alias("edited_fingerprint"),
        *(F.size(x["entries"]).alias(f"{name}_paragraphs") for name, x in own.items()),
        *(differing(own[name]).alias(f"{name}_difference") for name in ("edited_text", "next_text")),
    )

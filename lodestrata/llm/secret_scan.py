"""Secret scans by a trigram inverted index.

From every rule's regex a Boolean query over trigrams is derived: the trigrams that any match must
hold, an AND within a literal, an OR over alternatives. `index` inverts the texts: for each trigram
that some query names, the posting list of the texts that hold it (by a 64-bit key of the text, so
copies are one posting), cut into blocks of about BLOCK texts by key, so no list is unbounded.
`candidates` intersects and unites posting lists block by block as the queries say, and only
candidates are verified with a rule's regex; rules without a mandatory trigram scan every text. Texts
whose keys collide are candidates of either's rules, which verification sets right.

All of it is DataFrame expressions. Texts do not move while the candidates are few enough to be
broadcast (`dealt`); beyond, texts and candidates are dealt by key.

Defined results: a null text is scanned as empty and has no spans; matches are leftmost and do not
overlap within a kind; spans of different kinds may overlap; repeated rows are scanned as rows of
their own; an empty table gives an empty result. A text is scanned whole, however long; its spans are
put together in time that grows with their number. Columns beside the text are carried along, but for
one named as the column of spans, which `scan` replaces; working columns begin with _ss_.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import Scratch, dealt, text_or_empty


class Rule(NamedTuple):
    """Matches of `regex` whose `group` has at least `least` characters."""

    kind: str
    regex: str
    any_case: bool = False
    group: int = 0
    least: int = 0


#: The base rules; their spans always stay. [0-9a-f]+ with 24 characters or more is the same as {24,}, as runs are maximal.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Further well-known shapes of credentials.
ADDED = (
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY[A-Z ]{0,10}-----"),
    Rule("git_token", r"gh[opsur]_[A-Za-z0-9]{36}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment_key", r"[rs]k_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("mail_key", r"SG\.[A-Za-z0-9_-]{22}\.[A-Za-z0-9_-]{43}"),
    Rule("bearer", r"bearer [a-z0-9._~+/-]{20,}=*", True),
    Rule("url_login", r"[a-z]{2,12}://[A-Za-z0-9._-]{1,64}:[A-Za-z0-9._%+-]{3,64}@"),
)
RULES = BASE + ADDED
#: What stands for a redacted span.
PLACEHOLDER = "[secret]"
#: Alternatives that one literal may branch into before the query is cut there.
BRANCHES = 48
#: Texts in a block of the posting lists; matches whose spans are put together at a time.
BLOCK, CHUNK = 4096, 256

Query = tuple  # ("and", queries...), ("or", queries...) or a trigram; ("and",) is always true


def _exact(items: object) -> set[str] | None:
    """All strings that the parsed piece can match, if they are few; else None."""
    out = {""}
    for op, arg in items:
        if op is sre.LITERAL:
            new = {chr(arg)}
        elif op is sre.IN and all(k is sre.LITERAL for k, _ in arg) and len(arg) <= 5:
            new = {chr(x) for _, x in arg}
        elif op is sre.SUBPATTERN:
            new = _exact(arg[3])
        elif op is sre.BRANCH:
            parts = [_exact(x) for x in arg[1]]
            new = None if None in parts else set().union(*parts)
        elif op is sre.MAX_REPEAT and arg[1] <= 3:
            one = _exact(arg[2])
            new = None
            if one is not None:
                new, power = set(), {""}
                for n in range(arg[1] + 1):
                    new |= power if n >= arg[0] else set()
                    power = {a + b for a in power for b in one}
        else:
            new = None
        if new is None or len(out) * len(new) > BRANCHES:
            return None
        out = {a + b for a in out for b in new}
    return out


def _of_strings(strings: set[str]) -> Query:
    if min(map(len, strings)) < 3:
        return ("and",)
    sets = {frozenset(x[k : k + 3] for k in range(len(x) - 2)) for x in strings}
    least = [x for x in sets if not any(y < x for y in sets)]  # what asks for more than another alternative adds nothing
    ands = [("and", *x) for x in sorted(map(sorted, least))]
    return ands[0] if len(ands) == 1 else ("or", *ands)


def _query(items: object) -> Query:
    found: list[Query] = []
    held: list = []  # pieces in a row that match few strings

    def flush() -> None:
        if held:
            found.append(_of_strings(_exact(held)))
            held.clear()

    for item in items:
        op, arg = item
        if _exact([*held, item]) is not None:
            held.append(item)
            continue
        flush()
        if _exact([item]) is not None:
            held.append(item)
        elif op is sre.SUBPATTERN:
            found.append(_query(arg[3]))
        elif op is sre.BRANCH:
            found.append(("or", *(_query(x) for x in arg[1])))
        elif op is sre.MAX_REPEAT and arg[0]:
            found.append(_query(arg[2]))
    flush()
    return ("and", *(x for x in found if x != ("and",)))


def trigram_query(regex: str) -> Query:
    """The Boolean query over lower-case trigrams that every text with a match satisfies."""

    def lower(q: Query | str) -> Query | str:
        return q.lower() if isinstance(q, str) else (q[0], *(lower(x) for x in q[1:]))

    return lower(_query(parser.parse(regex)))


def trigrams_of(q: Query | str) -> set[str]:
    return {q} if isinstance(q, str) else set().union(*map(trigrams_of, q[1:]))


def vocabulary(rules: tuple[Rule, ...] = RULES) -> list[str]:
    return sorted(set().union(*(trigrams_of(trigram_query(r.regex)) for r in rules)))


def _key(text_col: str) -> Column:
    return F.xxhash64(text_or_empty(text_col))


def index(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The inverted index (block, trigram, keys): in each block of texts, those that hold a trigram, sorted."""
    words = vocabulary(rules)
    blocks = max(1, -(-docs.count() // block))
    lowered = docs.select(_key(text_col).alias("key"), F.lower(text_or_empty(text_col)).alias("lower"))
    held = F.array_compact(F.array(*(F.when(F.contains("lower", F.lit(w)), F.lit(w)) for w in words))) if words else F.array().cast("array<string>")
    postings = lowered.select("key", F.explode(held).alias("trigram"))
    return postings.groupBy(F.pmod("key", F.lit(blocks)).alias("block"), "trigram").agg(F.array_sort(F.collect_set("key")).alias("keys"))


def candidates(postings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, rules): for each text that satisfies some rule's query, those rules as bits. Rules without a query are left out:
    every text is their candidate."""
    lists = postings.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("of"))
    none = F.array().cast("array<bigint>")

    def hold(q: Query | str) -> Column:
        if isinstance(q, str):
            return F.coalesce(F.try_element_at("of", F.lit(q)), none)
        parts = [hold(x) for x in q[1:]]
        out = parts[0]
        for x in parts[1:]:
            out = F.array_intersect(out, x) if q[0] == "and" else F.array_union(out, x)
        return out

    asked = [(1 << k, q) for k, q in enumerate(trigram_query(r.regex) for r in rules) if q != ("and",)]

    def marked(keys: Column, bit: int) -> Column:
        return F.transform(keys, lambda key: F.struct(key.alias("key"), F.lit(bit).cast("long").alias("bit")))

    each = [marked(hold(q), bit) for bit, q in asked]
    if not each:
        return lists.select(F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("rules")).where("false")
    found = lists.select(F.explode(F.concat(*each)).alias("c")).select("c.*")
    return found.groupBy("key").agg(F.bit_or("bit").alias("rules"))


_SPANS = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def _verified(rule: Rule, rank: int) -> Column:
    """Spans of the rule's matches in _ss_text: what lies between matches and the matches themselves add up to positions."""
    pattern = ("(?i)" if rule.any_case else "") + rule.regex
    found = F.regexp_extract_all("_ss_text", F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all("_ss_text", F.lit(pattern), F.lit(rule.group)) if rule.group else found
    parts = F.arrays_zip(F.split("_ss_text", pattern, -1).alias("gap"), found.alias("match"), inner.alias("inner"))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.char_length(x["gap"])
        end = begin + F.coalesce(F.char_length(x["match"]), F.lit(0))
        one = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        keep = x["match"].isNotNull() & (F.char_length(x["inner"]) >= rule.least)
        return F.struct(end.cast("long").alias("at"), F.when(keep, F.concat(state["spans"], F.array(one).cast(_SPANS))).otherwise(state["spans"]).alias("spans"))

    # an array that grows by one is copied each time: chunks of matches, each from 0, are moved to their places after
    def chunked(parts: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / CHUNK).cast("int")), lambda c: F.aggregate(F.slice(parts, c * CHUNK + 1, F.lit(CHUNK)), zero, step))
        return F.transform(F.array(chunks), moved)[0]

    def moved(chunks: Column) -> Column:
        first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("starts"))
        starts = F.aggregate(chunks, first, lambda s, c: F.struct((s["at"] + c["at"]).alias("at"), F.concat(s["starts"], F.array(s["at"])).alias("starts")))["starts"]
        shift = lambda x, by: F.struct((x["start"] + by).alias("start"), x["rank"].alias("rank"), (x["end"] + by).alias("end"), x["kind"].alias("kind"))
        return F.flatten(F.zip_with(chunks, starts, lambda c, by: F.transform(c["spans"], lambda x: shift(x, by)))).cast(_SPANS)

    return F.transform(F.array(parts), chunked)[0]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", spans_col: str = "secret_spans") -> DataFrame:
    """`docs` with `spans_col`, an array of (start, rank, end, kind) sorted by start, then the rules' order: code points, end exclusive."""
    none, scratch = F.array().cast(_SPANS), Scratch(docs.sparkSession)
    docs = docs.drop(spans_col)
    found = scratch.table(candidates(index(docs, rules, text_col), rules).withColumnRenamed("key", "_ss_key").withColumnRenamed("rules", "_ss_rules"), "candidates")
    met = dealt(docs.withColumns({"_ss_key": _key(text_col), "_ss_text": text_or_empty(text_col)}), found, "_ss_key", "left")
    whole = sum(1 << k for k, r in enumerate(rules) if trigram_query(r.regex) == ("and",))
    mine = F.coalesce("_ss_rules", F.lit(0).cast("long")).bitwiseOR(F.lit(whole).cast("long"))
    pattern = lambda r: ("(?i)" if r.any_case else "") + r.regex
    each = [F.when((mine.bitwiseAND(F.lit(1 << k).cast("long")) != 0) & F.col("_ss_text").rlike(pattern(r)), _verified(r, k)).otherwise(none) for k, r in enumerate(rules)]
    return met.withColumn(spans_col, F.array_sort(F.concat(*each))).select(*docs.columns, spans_col)


def spans_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """`docs` with every span of a secret replaced by the placeholder; overlapping spans become one. A null text stays null."""
    scanned = scan(docs, rules, text_col, "_ss_spans")
    text = text_or_empty(text_col)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        gap = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(x["start"] - state["at"], F.lit(0)).cast("int"))
        fresh = x["start"] >= state["at"]
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), F.when(fresh, F.concat(state["out"], F.array(gap))).otherwise(state["out"]).alias("out"))

    done = F.aggregate("_ss_spans", start, step, lambda s: F.array_join(F.concat(s["out"], F.array(F.substring(text, (s["at"] + 1).cast("int"), F.char_length(text)))), PLACEHOLDER))
    return scanned.withColumn(text_col, F.when(F.size("_ss_spans") > 0, done).otherwise(F.col(text_col))).select(*docs.columns)

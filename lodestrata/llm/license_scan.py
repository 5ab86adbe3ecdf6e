"""License scans by ordered signature rules.

A text becomes its words (A-Z lower-cased, all other ASCII but a-z and 0-9 parts words),
joined by single spaces. Rules are regexes over that form, in order of priority: hand-written
signatures (passages of licence texts, headers and identifiers, names, notices) and, between names
and notices, the plain forms in which the licences of a table are named. A rule runs only on texts
that hold its keyword. Of detections that overlap, one whose interval lies
within that of a detection with higher priority (or the same priority and more words, or
the earlier rule) is suppressed. Base phrases are detected apart and never suppressed.

The scan is a map over rows: no shuffle, one text in memory at a time beside its batch; a very long
text is scanned whole, its words held at once.

Defined results: a null text is scanned as empty: no words, no labels, null positions,
score 0. Repeated rows are scanned as rows of their own; an empty table gives an empty
result; columns beside id and text are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import bound_batches, text_or_empty
from lodestrata.llm.license_signatures import HEADERS, NAMES, NOTICES, TEXTS

#: The phrases that are always reported, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


class Family(NamedTuple):
    """A licence: its label, its name in words, its short name in words, and its versions in words ('' for none)."""

    label: str
    name: str
    short: str
    versions: tuple[str, ...] = ("",)


_GNU = ("1 0", "2 0", "2 1", "3 0", "1", "2", "3", "")
_CC = ("1 0", "2 0", "2 5", "3 0", "4 0", "")
#: Ordered: where two families match the same words the earlier one wins, so narrower names stand first.
FAMILIES = (
    Family("agpl", r"gnu affero general public licen[cs]e", "agpl", ("3 0", "3", "1 0", "")),
    Family("lgpl", r"gnu (?:lesser|library) general public licen[cs]e", "lgpl", _GNU),
    Family("gpl", r"gnu general public licen[cs]e", "gpl", _GNU),
    Family("gfdl", r"gnu free documentation licen[cs]e", "gfdl", ("1 1", "1 2", "1 3", "")),
    Family("cc-by-nc-nd", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?", "cc by nc nd", _CC),
    Family("cc-by-nc-sa", r"creative commons attribution non ?commercial share ?alike", "cc by nc sa", _CC),
    Family("cc-by-nc", r"creative commons attribution non ?commercial", "cc by nc", _CC),
    Family("cc-by-nd", r"creative commons attribution no ?deriv(?:ative)?s?", "cc by nd", _CC),
    Family("cc-by-sa", r"creative commons attribution share ?alike", "cc by sa", _CC),
    Family("cc-by", r"creative commons attribution", "cc by", _CC),
    Family("cc0", r"creative commons zero", "cc0", ("1 0", "")),
    Family("apache", r"apache (?:software )?licen[cs]e", "apache", ("1 0", "1 1", "2 0", "")),
    Family("bsd-2-clause", r"(?:simplified|free) bsd licen[cs]e", "bsd 2 clause"),
    Family("bsd-3-clause", r"(?:new|modified) bsd licen[cs]e", "bsd 3 clause"),
    Family("bsd-4-clause", r"(?:original|old) bsd licen[cs]e", "bsd 4 clause"),
    Family("0bsd", r"zero clause bsd", "0bsd"),
    Family("bsd", r"bsd licen[cs]e", "bsd"),
    Family("mit-0", r"mit no attribution", "mit 0"),
    Family("mit", r"mit licen[cs]e", "mit"),
    Family("x11", r"x11 licen[cs]e", "x11"),
    Family("isc", r"isc licen[cs]e", "isc"),
    Family("mpl", r"mozilla public licen[cs]e", "mpl", ("1 0", "1 1", "2 0", "")),
    Family("epl", r"eclipse public licen[cs]e", "epl", ("1 0", "2 0", "")),
    Family("edl", r"eclipse distribution licen[cs]e", "edl", ("1 0", "")),
    Family("cddl", r"common development and distribution licen[cs]e", "cddl", ("1 0", "1 1", "")),
    Family("cpl", r"common public licen[cs]e", "cpl", ("1 0", "")),
    Family("eupl", r"european union public licen[cs]e", "eupl", ("1 0", "1 1", "1 2", "")),
    Family("artistic", r"artistic licen[cs]e", "artistic", ("1 0", "2 0", "")),
    Family("boost", r"boost software licen[cs]e", "bsl", ("1 0", "")),
    Family("zlib", r"zlib licen[cs]e", "zlib"),
    Family("unlicense", r"unlicense", "unlicense"),
    Family("wtfpl", r"do what the [a-z]+ you want to public licen[cs]e", "wtfpl", ("1 0", "2 0", "")),
    Family("osl", r"open software licen[cs]e", "osl", ("1 0", "2 0", "2 1", "3 0", "")),
    Family("afl", r"academic free licen[cs]e", "afl", ("1 1", "2 0", "2 1", "3 0", "")),
    Family("ofl", r"(?:sil )?open font licen[cs]e", "ofl", ("1 0", "1 1", "")),
    Family("psf", r"python software foundation licen[cs]e", "psf", ("2 0", "2", "")),
    Family("odbl", r"open database licen[cs]e", "odbl", ("1 0", "")),
    Family("odc-by", r"open data commons attribution licen[cs]e", "odc by", ("1 0", "")),
    Family("pddl", r"public domain dedication and licen[cs]e", "pddl", ("1 0", "")),
    Family("ms-pl", r"microsoft public licen[cs]e", "ms pl"),
    Family("ms-rl", r"microsoft reciprocal licen[cs]e", "ms rl"),
    Family("upl", r"universal permissive licen[cs]e", "upl", ("1 0", "")),
    Family("ncsa", r"university of illinois ncsa open source licen[cs]e", "ncsa"),
    Family("postgresql", r"postgresql licen[cs]e", "postgresql"),
    Family("openssl", r"openssl licen[cs]e", "openssl"),
    Family("qpl", r"q public licen[cs]e", "qpl", ("1 0", "")),
    Family("sspl", r"server side public licen[cs]e", "sspl", ("1 0", "1", "")),
    Family("busl", r"business source licen[cs]e", "busl", ("1 1", "")),
)
#: How a licence is named, most certain first: what stands before, whether the long name may stand there, confidence.
FORMS = (
    ("spdx licen[cs]e identifier ", False, 0.99),
    ("licen[cs]ed under (?:the )?(?:terms of )?(?:the )?", True, 0.95),
    ("(?:released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?", True, 0.9),
    ("licen[cs]e ", False, 0.7),
    ("", True, 0.6),
)


class Rule(NamedTuple):
    label: str
    priority: int
    confidence: float
    keyword: bytes
    regex: re.Pattern[bytes]


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """The ordered signature rules: texts, headers, names, then every family in every form and version, then the notices."""
    out: list[Rule] = []

    def signatures(level: int, confidence: float, rows: tuple[tuple[str, str, str], ...]) -> None:
        for label, keyword, regex in rows:
            # a keyword that names a licence (with c or s) gates by the part before it
            gate = re.split("licen[cs]", keyword)[0].strip() if "license" in keyword else keyword
            out.append(Rule(label, level, confidence, (gate if len(gate) > 3 else "licen").encode(), re.compile(f" {regex}(?= )".encode())))

    for level, (confidence, rows) in enumerate(((0.97, TEXTS), (0.95, HEADERS), (0.8, NAMES))):
        signatures(level, confidence, rows)
    for level, (before, long, confidence) in enumerate(FORMS, 3):
        for f in FAMILIES:
            for version in f.versions:
                for name in dict.fromkeys([f.name, f.short] if long else [f.short]):
                    if name == f.short and not before and not version and " " not in name:
                        continue  # a bare short word is no evidence
                    v = rf"(?: licen[cs]e)?(?: (?:version|v) ?| v?){version}" if version else ""
                    label = f"{f.label}-{version.replace(' ', '.')}" if version else f.label
                    # the longest run of plain characters; names that vary share the gate of their fixed part
                    keyword = max(re.split(r"licen\[cs\]e|\(\?:[^)]*\)\??|\[[^\]]*\]\+?| \?", name), key=len)
                    keyword = f" {name} " if name == f.short else keyword.strip()
                    out.append(Rule(label, level, confidence, keyword.encode(), re.compile(f" {before}{name}{v}(?= )".encode())))
    signatures(3 + len(FORMS), 0.4, NOTICES)
    return tuple(out)


@lru_cache(maxsize=1)
def _gates() -> dict[bytes, list[tuple[int, Rule]]]:
    by: dict[bytes, list[tuple[int, Rule]]] = {}
    for k, r in enumerate(rules()):
        by.setdefault(r.keyword, []).append((k, r))
    return by


_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


class Detection(NamedTuple):
    start: int  # words, end exclusive
    end: int
    label: str
    confidence: float


def detect(spaced: bytes) -> list[Detection]:
    """Detections that no other suppresses, by start; `spaced` is the words with single spaces between and around them."""
    found = []
    for keyword, gated in _gates().items():
        if keyword in spaced:
            found += [(r.priority, m.start() - m.end(), k, m.start(), m.end(), r) for k, r in gated for m in r.regex.finditer(spaced)]
    kept: list[tuple[int, int]] = []
    out = []
    reach: list[int] = []
    for _, _, _, a, b, r in sorted(found, key=lambda x: x[:4]):
        if not _within(kept, reach, a, b):
            _insert(kept, reach, a, b)
            out.append((a, b, r))
    done, n, last = [], 0, 0
    for a, b, r in sorted(out, key=lambda x: (x[0], x[1], x[2].label)):  # words are counted once, from start to start
        n, last = n + spaced.count(b" ", last, a), a
        done.append(Detection(n, n + spaced.count(b" ", a, b), r.label, r.confidence))
    return done


def _within(kept: list[tuple[int, int]], reach: list[int], a: int, b: int) -> bool:
    """Whether [a, b) lies within a kept interval: of those that start at or before a, the one that reaches furthest tells."""
    k = bisect_right(kept, (a, float("inf")))
    return k > 0 and reach[k - 1] >= b


def _insert(kept: list[tuple[int, int]], reach: list[int], a: int, b: int) -> None:
    k = bisect_right(kept, (a, b))
    kept.insert(k, (a, b))
    reach.insert(k, max(b, reach[k - 1] if k else b))
    for j in range(k + 1, len(reach)):
        if reach[j] >= b:
            break
        reach[j] = b


def scan_text(text: str) -> dict:
    words = text.encode("utf-8", "surrogatepass").translate(_WORDS).split()
    spaced = b" " + b" ".join(words) + b" " if words else b" "
    places: list[int] = []
    base = set()
    for phrase, label in BASE.items():
        sought = f" {phrase} ".encode()
        at, counted, n = spaced.find(sought), 0, 0
        while at >= 0:
            n += spaced.count(b" ", counted, at)
            counted = at
            places.append(n)
            base.add(label)
            at = spaced.find(sought, at + 1)
    found = detect(spaced)
    miss = 1.0
    for d in found:
        miss *= 1 - d.confidence
    return {
        "n_words": len(words), "n_base": len(places), "first_word": min(places, default=None), "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | {d.label for d in found})),
        "score": 1.0 if base and miss == 1 else 1 - miss, "detections": [d._asdict() for d in found],
    }


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections) of every whole text.

    `detections` holds (start, end, label, confidence) in words; `score` is how sure it is that a licence is named.
    """
    bound_batches(docs.sparkSession)
    detection = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("confidence", pa.float64())])
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("detections", pa.list_(detection)),
    ])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([{"doc_id": k, **scan_text(x)} for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)], schema=schema)

    ddl = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<start:long,end:long,label:string,confidence:double>>"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(rows, ddl)

"""Chat formatting with a grammar round trip.

Every turn is rendered as `<|im_start|>role NEWLINE text<|im_end|> NEWLINE`. The
rendering is parsed again by a deterministic parser and compared with the source;
a turn that does not come back as it was is escaped and rendered again, and must then
come back identical. Escaping puts a backslash into every `<|`, `<\\|`, `<\\\\|` ...
and the parser takes one away, so texts that hold control strings or look escaped
survive, and no rendered text holds a control string of its own.

Turns stream through a task sorted by conversation and turn: memory holds one turn
and a running digest, so a conversation of any length is rendered whole.

Defined results: a null text or role is empty; a null conv_id is one conversation
of its own; turns with the same number are ordered by role and text, and repeated
rows are kept; a role's newlines and backslashes are escaped; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import bound_batches

START, END = "<|im_start|>", "<|im_end|>"
#: The role whose texts are under the loss mask.
TRAINED = "assistant"
_OPEN, _SHUT = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
#: The grammar of one turn; an escaped body cannot hold the control strings that end it.
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n([^<]*+(?:<(?!\|)[^<]*+)*+)<\|im_end\|>\n")

SEGMENTS = "conv_id long, turn long, place long, start long, role string, rendered string, body_start long, body_end long, trained boolean"


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _SHUT.sub(r"<\1|", text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.DOTALL)


def parse(rendered: str) -> list[tuple[str, str]] | None:
    """Turns (role, text) of a rendering, unescaped; None where it does not follow the grammar."""
    turns, at = [], 0
    while at < len(rendered):
        if not (m := _TURN.match(rendered, at)):
            return None
        turns.append((_role_in(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn and where its body stands in it; escaped only where the round trip needs it."""
    for name, body in ((role, text), (_role_out(role), escape(text))):
        rendered = f"{START}{name}\n{body}{END}\n"
        if parse(rendered) == [(role, text)]:
            at = len(START) + len(name) + 1
            return rendered, at, at + len(body)
    raise ValueError("a turn does not survive the round trip")


def format_turns(turns: DataFrame) -> DataFrame:
    """One row for each turn of (conv_id, turn, role, text): its rendering, its start in the conversation's whole
    rendering, and the span of its body there, which is under the loss mask where `trained`. Joining `rendered` in
    order of `place` gives the formatted conversation.
    """
    bound_batches(turns.sparkSession)

    def render(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, place, start = object(), 0, 0
        for batch in batches:
            conv, turn, role, text = (batch.column(k).to_pylist() for k in range(4))
            rows = []
            for c, t, r, x in zip(conv, turn, role, text, strict=True):
                if c != now:
                    now, place, start = c, 0, 0
                rendered, at, to = render_turn(r, x)
                rows.append((c, t, place, start, r, rendered, start + at, start + to, r == TRAINED))
                place += 1
                start += len(rendered)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_())
            names = [x.split()[0] for x in SEGMENTS.split(", ")]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(render, SEGMENTS)


def read_back(segments: DataFrame) -> DataFrame:
    """What the rendering says of each conversation: its turns parsed again, and all text under the loss mask.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars). `segments` comes as format_turns left it:
    a conversation's rows together and in order.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def done(state: list) -> dict:
            conv, n, turns, chars, loss, size = state
            return {"conv_id": conv, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars, "loss_sha256": loss.hexdigest(), "formatted_chars": size}

        as_arrow = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        for batch in batches:
            get = {name: batch.column(name).to_pylist() for name in ("conv_id", "place", "start", "rendered", "body_start", "body_end", "trained")}
            out = []
            for c, place, start, rendered, a, b, trained in zip(*get.values(), strict=True):
                if place == 0:
                    if state:
                        out.append(done(state))
                    state = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(rendered) or ():
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                if trained:
                    masked = unescape(rendered[a - start : b - start])
                    state[3] += len(masked)
                    state[4].update(masked.encode())
                state[5] += len(rendered)
            yield pa.RecordBatch.from_pylist(out, schema=as_arrow)
        if state:
            yield pa.RecordBatch.from_pylist([done(state)], schema=as_arrow)

    return segments.mapInArrow(digest, schema)

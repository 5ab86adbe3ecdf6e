"""SentencePiece encoding and decoding by suffix-array matching.

A batch's distinct words (a space mark and what follows it, up to the next mark) are cut into parts
between characters that no piece has in a row: nothing is ever joined across such a place. Parts not
yet known are joined to one text and its suffixes sorted by as many characters as the longest piece
has, by doubling: suffixes' ranks by 4 characters give those by 8. Every piece finds the
range of suffixes that begin with it by binary search, all pieces at once; the occurrences are the
edges, sorted by position. Edges are relaxed in the order of the model's merges: as long as two
neighbouring tokens of a word form an edge, the best-scored such edge (the leftmost of equals) joins
them. Characters that no piece covers become byte pieces. No piece of the vocabulary crosses the
beginning of a word (checked when it is read), so words can be encoded apart.

Made for models of merged pairs without normalization, with a mark before the text, as its
configuration says; the results equal the library's.

A word of any length is indexed in windows that end where no piece crosses, so a worker holds the index of WINDOW
characters (some 0.8 KB each) beside the text and its ids. Only a stretch without any such place, as one character that
repeats without end, is indexed as a whole.

Defined results: a null text encodes as empty, to no ids; repeated rows are encoded as rows of their
own; an empty table gives an empty result; columns beside id and text are ignored.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import bound_batches, in_parts, text_or_empty

MARK = "▁"
_SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Words and parts of words whose ids a worker keeps; characters joined to one text to be indexed, and to one to be cut.
KEPT, KEPT_PARTS, JOINED, CUT = 400_000, 300_000, 400_000, 1_600_000
#: Words up to this many characters are relaxed together; longer ones, one by one with a heap, so many characters at a time.
LONG, WINDOW = 64, 100_000
#: Longer words are not kept for the next batch.
KEPT_CHARS = 1000


class SuffixMatcher:
    """The places of every piece of a vocabulary in a text."""

    def __init__(self, pieces: list[str]) -> None:
        self.width = -(-max(map(len, pieces)) // 4) * 4
        letters = sorted(set("".join(pieces)))
        # a 16-bit number for each character: 0 lies between words, the last is any that no piece has
        self.number = np.full(0x110000, len(letters) + 1, np.uint16)
        self.number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.number[0] = 0
        self.lengths = np.array([len(p) for p in pieces])
        codes = np.zeros((len(pieces), self.width), np.uint64)
        for row, p in zip(codes, pieces, strict=True):
            row[: len(p)] = self._codes(p)
        beyond = np.arange(self.width)[None, :] >= self.lengths[:, None]
        self.low, self.high = self._keys(codes), self._keys(np.where(beyond, np.uint64(0xFFFF), codes))
        # whether a piece may have two characters in a row, by a hash of both: a cut that a collision hides does no harm
        self.inner = np.zeros(1 << 20, bool)
        left, right = codes[:, :-1], codes[:, 1:]
        self.inner[self._pair(left, right)[right > 0]] = True

    def _codes(self, text: str) -> np.ndarray:
        return self.number[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]

    @staticmethod
    def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint32) * np.uint32(40_503) + right.astype(np.uint32)) & np.uint32((1 << 20) - 1)

    def parts(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """The parts of all words, which no piece leaves, and how many each word has."""
        text = "".join(words)
        codes = self._codes(text)
        begins = np.r_[True, ~self.inner[self._pair(codes[:-1], codes[1:])]]
        heads = np.cumsum([0, *map(len, words)])
        begins[heads[:-1]] = True
        at = np.flatnonzero(begins)
        bounds = [*at.tolist(), len(text)]
        return [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)], np.diff(np.searchsorted(at, heads))

    @staticmethod
    def _keys(codes: np.ndarray) -> list[np.ndarray]:
        """Four 16-bit characters to a key, the first characters first."""
        return [sum(codes[:, k + j] << np.uint64(48 - 16 * j) for j in range(4)) for k in range(0, codes.shape[1], 4)]

    def edges(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Start and piece of every occurrence, sorted by start, then length."""
        n = len(text)
        codes = np.zeros(n + self.width, np.uint64)
        codes[:n] = self._codes(text)
        keys = self._keys(np.lib.stride_tricks.sliding_window_view(codes, self.width)[:n])
        order = self._sorted(keys[0], self.width)
        keys = [k[order] for k in keys]
        first, last = self._search(keys, self.low, False), self._search(keys, self.high, True)
        found = np.maximum(last - first, 0)
        piece = np.repeat(np.arange(len(found)), found)
        at = order[np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found) + np.repeat(first, found)]
        # one number for place, length and piece
        longest, many = self.width + 1, len(self.lengths)
        place, piece = np.divmod(np.sort((at * longest + self.lengths[piece]) * many + piece), many)
        return place // longest, piece

    @staticmethod
    def _sorted(key: np.ndarray, width: int) -> np.ndarray:
        """The order of suffixes by `width` characters; `key` holds the first four of each."""
        n, span = len(key), 4
        while True:
            order = np.argsort(key)
            if span >= width or span >= n:
                return order
            sorted_key = key[order]
            rank = np.zeros(n + span, np.uint64)
            rank[order] = np.cumsum(np.r_[True, sorted_key[1:] != sorted_key[:-1]])
            key = rank[:n] << np.uint64(32) | rank[span:]
            span *= 2

    @staticmethod
    def _search(keys: list[np.ndarray], sought: list[np.ndarray], right: bool) -> np.ndarray:
        """The first sorted suffix not below each sought key (or above it, to the right), by binary search of all at once."""
        lo, hi = np.zeros(len(sought[0]), np.int64), np.full(len(sought[0]), len(keys[0]))
        while (lo < hi).any():
            mid = np.minimum((lo + hi) // 2, len(keys[0]) - 1)
            less, equal = np.zeros(len(lo), bool), np.ones(len(lo), bool)
            for k, s in zip(keys, sought, strict=True):
                x = k[mid]
                less |= equal & (x < s)
                equal &= x == s
            go = (less | equal if right else less) & (lo < hi)
            lo, hi = np.where(go, mid + 1, lo), np.where(go | (lo >= hi), hi, mid)
        return lo


def _chunks(words: Iterable[str], chars: int) -> Iterator[list[str]]:
    """Lists of at least `chars` characters, but for the last."""
    words = list(words)
    if sum(map(len, words)) + len(words) <= chars:
        if words:
            yield words
        return
    held, size = [], 0
    for word in words:
        held.append(word)
        size += len(word) + 1
        if size > chars:
            yield held
            held, size = [], 0
    if held:
        yield held


class Codec:
    def __init__(self, path: str, most: int = KEPT) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.text_of = [model.id_to_piece(k) for k in range(n)]
        self.byte_ids = {int(self.text_of[k][1:-1], 16): k for k in range(n) if model.is_byte(k)}
        self.bytes_of = {k: b for b, k in self.byte_ids.items()}
        self.hidden = {k for k in range(n) if model.is_control(k)}
        self.unknown = model.unk_id()
        self.shown = [b"" if k in self.hidden else bytes([self.bytes_of[k]]) if k in self.bytes_of else x.replace(MARK, " ").encode() for k, x in enumerate(self.text_of)]
        self.plain = [k for k in range(n) if not (k in self.hidden or k in self.bytes_of or model.is_unknown(k) or model.is_unused(k))]
        self.scores = [model.get_score(k) for k in self.plain]
        pieces = [self.text_of[k] for k in self.plain]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece crosses the beginning of a word")
        self.matcher = SuffixMatcher(pieces)
        self.most, self.known, self.parts, self.unkept = most, {}, {}, []  # unkept: words of KEPT_CHARS and more

    def _relax(self, word: str, starts: list[int], pieces: list[int], base: int) -> bytes:
        """Join neighbours along the word's edges, the best-scored first; `base` is where the word stands."""
        lengths, scores = self.matcher.lengths, self.scores
        edge = {(s - base, s - base + int(lengths[p])): p for s, p in zip(starts, pieces, strict=True)}
        n = len(word)
        after, before, gone = list(range(1, n + 1)), list(range(-1, n)), [False] * (n + 1)
        heap = [(-scores[p], i, i + 1, i + 2) for i in range(n - 1) if (p := edge.get((i, i + 2))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, j, k = heapq.heappop(heap)
            if gone[i] or gone[j] or after[i] != j or j >= n or after[j] != k:
                continue
            gone[j] = True
            after[i] = k
            if k <= n:
                before[k] = i
            if k < n and (p := edge.get((i, after[k]))) is not None:
                heapq.heappush(heap, (-scores[p], i, k, after[k]))
            if i and (p := edge.get((before[i], k))) is not None:
                heapq.heappush(heap, (-scores[p], before[i], i, k))
        out, i = array("I"), 0
        while i < n:
            p = edge.get((i, after[i]))
            if p is not None:
                out.append(self.plain[p])
            else:
                out.extend(self.byte_ids.get(b, self.unknown) for b in word[i : after[i]].encode("utf-8", "surrogatepass"))
            i = after[i]
        return out.tobytes()

    def learn(self, words: Iterable[str]) -> None:
        for some in _chunks(set(words).difference(self.known), CUT):
            self._learn(some)

    def _learn(self, words: list[str]) -> None:
        if max(map(len, words)) > LONG:
            for long in (w for w in words if len(w) > LONG):
                self.known[long] = b"".join(self._relax_windows(long))
                if len(long) > KEPT_CHARS:
                    self.unkept.append(long)
            words = [w for w in words if len(w) <= LONG]
            if not words:
                return
        parts, counts = self.matcher.parts(words)
        if len(self.parts) > KEPT_PARTS:
            self.parts = {}
        for some in _chunks(set(parts).difference(self.parts), JOINED):
            self._relax_together(some)
        ids, at = list(map(self.parts.__getitem__, parts)), 0
        for word, n in zip(words, counts.tolist(), strict=True):
            self.known[word] = ids[at] if n == 1 else b"".join(ids[at : at + n])
            at += n

    def _relax_windows(self, word: str) -> Iterator[bytes]:
        """A word of any length, indexed a window at a time. A window ends at the last place that no piece crosses: what lies
        on either side of it can never be joined. Where a window has no such place it is doubled."""
        at, size, width = 0, WINDOW, self.matcher.width
        while at < len(word):
            part = word[at : at + size]
            start, piece = self.matcher.edges(part)
            cut = len(part)
            if at + cut < len(word):
                to = start + self.matcher.lengths[piece]
                crossed = np.zeros(len(part) + 2, np.int64)  # of the places start + 1 to to - 1
                np.add.at(crossed, start + 1, 1)
                np.add.at(crossed, to, -1)
                free = np.flatnonzero(np.cumsum(crossed)[1 : max(1, len(part) - width)] == 0)
                if not len(free):
                    size *= 2
                    continue
                cut = int(free[-1]) + 1
                inside = to <= cut
                start, piece = start[inside], piece[inside]
            yield self._relax(part[:cut], start.tolist(), piece.tolist(), 0)
            at, size = at + cut, WINDOW

    def _relax_together(self, words: list[str]) -> None:
        """The same for many short parts of words: each round joins the best pair of every part."""
        text = "\0".join(words)
        start, piece = self.matcher.edges(text)
        width, scores, n = self.matcher.width + 1, np.array(self.scores), len(text)
        keys = start * width + self.matcher.lengths[piece]
        lens = np.array([len(w) for w in words])
        base = np.cumsum(lens + 1) - lens - 1
        of = np.repeat(np.arange(len(words)), lens + 1)[:n]
        first, end = base[of], (base + lens)[of]

        def edge(a: np.ndarray, b: np.ndarray, ok: np.ndarray) -> np.ndarray:
            """The piece from a to b of one word; -1 where there is none."""
            k = a * width + np.minimum(b - a, width - 1)
            at = np.minimum(np.searchsorted(keys, k), max(len(keys) - 1, 0))
            return np.where(ok & (b - a < width) & (keys[at] == k), piece[at], -1) if len(keys) else np.full(len(a), -1)

        def gain(a: np.ndarray, b: np.ndarray, ok: np.ndarray) -> np.ndarray:
            p = edge(a, b, ok)
            return np.where(p >= 0, scores[p], -np.inf)

        place = np.arange(n)
        after, before, live = place + 1, place - 1, place < end
        pair = gain(place, place + 2, place + 2 <= end)
        seat, head = place, base  # the places of the parts in which there still is a pair, and where each part begins among them
        while True:
            now = pair[seat]
            best = np.maximum.reduceat(now, head)
            going, size = best > -np.inf, np.diff(np.r_[head, len(seat)])
            if not going.any():
                break
            i = seat[(now == np.repeat(best, size)) & (now > -np.inf)]
            if np.count_nonzero(going) < 0.8 * len(going):
                seat, size = seat[np.repeat(going, size)], size[going]
                head = np.cumsum(size) - size
            i = i[np.r_[True, of[i[1:]] != of[i[:-1]]]]  # the leftmost of equals
            j = after[i]
            k = after[j]
            after[i], live[j], pair[j] = k, False, -np.inf
            inside = k < end[i]
            before[k[inside]] = i[inside]
            pair[i] = gain(i, after[np.minimum(k, n - 1)], inside)
            left = before[i]
            has = left >= first[i]
            pair[left[has]] = gain(left[has], k[has], np.ones(int(has.sum()), bool))
        at = np.flatnonzero(live)
        found = edge(at, after[at], np.ones(len(at), bool))
        ids = np.array(self.plain)[found].astype("<u4").tobytes()
        cut = np.searchsorted(at, np.r_[base, n])
        odd = set(of[at[found < 0]].tolist())
        for k, (word, lo, hi) in enumerate(zip(words, cut.tolist(), cut[1:].tolist(), strict=False)):
            if k in odd:
                whole = array("I")
                for a, p in zip(at[lo:hi].tolist(), found[lo:hi].tolist(), strict=True):
                    if p >= 0:
                        whole.append(self.plain[p])
                    else:
                        whole.extend(self.byte_ids.get(b, self.unknown) for b in text[a : after[a]].encode("utf-8", "surrogatepass"))
                self.parts[word] = whole.tobytes()
            else:
                self.parts[word] = ids[4 * lo : 4 * hi]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [_SEGMENT.findall(MARK + x.replace(" ", MARK)) if x else [] for x in texts]
        nul = [any("\0" in w for w in words) if "\0" in x else False for x, words in zip(texts, split, strict=True)]
        seen: set[str] = set()
        for words, odd in zip(split, nul, strict=True):
            seen.update(w for w in words if "\0" not in w) if odd else seen.update(words)
        if len(self.known) > self.most:  # here only: words with the separator are learnt while the others are read
            self.known = {}
        self.learn(seen)
        out = [b"".join(self._with_nul(w) if odd and "\0" in w else self.known[w] for w in words) if odd else b"".join(map(self.known.__getitem__, words)) for words, odd in zip(split, nul, strict=True)]
        for word in self.unkept:
            self.known.pop(word, None)
        self.unkept = []
        return out

    def _with_nul(self, word: str) -> bytes:
        """The separator itself in a word: no piece holds it, so its sides are words of their own."""
        nul = array("I", [self.byte_ids[0]]).tobytes()
        parts = word.split("\0")
        self.learn({p for p in parts if p})
        return nul.join(self.known[p] if p else b"" for p in parts)

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.shown.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids) of every whole text: little-endian unsigned 32-bit ids; `model` is a SentencePiece file that every executor has."""
    bound_batches(docs.sparkSession)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            for part in in_parts(batch, 1, 512):
                ids = own.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return chosen.mapInArrow(rows, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """`encoded` (with ids) and the text that they stand for; the space mark itself reads as a space."""
    bound_batches(encoded.sparkSession)
    at = encoded.columns.index("ids")

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            texts = [own.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(rows, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", decoded string")

"""Token counts under a unigram model, by dynamic programming shared over a trie.

The distinct pre-tokens of a batch (runs of non-white characters, each after the mark of a word's
start) are inserted in a trie by walking them in sorted order: a stack holds the scores of the
current path, so every prefix that pre-tokens share is scored once. A node's score is the best
over the pieces that end there; the terminal node's token count is the pre-token's. A text's count
is the sum over its pre-tokens, whose counts a worker remembers.

The vocabulary is a SentencePiece file. Its pieces' log-probabilities are taken from their order,
-log(1 + rank) (Zipf's law); a character that no piece covers costs one token for each of its UTF-8
bytes. Of segmentations with equal scores the one with fewer tokens counts.

Defined results: a null text counts as empty, with no tokens; repeated rows are counted as rows of
their own; an empty table gives an empty result; columns beside id and text are ignored. A text is
counted whole, however long, with its distinct words held at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import bound_batches, text_or_empty

MARK = "▁"
#: Log-probability of one byte of an uncovered character; pre-tokens whose counts a worker keeps.
BYTE_SCORE, KEPT = -25.0, 400_000


class TrieCounter:
    def __init__(self, scores: dict[str, float], most: int = KEPT) -> None:
        self.scores, self.most, self.counts = scores, most, {}
        self.longest = max(map(len, scores), default=1)

    def count_new(self, words: Iterable[str]) -> dict[str, int]:
        """Token counts of distinct pre-tokens, each prefix that they share scored once."""
        get, longest = self.scores.get, self.longest
        best, tokens = [0.0], [0]  # of every prefix of the current path; a node of the trie each
        path, out = "", {}
        for word in sorted(words):
            marked, shared = MARK + word, 0
            for shared, (x, y) in enumerate(zip(path, marked, strict=False)):  # noqa: B007
                if x != y:
                    break
            else:
                shared = min(len(path), len(marked))
            del best[shared + 1 :], tokens[shared + 1 :]
            for end in range(shared + 1, len(marked) + 1):
                char = marked[end - 1]
                n = len(char.encode("utf-8", "surrogatepass"))
                top, count = best[end - 1] + n * BYTE_SCORE, tokens[end - 1] + n
                for start in range(max(0, end - longest), end):
                    score = get(marked[start:end])
                    if score is not None:
                        total = best[start] + score
                        if total > top or (total == top and tokens[start] + 1 < count):
                            top, count = total, tokens[start] + 1
                best.append(top)
                tokens.append(count)
            path = marked
            out[word] = tokens[len(marked)]
        return out

    def learn(self, words: set[str]) -> None:
        if len(self.counts) > self.most:
            self.counts = {}
        self.counts |= self.count_new(words.difference(self.counts))


@lru_cache(maxsize=2)
def counter(path: str) -> TrieCounter:
    return TrieCounter(piece_scores(path))


def piece_scores(path: str) -> dict[str, float]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [k for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_byte(k) or model.is_unknown(k) or model.is_unused(k))]
    return {model.id_to_piece(k): -math.log(1 + rank) for rank, k in enumerate(plain, 1)}


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of every whole text; `vocabulary` is a SentencePiece file that every executor has."""
    bound_batches(docs.sparkSession)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = counter(vocabulary)
        for batch in batches:
            words_of, tokens_of = [], []
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 512):
                split = [x.split() for x in texts[at : at + 512]]
                seen: set[str] = set()
                for words in split:
                    seen.update(words)
                held.learn(seen)
                get = held.counts.__getitem__
                words_of += map(len, split)
                tokens_of += (sum(map(get, words)) for words in split)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words_of, pa.int64()), pa.array(tokens_of, pa.int64())], names=["doc_id", "n_pretokens", "n_tokens"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return chosen.mapInArrow(rows, "doc_id long, n_pretokens long, n_tokens long")

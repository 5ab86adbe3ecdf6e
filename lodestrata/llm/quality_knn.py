"""Quality classifier by nearest-neighbour voting in a latent space.

A text's features are the shares of triples of character classes (letters of either case,
digits, spaces, groups of punctuation) and a few rates of repetition. The latent space is a
truncated singular value decomposition of the features of a bounded, labelled sample. The
sample's latent vectors (at most 2 * PER_LABEL of DIMS floats) go to every task; each document
is compared with all of them by one blocked cosine product, and its K nearest vote with weight
similarity ** SHARPNESS.

Learning reads at most PER_LABEL rows of each label, chosen by a hash of the id, whatever the
size of the tables; scoring is a map over all rows.

Defined results: a null text is scored as empty; a text without features, or any text where no
row is labelled, gets the sample's share of label 1 (0.5 where there is none); repeated rows are
scored as rows of their own; labels that are null or belong to no document teach nothing; of rows
that repeat an id, or labels that do, the least label and text teach; an
empty table gives an empty result. A text is read whole, however long; a few bytes for each of its
characters are held at a time. All columns are carried along; the score's column replaces
one of the same name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm.common import bound_batches, giving_back, text_or_empty

#: Labelled rows of each label that are learned from at most; dimensions; voters; power of the similarity; features kept.
PER_LABEL, DIMS, K, SHARPNESS, FEATURES = 2048, 32, 15, 16, 1024
#: Weight of the repetition rates beside the shares, whose squares add up to 1.
RATE_WEIGHT = 1.0
_GROUPS = (".,", "!", "%&*$#", "|", "\"'`", "()[]{}<>", ":;?", "=+-/_\\~^")


def _classes() -> np.ndarray:
    """Class of each byte: 0 lower-case or other letter, 1 upper, 2 digit, 3 space, 4 newline, then the groups, 13 other, 14 lead byte of Latin letters."""
    out = np.zeros(256, np.int64)
    for b in range(128):
        c = chr(b)
        group = next((5 + k for k, g in enumerate(_GROUPS) if c in g), 13)
        out[b] = 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c == " " else 4 if c == "\n" else group
    out[0xC3] = 14
    return out


_CLASS = _classes()
TRIPLES, RATES = 4096, 4


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features that are not zero."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    k = _CLASS[raw]
    triples = (k[:-2] << 8) | (k[1:-1] << 4) | k[2:]
    counts = np.bincount(triples, minlength=TRIPLES)
    at = np.flatnonzero(counts)
    shares = np.sqrt(counts[at] / max(1, len(triples)))
    words = text.lower().split()
    lines = text.split("\n")
    n = max(1, len(words))
    twice = sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
    rates = RATE_WEIGHT * np.array([twice, 1 - len(set(words)) / n, 1 - len(set(lines)) / len(lines), 0.3 * min(1, n / 20)])
    return np.concatenate([at, TRIPLES + np.arange(RATES)]), np.concatenate([shares, rates]).astype(np.float32)


def dense(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), TRIPLES + RATES), np.float32)
    for row, text in zip(out, texts, strict=True):
        at, x = features(text)
        row[at] = x
    return out


@dataclass(frozen=True)
class Model:
    kept: np.ndarray  # features in use
    axes: np.ndarray  # kept features by dimensions
    vectors: np.ndarray  # labelled latent vectors, of length 1
    labels: np.ndarray
    prior: float

    def scores(self, texts: list[str], block: int = 512) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if not len(self.labels):
            return out
        k = min(K, len(self.labels))
        for at in range(0, len(texts), block):
            latent = dense(texts[at : at + block])[:, self.kept] @ self.axes
            size = np.linalg.norm(latent, axis=1)
            seen = size > 1e-9
            near = (latent / np.where(seen, size, 1)[:, None]) @ self.vectors.T
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            vote = np.maximum(np.take_along_axis(near, best, 1).astype(np.float64), 0) ** SHARPNESS
            total = vote.sum(1)
            ok = seen & (total > 0)
            out[at : at + block][ok] = np.clip((vote * self.labels[best]).sum(1)[ok] / total[ok], 0, 1)
        return out


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, dims: int = DIMS) -> Model:
    """A model of label 1 against 0 from (doc_id, quality) rows that are not held out; at most `per_label` of each."""
    bound_batches(docs.sparkSession)
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label")).where(~held_out() & F.col("label").isin(0, 1))
    of = [usable.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for y in (0, 1)]
    chosen = F.broadcast(of[0].unionByName(of[1]))  # at most 2 * per_label rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).join(chosen, "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min(F.struct("label", "text")).alias("x")).select("doc_id", "x.text", "x.label")

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [features(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2).cast(pa.int32()), pa.array([a.astype(np.uint16).tobytes() for a, _ in got], pa.binary()), pa.array([x.tobytes() for _, x in got], pa.binary())],
                names=["doc_id", "label", "at", "x"],
            )

    rows = sorted(texts.select("doc_id", "text", "label").mapInArrow(sketch, "doc_id long, label int, at binary, x binary").collect())
    y = np.array([r["label"] for r in rows], np.float64)
    full = np.zeros((len(rows), TRIPLES + RATES), np.float32)
    for row, r in zip(full, rows, strict=True):
        row[np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["x"], np.float32)
    mass = full.sum(0)
    kept = np.sort(np.argsort(-mass, kind="stable")[: min(FEATURES, int((mass > 0).sum()))])
    x = full[:, kept].astype(np.float64)
    values, axes = np.linalg.eigh(x.T @ x) if len(rows) and len(kept) else (np.zeros(0), np.zeros((len(kept), 0)))
    axes = axes[:, np.argsort(-values)[:dims]]
    latent = x @ axes
    size = np.linalg.norm(latent, axis=1)
    seen = size > 1e-9
    vectors = (latent[seen] / size[seen, None]).astype(np.float32)
    return Model(kept, axes.astype(np.float32), vectors, y[seen], float(y.mean()) if len(y) else 0.5)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """`docs` with the probability-like score of label 1, from 0 to 1."""
    bound_batches(docs.sparkSession)
    docs = docs.drop(score_col)
    at = docs.columns.index(text_col)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(texts), pa.float64())], names=[*batch.schema.names, score_col])

    return docs.mapInArrow(giving_back(rows), T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))

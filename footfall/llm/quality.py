"""Quality by the votes of the nearest labelled texts in a latent semantic space.

A text is a row of term weights: byte trigrams, shapes of words (runs of capitals, small letters,
digits, symbols, other characters), shapes of word pairs, and how often words repeat. Each group of
terms has the same weight. A truncated singular value decomposition of the labelled texts' rows
gives the space; texts are compared with every labelled text by cosine, block by block, and the
nearest ones vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm import text as T

TRIGRAMS, SHAPES, PAIRS, REPEATS = 1 << 11, 1 << 9, 1 << 9, 3
GROUPS = (TRIGRAMS, SHAPES, PAIRS, REPEATS)
TERMS = sum(GROUPS)
#: Labelled texts the model is fitted on at most, taken by hash of their id.
SAMPLE_ROWS = 4000
DIMENSIONS = 64
NEIGHBOURS = 25
#: Similarities are raised to this power to weigh a vote.
SHARPNESS = 8
#: Texts handled at once.
ROWS = 512

_CLASSES = np.full(256, 3, np.uint8)  # symbols
_CLASSES[ord("A") : ord("Z") + 1] = 0
_CLASSES[ord("a") : ord("z") + 1] = 1
_CLASSES[ord("0") : ord("9") + 1] = 2
_CLASSES[128:] = 4


def shapes(found: T.Words) -> np.ndarray:
    """A number for the shape of each word."""
    kinds = _CLASSES[found.data]
    turn = np.ones(len(kinds), bool)
    turn[1:] = kinds[1:] != kinds[:-1]
    turn[found.starts] = True
    upto = np.concatenate([[0], np.cumsum(turn)])
    runs = T.Words(
        kinds[turn], found.offsets, upto[found.starts], upto[found.ends], found.first
    )
    return runs.hashes()


def rows_of_terms(column: pa.Array) -> np.ndarray:
    """Term counts of texts, a row each."""
    found = T.words(column, T.WHITE, lower=False)
    texts, owner, data = found.texts, found.owner(), found.data
    whose = np.repeat(np.arange(texts), np.diff(found.offsets))
    a, b, c = (data[k : len(data) - 2 + k].astype(np.uint32) for k in range(3))
    good = whose[:-2] == whose[2:]
    code = ((a << np.uint32(16) | b << np.uint32(8) | c) * np.uint32(0x9E3779B1))[good]
    shape, words = shapes(found), found.hashes()
    near = owner[1:] == owner[:-1]
    pairs = T.mix(shape[:-1] * np.uint64(3) + shape[1:])[near]
    # a word again at once; a word met before in the text; all others
    order = np.lexsort((np.arange(len(words)), words, owner))
    again = np.zeros(len(words), bool)
    again[order[1:]] = (words[order[1:]] == words[order[:-1]]) & (
        owner[order[1:]] == owner[order[:-1]]
    )
    repeat = again.astype(np.int64)
    repeat[1:][near & (words[1:] == words[:-1])] = 2
    parts = (
        (code >> np.uint32(32 - 11), whose[:-2][good], TRIGRAMS),
        (shape >> np.uint64(64 - 9), owner, SHAPES),
        (pairs >> np.uint64(64 - 9), owner[1:][near], PAIRS),
        (repeat, owner, REPEATS),
    )
    return np.concatenate(
        [
            np.bincount(
                who * size + term.astype(np.int64), minlength=texts * size
            ).reshape(texts, size)
            for term, who, size in parts
        ],
        axis=1,
    )


def weighted(table: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Log frequencies by rarity, each group of terms at unit length."""
    return _scaled(np.log1p(table.astype(np.float32)), rarity)


def _scaled(out: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """The same from log frequencies, in place."""
    out *= rarity.astype(np.float32)
    at = 0
    for size in GROUPS:
        part = out[:, at : at + size]
        part /= np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
        at += size
    return out


@dataclass
class Model:
    rarity: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def place(self, table: np.ndarray) -> np.ndarray:
        """Unit vectors in the latent space."""
        at = weighted(table, self.rarity) @ self.axes
        return at / np.maximum(np.linalg.norm(at, axis=1, keepdims=True), 1e-9)

    def score(self, table: np.ndarray) -> np.ndarray:
        """Share of the nearest labelled texts' votes for label 1."""
        out = np.full(len(table), self.prior)
        some = table.any(axis=1)
        if not some.any() or not len(self.labels):
            return out
        close = self.place(table[some]) @ self.vectors.T
        k = min(NEIGHBOURS, close.shape[1])
        near = np.argpartition(-close, k - 1, axis=1)[:, :k]
        votes = np.maximum(np.take_along_axis(close, near, axis=1), 1e-6).astype(float) ** SHARPNESS
        out[some] = (votes * self.labels[near]).sum(axis=1) / votes.sum(axis=1)
        return np.clip(out, 0, 1)


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in T.chunks(batch, "_body"):
            for at in range(0, part.num_rows, ROWS):
                yield part.slice(at, ROWS)


def _packed(row: np.ndarray) -> bytes:
    """The terms that occur, two bytes each, and their counts, four bytes each."""
    some = np.flatnonzero(row)
    return some.astype("<u2").tobytes() + row[some].astype("<u4").tobytes()


def _unpacked(packed: pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    n = packed.size // 6
    return np.frombuffer(packed, "<u2", n), np.frombuffer(packed, "<u4", n, 2 * n)


def fit(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    dimensions: int = DIMENSIONS,
) -> Model:
    """Fit on labels (0 or 1) of documents, `sample_rows` of them at most, chosen by hash of the id.

    The sample is drawn from the labels that have a document with a text; its ids, a bounded number,
    are sent to the documents, of which no text is shuffled. Only the terms that a text has come to
    the driver. Null texts or labels are left out, as are labels without a document; an id that
    repeats counts each time. Without labelled documents every score is 0.5.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in small(batches):
            table = rows_of_terms(rows.column("_body"))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_packed(x) for x in table], pa.binary()),
                    rows.column("label"),
                    rows.column("order"),
                ],
                names=["terms", "label", "order"],
            )

    texts = documents.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("_body")).where(
        "_body is not null"
    )
    chosen = (
        labels.select(
            F.col(doc_id).alias("id"),
            F.col(label).cast("int").alias("label"),
            F.xxhash64(F.col(doc_id).cast("string")).alias("order"),
        )
        .where("id is not null and label is not null")
        .join(texts.select("id").distinct(), "id", "left_semi")
        .orderBy("order", "label")
        .limit(sample_rows)
    )
    sample = texts.join(F.broadcast(chosen), "id").select("_body", "label", "order")
    rows = (
        sample.mapInArrow(work, "terms BINARY, label INT, order BIGINT")
        .orderBy("order", "label", "terms")
        .limit(sample_rows)
        .toArrow()
    )
    if not rows.num_rows:
        none = np.zeros((0, dimensions), np.float32)
        return Model(np.zeros(TERMS), np.zeros((TERMS, dimensions)), none, np.zeros(0), 0.5)
    labels_ = rows.column("label").to_numpy().astype(float)
    # the one dense matrix; all that is done to it is done in place
    x, held = np.zeros((len(labels_), TERMS), np.float32), np.zeros(TERMS)
    for row, packed in zip(x, rows.column("terms"), strict=True):
        term, count = _unpacked(packed.as_buffer())
        row[term] = np.log1p(count.astype(np.float32))
        held[term] += 1
    del rows
    rarity = np.log(1 + len(labels_) / (1 + held))
    _scaled(x, rarity)
    # randomised range finder with two power steps
    basis = np.random.default_rng(7).standard_normal((x.shape[1], dimensions + 16), np.float32)
    for _ in range(3):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    _, _, turned = np.linalg.svd(x @ basis, full_matrices=False)
    axes = (basis @ turned.T)[:, :dimensions].astype(np.float32)
    at = x @ axes
    at /= np.maximum(np.linalg.norm(at, axis=1, keepdims=True), 1e-9)
    return Model(rarity, axes, at, labels_, float(labels_.mean()))


def score_documents(
    documents: DataFrame,
    model: Model,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of documents: doc_id, the columns of `keep`, score between 0 and 1.

    Every text is compared with all labelled vectors of the model, whose number is bounded when it
    is fitted. A null or empty text has no vector and gets the share of label 1 among the labelled.
    Equal similarities at the edge of the neighbourhood fall either way. Repeated rows are scored
    each on its own; no documents give no rows. Rows map to rows: no shuffle. A column of `keep` may
    not have the name of another one of the result.
    """
    T.no_clash(keep, ["doc_id", "_body", "score"])
    sent = documents.sparkSession.sparkContext.broadcast(model)
    chosen = documents.select(
        F.col(doc_id).alias("doc_id"), *keep, F.col(text).cast("string").alias("_body")
    )
    names = [c for c in chosen.columns if c != "_body"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in small(batches):
            score = sent.value.score(rows_of_terms(rows.column("_body")))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in names), pa.array(score, pa.float64())],
                names=[*names, "score"],
            )

    return chosen.mapInArrow(work, T.schema(chosen, names, "score DOUBLE"))

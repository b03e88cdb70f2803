"""Toxicity: embeddings of subword bags, averaged into a linear softmax and trained jointly in NumPy.

A word is the bag of its character n-grams, borders included, so a misspelling that was never seen
shares most vectors with the words it was made from. Digits and mask characters inside a word belong
to it, so "id1ot" and "id*ot" stay one word. A text is the average over the n-grams of all its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm import common
from secflow.llm.hashing import U64, SpanHash, mix
from secflow.llm.letters import word_codes

#: Rows of the embedding table, its width, and the lengths of n-grams.
BUCKET_BITS, WIDTH, GRAMS = 18, 8, (4, 5, 6)
#: Most labelled documents of class 0 and 1 that the model is fitted on: those of least id hash.
MOST_BY_CLASS = (3000, 1500)
STEPS, RATE, SCALE = 60, 0.05, 60.0
#: A row is trained when at least so many of the fitted documents have it.
LEAST_DOCS = 3
#: N-grams of no weight that every bag holds besides its own, so that a handful of words can hardly reach the limit.
PRIOR = 50
#: Texts whose n-grams are held at a time while fitting.
FIT_TEXTS = 100
THRESHOLD = 0.7


def subword_rows(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, embedding row) of every n-gram that lies in one word with at most a border at either end."""
    codes, owner = word_codes(texts)
    gaps = np.concatenate([[0], np.cumsum(codes == 0)])
    hasher, spread = SpanHash(41), mix(codes.astype(U64))
    at_all, rows = [], []
    for n in GRAMS:
        at = np.arange(max(0, len(codes) - n + 1))
        at = at[gaps[at + n - 1] == gaps[at + 1]]
        at_all.append(owner[at])
        rows.append((hasher.spans(spread, at, at + n) >> U64(64 - BUCKET_BITS)).astype(np.int32))
    return np.concatenate(at_all), np.concatenate(rows)


@dataclass
class SubwordModel:
    """Embedding rows, and the softmax weights and biases of the two classes."""

    table: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def log_odds(self) -> tuple[np.ndarray, float]:
        """What each embedding row adds to the log-odds of class 1, and the rest of them."""
        return SCALE * self.table @ (self.weights[:, 1] - self.weights[:, 0]), float(self.bias[1] - self.bias[0])


def bag_shares(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, row, share of the text's n-grams), each pair once, by text."""
    owner, row = subword_rows(texts)
    pair, times = np.unique((owner.astype(np.int64) << BUCKET_BITS) | row, return_counts=True)
    doc, row = (pair >> BUCKET_BITS).astype(np.int32), (pair & ((1 << BUCKET_BITS) - 1)).astype(np.int32)
    return doc, row, (times / (np.bincount(doc, times) + PRIOR)[doc]).astype(np.float32)


def fit(texts: list[str | None], labels: np.ndarray, steps: int = STEPS, seed: int = 5) -> SubwordModel:
    """Full-batch training in which both classes weigh the same; the order of the texts has no effect.

    Texts are cut into n-grams twice, a few at a time: once to count the documents of each row, once to
    keep the bags of the rows that are trained. Only those bags stay in memory.
    """
    order = sorted(range(len(texts)), key=lambda i: (texts[i] or "", labels[i]))
    texts, labels = [texts[i] for i in order], np.asarray(labels, np.int64)[order]
    buckets, starts = 1 << BUCKET_BITS, range(0, len(texts), FIT_TEXTS)
    docs_of = np.zeros(buckets, np.int32)
    for start in starts:
        docs_of += np.bincount(bag_shares(texts[start:start + FIT_TEXTS])[1], minlength=buckets).astype(np.int32)
    used = np.flatnonzero(docs_of >= LEAST_DOCS)
    place = np.full(buckets, -1, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    nnz = int(docs_of[used].sum())
    doc, row, share, at = np.empty(nnz, np.int32), np.empty(nnz, np.int32), np.empty(nnz, np.float32), 0
    for start in starts:
        d, r, part = bag_shares(texts[start:start + FIT_TEXTS])
        kept = place[r] >= 0
        to = slice(at, at + int(kept.sum()))
        doc[to], row[to], share[to], at = d[kept] + start, place[r[kept]], part[kept], to.stop
    # Pieces of whole bags, so that a step needs little beyond the bags themselves.
    pieces = [slice(*np.searchsorted(doc, (i, i + FIT_TEXTS))) for i in starts]

    rng = np.random.default_rng(seed)
    model = SubwordModel(rng.normal(0, 0.01, (len(used), WIDTH)), rng.normal(0, 0.5, (WIDTH, 2)), np.zeros(2))
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (model.table, model.weights, model.bias)]
    for step in range(1, steps + 1):
        rows, rest = model.log_odds()
        rows, odds, pull = rows.astype(np.float32), np.full(len(labels), rest), np.zeros(len(used))
        for p in pieces:
            odds += np.bincount(doc[p], share[p] * rows[row[p]], minlength=len(labels))
        error = weight * (1 / (1 + np.exp(-np.clip(odds, -50, 50))) - labels)  # of class 1; class 0 has its negative
        for p in pieces:
            pull += SCALE * np.bincount(row[p], share[p] * error[doc[p]], minlength=len(used))
        toward = model.table.T @ pull
        slopes = (np.outer(pull, model.weights[:, 1] - model.weights[:, 0]), np.stack([-toward, toward], 1), np.array([-1, 1]) * error.sum())
        for value, slope, m in zip((model.table, model.weights, model.bias), slopes, moments):
            m[0] = 0.9 * m[0] + 0.1 * slope
            m[1] = 0.99 * m[1] + 0.01 * slope**2
            size = np.sqrt(m[1] / (1 - 0.99**step))
            value -= RATE * (m[0] / (1 - 0.9**step)) / (size + 0.1 * size.max(initial=0) + 1e-12)
    table = np.zeros((buckets, WIDTH))
    table[used] = model.table
    return SubwordModel(table, model.weights, model.bias)


def score_texts(texts: list[str | None], rows: np.ndarray, rest: float) -> np.ndarray:
    owner, row = subword_rows(texts)
    total = np.bincount(owner, minlength=len(texts))
    odds = np.bincount(owner, rows[row], minlength=len(texts)) / (total + PRIOR) + rest
    return np.where(total > 0, 1 / (1 + np.exp(-np.clip(odds, -50, 50))), 0.0)


def _fitted(sample: DataFrame) -> SubwordModel:
    """The model of a bounded sample (text, label), trained in one task; only its parameters reach the driver."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            texts += batch["text"].to_pylist()
            labels += batch["label"].to_pylist()
        m = fit(texts, np.array(labels, np.int64))
        yield pa.RecordBatch.from_pydict({k: pa.array([v.astype(np.float64).tobytes()], pa.binary())
                                          for k, v in (("a", m.table), ("w", m.weights), ("b", m.bias))})

    row = sample.repartition(1).mapInArrow(train, "a binary, w binary, b binary").first()
    if row is None:  # no rows, so no task
        return fit([], np.zeros(0, np.int64))
    return SubwordModel(np.frombuffer(row.a).reshape(-1, WIDTH), np.frombuffer(row.w).reshape(WIDTH, 2), np.frombuffer(row.b))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                 most_by_class: tuple[int, int] = MOST_BY_CLASS) -> SubwordModel:
    """Fit on the documents that ``labels`` marks 0 or 1, at most ``most_by_class`` of either.

    The sample holds the labelled documents of least id hash, which depends on nothing else. Rows with
    null ids, labels or other label values are left out. With one class or none the model still scores,
    near the share of class 1. The ids serve the join only and never reach the model.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("label IN (0, 1)").distinct()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = known.where(F.lit(False))
    for label, most in enumerate(most_by_class):
        ids = known.where(F.col("label") == label).join(rows.select("id").distinct(), "id", "left_semi")
        chosen = chosen.unionByName(ids.orderBy(F.xxhash64("id"), "id").limit(most))
    return _fitted(rows.join(F.broadcast(chosen), "id").select("text", "label"))


def score_toxicity(docs: DataFrame, model: SubwordModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the probability ``score`` of class 1 for every row, from the text alone.

    Null texts and texts without letters score 0. Null ids stay null, repeated rows give repeated equal
    rows, other columns are ignored whatever their names, and an empty table gives an empty result.
    Texts are read whole, a few megabytes at a time or one longer text. The embedding table has a fixed
    number of rows, so what is sent to tasks does not grow.
    """
    rows, rest = model.log_odds()
    rows = rows.astype(np.float32)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], "score": score_texts(part["text"].to_pylist(), rows, rest)})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(score, "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: SubwordModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose text scores below ``threshold``."""
    rows, rest = model.log_odds()
    rows = rows.astype(np.float32)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, text_col, 1 << 20):
            yield part.filter(pa.array(score_texts(part[text_col].to_pylist(), rows, rest) < threshold))

    return docs.mapInArrow(keep, docs.schema)

"""Toxicity by a classifier chain over word presence.

Categories are predicted one after another by logistic models.  The model of a category sees the
presence of learned words and word beginnings, which catch inflected forms, and the probabilities of the earlier categories; in training those
come from models that did not see the row (out-of-fold), so the chain learns from probabilities as good
as the ones it gets when it scores.

The classifier is fitted on a bounded sample of the labelled rows: the ``SAMPLE_ROWS`` with the smallest
hash of their doc_id.  Its vocabulary is the ``VOCABULARY`` words and beginnings (of four to eight bytes)
whose presence tells the first category best.  Every document is scored on its whole text.

Defined cases: a null or empty text has no words and is scored like any other; words are runs of
letters, digits and characters beyond ASCII, A-Z in lower case; labels of unknown documents, null labels
and labels other than 0 and 1 teach nothing; several labels of one document count as the largest; of several
documents of one doc_id the text with the least hash teaches, so at most ``SAMPLE_ROWS`` rows are collected; with
labels of one kind only every probability is that kind's share; repeated documents are scored row by
row and further columns are left out.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.decontamination import _TO_WORDS
from tallyweave.llm.texts import (
    ALNUM,
    LOWER,
    column_of,
    found_in,
    hash_bytes,
    prefix_hash,
    range_hash,
    spans,
    text_chunks,
    text_of,
    tidy,
)
from tallyweave.sources.scans import spread_small_scan
from tallyweave.storage import written

SAMPLE_ROWS = 20_000
VOCABULARY = 512
LEAST_DOCUMENTS = 3
FOLDS = 5
PENALTY = 1.0
BEGINNINGS = (4, 5, 6, 7, 8)  # bytes
SEVERE_WORDS = 3  # different telling words that make a toxic document a severe one


@dataclass
class Chain:
    """Vocabulary (sorted hashes) and one weight vector a category: bias, words, earlier categories."""

    words: np.ndarray
    weights: list[np.ndarray] = field(default_factory=list)

    def probabilities(self, presence: np.ndarray) -> np.ndarray:
        """One column a category for rows of word presence."""
        columns: list[np.ndarray] = []
        for weights in self.weights:
            columns.append(_sigmoid(_design(presence, columns) @ weights))
        return np.array(columns).T


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _design(presence: np.ndarray, earlier: list[np.ndarray]) -> np.ndarray:
    odds = [np.log((np.clip(p, 1e-6, 1 - 1e-6)) / (1 - np.clip(p, 1e-6, 1 - 1e-6)))[:, None] / 4 for p in earlier]
    return np.hstack([np.ones((len(presence), 1)), presence, *odds])


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Ridge-penalised logistic weights by Newton steps; the first column of x is the bias."""
    weights = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        weights[0] = np.log(share / (1 - share))
        return weights
    ridge = penalty * np.eye(x.shape[1])
    ridge[0, 0] = 1e-6
    for _ in range(30):
        p = _sigmoid(x @ weights)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ weights)
        weights = weights + step
        if np.abs(step).max() < 1e-7:
            break
    return weights


def fit_chain(words: np.ndarray, presence: np.ndarray, labels: np.ndarray, folds: np.ndarray) -> Chain:
    """``labels`` has a column a category in the order of the chain; ``folds`` deals the rows."""
    chain, earlier = Chain(words), []
    for y in labels.T.astype(float):
        x = _design(presence, earlier)
        chain.weights.append(logistic(x, y))
        out_of_fold = np.zeros(len(y))
        for fold in range(FOLDS):
            mine = folds == fold
            out_of_fold[mine] = _sigmoid(x[mine] @ logistic(x[~mine], y[~mine]))
        earlier.append(out_of_fold)
    return chain


def _features(text: str | None) -> set[tuple[int, bytes]]:
    """Words (under 0) and word beginnings (under their length) of a text."""
    words = set((text or "").encode().translate(_TO_WORDS).split())
    return {(0, w) for w in words} | {(n, w[:n]) for n in BEGINNINGS for w in words if len(w) >= n}


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a task that hold each feature, and those of the first category among them."""
    seen: Counter = Counter()
    toxic: Counter = Counter()
    for batch in batches:
        for text, label in zip(column_of(batch, "text").to_pylist(), column_of(batch, "label").to_pylist()):
            words = _features(text)
            seen.update(words)
            if label:
                toxic.update(words)
    words = list(seen)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([w[0] for w in words], pa.int32()),
            pa.array([w[1] for w in words], pa.binary()),
            pa.array([seen[w] for w in words], pa.int64()),
            pa.array([toxic[w] for w in words], pa.int64()),
        ],
        ["kind", "word", "n", "n_toxic"],
    )


def _salted(hashes: np.ndarray, kind: int) -> np.ndarray:
    """Keeps a beginning apart from the word of the same bytes."""
    return hashes + np.uint64(kind)


def presence_of(column: pa.Array, words: np.ndarray) -> np.ndarray:
    """Which of the sorted feature hashes occur in each text, as rows of 0 and 1."""
    out = np.zeros((len(column), len(words)), np.uint8)
    for first, _, data, offsets in text_chunks(column):
        begin, end = spans(ALNUM[data], offsets)
        total = prefix_hash(LOWER[data])
        for kind in (0, *BEGINNINGS):
            long = end - begin >= kind
            starts = begin[long]
            stops = starts + kind if kind else end
            at = found_in(words, _salted(range_hash(total, starts, stops), kind))
            known = at >= 0
            out[first + text_of(starts[known], offsets), at[known]] = 1
    return out


def _presence(words: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.packbits(presence_of(column_of(batch, "text"), words), axis=1)
            columns = [column_of(batch, "fold"), column_of(batch, "label"), pa.array([r.tobytes() for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["fold", "label", "bits"])

    return run


def fit(docs: DataFrame, labels: DataFrame, category: str = "toxic", rows: int = SAMPLE_ROWS) -> Chain:
    """The chain (``category``, severe) from a bounded sample of the labelled documents."""
    labels = labels.where(F.col(category).isin(0, 1) & F.col("doc_id").isNotNull())
    sample = (
        labels.groupBy("doc_id")
        .agg(F.max(category).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # At most ``rows`` rows of three numbers: a proven bound.
    sample = written(sample.withColumn("fold", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(FOLDS)).cast("int")), "toxic-sample")
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    # One text a doc_id, chosen before the shuffle too: a doc_id that a third of all rows share is a few rows by then.
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "label", "fold")).alias("row")
    train = written(texts.groupBy("doc_id").agg(least).select("doc_id", "row.text", "row.label", "row.fold"), "toxic-train")
    total = train.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("n_toxic")).first()
    counts = train.select("text", "label").mapInArrow(tidy(_word_counts), "kind int, word binary, n bigint, n_toxic bigint")
    counts = counts.groupBy("kind", "word").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))
    n, t = max(total["n"], 1), total["n_toxic"]
    expected = F.col("n") * (t / n)
    told = (F.col("n_toxic") - expected) / F.sqrt(expected + 1)
    best = counts.where(F.col("n") >= LEAST_DOCUMENTS).orderBy(F.abs(told).desc(), "kind", "word").limit(VOCABULARY)
    best = best.withColumn("told", told).collect()
    hashes = np.zeros(0, np.uint64)
    for row in best:
        hashes = np.append(hashes, _salted(hash_bytes([bytes(row["word"])]), row["kind"]))
    words, first = np.unique(hashes, return_index=True)
    telling = np.array([best[i]["kind"] == 0 and best[i]["told"] > 3 and best[i]["n_toxic"] * 2 > best[i]["n"] for i in first], bool)
    found = train.select("text", "fold", "label").mapInArrow(tidy(_presence(words)), "fold int, label int, bits binary").collect()
    bits = np.zeros((0, 0), np.uint8)
    if found:
        bits = np.array([np.frombuffer(r["bits"], np.uint8) for r in found], np.uint8).reshape(len(found), -1)
    presence = np.unpackbits(bits, axis=1)[:, : len(words)] if len(words) and len(found) else np.zeros((len(found), len(words)))
    toxic = np.array([r["label"] for r in found], int)
    severe = (toxic == 1) & (presence[:, telling].sum(1) >= SEVERE_WORDS)
    folds = np.array([r["fold"] for r in found], int)
    return fit_chain(words, presence.astype(float), np.stack([toxic, severe], 1), folds)


def _score(chain: Chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = chain.probabilities(presence_of(column_of(batch, "text"), chain.words).astype(float))
            p = p.reshape(batch.num_rows, len(chain.weights))
            columns = [column_of(batch, "doc_id").cast(pa.int64()), pa.array(p[:, 0]), pa.array(p[:, 1]), pa.array(p[:, 0] >= 0.5)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "p_toxic", "p_severe", "toxic"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, p_toxic, p_severe and toxic (p_toxic of one half or more) of every document."""
    docs = docs.select("doc_id", "text")
    chain = fit(docs, labels)
    return docs.mapInArrow(tidy(_score(chain)), "doc_id bigint, p_toxic double, p_severe double, toxic boolean")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return toxicity(spread_small_scan(docs), spark.read.parquet(f"{folder}/labels.parquet"))


QUERIES = {"op8_toxicity": op8_toxicity}
ORACLE_SQL: dict[str, str] = {}

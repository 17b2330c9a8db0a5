"""Quality classifier: random Fourier features over document statistics, ridge, isotonic calibration.

Statistics of whole texts come from one scan.  Random Fourier features of the standardised statistics
approximate a Gaussian kernel.  Each partition of the labelled rows adds up its part of the normal
equations, one set a fold; Spark sums the parts and the driver solves a system whose size is the number
of features, whatever the number of rows.  Scores of the labelled rows, each from the folds it is not
in, are counted in bins, and isotonic regression over the bins turns a score into a probability.

Defined cases: a null or empty text has statistics 0 and gets a score like any other.  A label row
without document, a null label or one other than 0 and 1, and a null doc_id teach nothing.  With no
usable label every score is 0.5.  Equal documents get equal scores; further columns are left out.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.texts import (
    ALNUM,
    NOT_SPACE,
    column_of,
    per_text,
    prefix_hash,
    range_hash,
    spans,
    text_chunks,
    text_of,
    tidy,
)
from tallyweave.sources.scans import spread_small_scan
from tallyweave.storage import written

FEATURES = 256
WIDTH = 0.7  # of the Gaussian kernel, in roots of the number of statistics
RIDGE = 1e-3  # of the number of labelled rows
BINS = 512
SEED = 11
THRESHOLD = 0.3
FOLDS = 4  # the remainders 1 to 4 of the id's checksum

_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:?")] = True
_MARK = ~ALNUM & NOT_SPACE & ~_STOP
_MARK[:32] = False
_WIDE = np.zeros(256, bool)
_WIDE[0x80:] = True
STATISTICS = (
    "log_words log_bytes word_bytes upper digits stops marks wide marked_words bare_words repeated "
    "distinct upper_words lines repeated_lines longest"
).split()


def _distinct(texts: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Number of different hashes in each text."""
    keys = np.sort((texts.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return np.bincount((keys[first] >> np.uint64(40)).astype(np.int64), minlength=n)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of :data:`STATISTICS` for each text."""
    n = len(offsets) - 1
    out = np.zeros((n, len(STATISTICS)))
    size = np.diff(offsets)
    inside = NOT_SPACE[data]
    begin, end = spans(inside, offsets)
    total = prefix_hash(data)
    texts = text_of(begin, offsets)
    hashes = range_hash(total, begin, end)
    words = np.bincount(texts, minlength=n)
    some, letters = np.maximum(words, 1), np.maximum(per_text(_LETTER[data], offsets), 1)
    filled = np.maximum(size, 1)

    def share(flags: np.ndarray, of: np.ndarray = some) -> np.ndarray:
        return np.bincount(texts, weights=flags, minlength=n) / of

    alnum = np.concatenate(([0], np.cumsum(ALNUM[data])))
    upper = np.concatenate(([0], np.cumsum(_UPPER[data])))
    bare = alnum[end] == alnum[begin]
    marked = ~bare & (_MARK[data[end - 1]] if len(end) else bare)
    shouted = upper[end] - upper[begin] >= 2
    again = np.zeros(len(begin), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (texts[1:] == texts[:-1])
    out[:, 0], out[:, 1] = np.log1p(words), np.log1p(size)
    out[:, 2] = per_text(inside, offsets) / some
    out[:, 3] = per_text(_UPPER[data], offsets) / letters
    for place, table in ((4, _DIGIT), (5, _STOP), (6, _MARK), (7, _WIDE)):
        out[:, place] = per_text(table[data], offsets) / filled
    for place, flags in ((8, marked), (9, bare), (10, again), (12, shouted)):
        out[:, place] = share(flags)
    out[:, 11] = np.log1p(_distinct(texts, hashes, n)) / np.maximum(np.log1p(words), 1)
    line_begin, line_end = spans(data != 10, offsets)
    line_texts = text_of(line_begin, offsets)
    lines = np.bincount(line_texts, minlength=n)
    out[:, 13] = np.log1p(lines)
    out[:, 14] = 1 - _distinct(line_texts, range_hash(total, line_begin, line_end), n) / np.maximum(lines, 1)
    out[lines == 0, 14] = 0
    longest = np.zeros(n)
    np.maximum.at(longest, texts, end - begin)
    out[:, 15] = np.log1p(longest)
    return out


def _statistics_of(column: pa.Array) -> np.ndarray:
    parts = [statistics(data, offsets) for _, _, data, offsets in text_chunks(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = _statistics_of(column_of(batch, "text"))
        values = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1]).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id").cast(pa.int64()), values], ["doc_id", "stats"])


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every document, from one scan of the texts."""
    return docs.select("doc_id", "text").mapInArrow(tidy(_scan), "doc_id bigint, stats array<double>")


def checksum(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


@dataclass
class QualityModel:
    """What scoring needs; its size depends on the parameters alone."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None  # one column a fold left out, the last for all folds
    knots: np.ndarray | None = None
    values: np.ndarray | None = None

    def features(self, rows: np.ndarray) -> np.ndarray:
        draw = np.random.RandomState(SEED)
        k = len(self.mean)
        directions = draw.normal(size=(k, FEATURES)) / (WIDTH * np.sqrt(k))
        shift = draw.uniform(0, 2 * np.pi, FEATURES)
        x = np.clip((rows - self.mean) / self.scale, -8, 8)
        waves = np.sqrt(2 / FEATURES) * np.cos(x @ directions + shift)
        return np.hstack([np.ones((len(rows), 1)), waves])

    def raw(self, rows: np.ndarray, fold: int = FOLDS) -> np.ndarray:
        return self.features(rows) @ self.weights[:, fold]

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None or self.knots is None:
            return np.full(len(rows), 0.5)
        return np.clip(np.interp(self.raw(rows), self.knots, self.values), 0.0, 1.0)


def _stat_rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(column_of(batch, "stats").flatten().to_numpy(zero_copy_only=False)).reshape(-1, len(STATISTICS))


def _normal_parts(model: QualityModel):
    """Upper triangle of [Z y]'[Z y] of a partition's rows, a set for each fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            z = model.features(_stat_rows(batch))
            z = np.hstack([z, column_of(batch, "label").to_numpy()[:, None]])
            folds = column_of(batch, "fold").to_numpy()
            for fold in np.unique(folds):
                part = z[folds == fold]
                sums[fold] = sums.get(fold, 0) + part.T @ part
        for fold, matrix in sums.items():
            cells = matrix[np.triu_indices(len(matrix))]
            names = ["fold", "cell", "value"]
            columns = [pa.array(np.full(len(cells), fold, np.int32)), pa.array(np.arange(len(cells), dtype=np.int32))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cells)], names)

    return run


def _solve(parts: list, size: int) -> np.ndarray:
    """Ridge weights with each fold left out, then with all."""
    matrices = np.zeros((FOLDS, size, size))
    upper = np.triu_indices(size)
    for row in parts:
        matrices[row["fold"], upper[0][row["cell"]], upper[1][row["cell"]]] += row["value"]
    whole = matrices.sum(0)
    weights = []
    for left_out in [*matrices, 0 * whole]:
        m = whole - left_out
        m = m + np.triu(m, 1).T
        penalty = RIDGE * max(m[0, 0], 1) * np.eye(size - 1)
        penalty[0, 0] = 1e-9
        weights.append(np.linalg.solve(m[:-1, :-1] + penalty, m[:-1, -1]))
    return np.array(weights).T


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: centres of the pooled blocks and their means."""
    blocks: list[list[float]] = []
    for xi, yi, wi in zip(x, y, w):
        blocks.append([xi * wi, yi * wi, wi])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def _raw_scores(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _stat_rows(batch)
            z = model.features(rows) @ model.weights
            folds = column_of(batch, "fold").to_numpy()
            raw = z[np.arange(len(rows)), folds]
            bins = np.clip((raw + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), column_of(batch, "label")], ["bin", "label"])

    return run


def fit(stats: DataFrame, labels: DataFrame) -> QualityModel:
    """Learn from the labelled rows whose checksum is not 0; labels has doc_id and quality."""
    labels = labels.select("doc_id", F.col("quality").cast("double").alias("label")).where("label in (0, 1)")
    fold = checksum(F.col("doc_id"))
    train = stats.join(labels, "doc_id").withColumn("fold", (fold - 1).cast("int")).where("fold >= 0")
    train = written(train.select("stats", "label", "fold"), "quality-train")
    moments = []
    for i in range(len(STATISTICS)):
        moments += [F.avg(F.col("stats")[i]).alias(f"mean{i}"), F.stddev_pop(F.col("stats")[i]).alias(f"dev{i}")]
    row = train.agg(F.count(F.lit(1)).alias("n"), *moments).first()
    k = len(STATISTICS)
    if not row["n"]:
        return QualityModel(np.zeros(k), np.ones(k), None)
    model = QualityModel(
        np.array([row[f"mean{i}"] for i in range(k)]), np.array([max(row[f"dev{i}"], 1e-6) for i in range(k)]), None
    )
    parts = train.mapInArrow(tidy(_normal_parts(model)), "fold int, cell int, value double")
    cells = parts.groupBy("fold", "cell").agg(F.sum("value").alias("value")).collect()
    model.weights = _solve(cells, FEATURES + 2)
    bins = (
        train.mapInArrow(tidy(_raw_scores(model)), "bin int, label double")
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("label"))
        .collect()
    )
    bins = sorted(bins)
    x = np.array([(b["bin"] + 0.5) / BINS * 2 - 0.5 for b in bins])
    model.knots, model.values = isotonic(x, np.array([b["label"] for b in bins]), np.array([b["n"] for b in bins]))
    return model


def _score_stats(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.score(_stat_rows(batch)))
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), scores], ["doc_id", "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    stats = written(document_statistics(docs), "quality-statistics")
    model = fit(stats, labels)
    scored = stats.mapInArrow(tidy(_score_stats(model)), "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        (checksum(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def _accepted(model: QualityModel, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = model.score(_statistics_of(column_of(batch, "text"))) >= threshold
            yield batch.filter(pa.array(keep))

    return run


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is not rejected."""
    stats = written(document_statistics(docs), "quality-statistics")
    return docs.mapInArrow(tidy(_accepted(fit(stats, labels), threshold)), docs.schema)


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return quality_scores(spread_small_scan(docs), spark.read.parquet(f"{folder}/labels.parquet"))


QUERIES = {"op10_quality": op10_quality}
ORACLE_SQL: dict[str, str] = {}

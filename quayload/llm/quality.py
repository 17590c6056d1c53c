"""Quality classifier: regularised quadratic discriminant on document statistics.

Each text becomes a vector of transformed statistics. The sums of the vectors
and of their products, for each class, are added up over all labelled rows by
Spark; mean and covariance come from them. Each covariance is shrunk towards
the pooled one and towards its diagonal, and its Cholesky factor is computed
once and kept. A text's score is the logistic of the difference of the two log
densities, of Mahalanobis form, scaled by a factor fitted on the labelled rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.llm.common import Files, crc, documents, in_batches, only

BATCH_BYTES = 1 << 20
#: Shares of the pooled covariance and of the diagonal in each class's covariance.
POOLED, DIAGONAL = 0.05, 0.05
#: Least variance of a statistic.
FLOOR = 1e-4
#: Rows the scale of the log densities is fitted on, in expectation.
SCALE_ROWS = 20_000
THRESHOLD = 0.3

#: Byte classes that are counted.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "stop": b".,;:?'\"-()",
    "shout": b"!",
    "sign": b"#$%&*+=<>^~@\\/_",
    "bar": b"|{}[]`",
    "line": b"\n",
    "space": b" \t\x0b\x0c\r",
}
NAMES = (
    "length", "words", "word_length", *CLASSES, "wide", "distinct", "commonest", "doubled",
    "line_length", "same_lines", "short_words", "long_words", "capital_words",
)
_CLASS_OF = np.zeros(256, np.uint8)
for _number, _members in enumerate(CLASSES.values(), 1):
    _CLASS_OF[np.frombuffer(_members, np.uint8)] = _number
_CLASS_OF[0x80:] = len(CLASSES) + 1


def statistics(text: str) -> list[float]:
    """The transformed statistics of one whole text, in the order of NAMES.

    Shares go through a square root and counts through a logarithm, which
    brings both nearer to a normal distribution.
    """
    raw = text.encode("utf-8", "replace")
    size = max(len(raw), 1)
    kinds = np.bincount(_CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=len(CLASSES) + 2)
    words = text.split()
    n = max(len(words), 1)
    often = Counter(words)
    lengths = np.fromiter(map(len, words), np.int32, len(words))
    lines = [line for line in text.split("\n") if line]
    m = max(len(lines), 1)
    shares = [
        *(kinds[1:] / size),
        len(often) / n,
        (max(often.values()) if often else 0) / n,
        sum(map(eq, words, words[1:])) / n,
        float((lengths <= 2).sum()) / n,
        float((lengths >= 13).sum()) / n,
        sum(map(str.isupper, words)) / n,
        1 - len(set(lines)) / m,
    ]
    root = np.sqrt(shares).tolist()
    k = len(CLASSES) + 1
    return [
        np.log1p(size), np.log1p(len(words)), np.log1p(lengths.mean() if len(words) else 0.0),
        *root[:k], *root[k : k + 3], np.log1p(size / m), root[k + 6], root[k + 3], root[k + 4], root[k + 5],
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and ``stats`` (an array) of each row of ``docs`` (doc_id, text); null counts as empty."""
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("stats", T.ArrayType(T.DoubleType()))]
    )

    def make(table: pa.Table) -> Iterator[pa.Table]:
        texts = pc.fill_null(table["text"].cast(pa.large_string()), "").to_pylist()
        flat = np.array([statistics(text) for text in texts], np.float64).ravel()
        ends = np.arange(len(texts) + 1, dtype=np.int32) * len(NAMES)
        yield pa.table({"doc_id": table["doc_id"], "stats": pa.ListArray.from_arrays(ends, flat)})

    return only(docs, "doc_id", "text").mapInArrow(in_batches(make, BATCH_BYTES), schema)


@dataclass(frozen=True)
class Gaussian:
    mean: np.ndarray
    factor: np.ndarray
    """Inverse of the covariance's Cholesky factor."""
    constant: float

    @classmethod
    def of(cls, mean: np.ndarray, covariance: np.ndarray, prior: float) -> Gaussian:
        lower = np.linalg.cholesky(covariance)
        constant = np.log(prior) - np.log(np.diag(lower)).sum()
        return cls(mean, np.linalg.inv(lower), float(constant))

    def log_density(self, x: np.ndarray) -> np.ndarray:
        return self.constant - 0.5 * (((x - self.mean) @ self.factor.T) ** 2).sum(axis=1)


@dataclass(frozen=True)
class QualityModel:
    good: Gaussian | None
    bad: Gaussian | None
    scale: float = 1.0
    shift: float = 0.0
    alone: float = 0.5
    """The score of every text if only one class, or none, was seen."""

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.good.log_density(x) - self.bad.log_density(x)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.good is None or self.bad is None:
            return np.full(len(x), self.alone)
        return 1 / (1 + np.exp(-np.clip(self.scale * self.margin(x) + self.shift, -60, 60)))


def class_sums(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Rows, sum and sum of products of ``stats`` for each ``quality``; one row per task goes to the driver."""
    d = len(NAMES)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = np.array(batch["stats"].flatten()).reshape(-1, d)
            y = np.array(batch["quality"])
            for k in (0, 1):
                own = x[y == k]
                sums[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        flat = pa.array(sums.ravel())
        yield pa.record_batch({"sums": pa.ListArray.from_arrays(np.array([0, len(flat)], np.int32), flat)})

    parts = labelled.select("stats", "quality").mapInArrow(add_up, "sums array<double>")
    indexed = parts.select(F.posexplode("sums").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"))
    total = np.zeros(2 * (1 + d + d * d))
    for row in indexed.collect():
        total[row["at"]] = row["v"]
    total = total.reshape(2, -1)
    return {k: (total[k, 0], total[k, 1 : 1 + d], total[k, 1 + d :].reshape(d, d)) for k in (0, 1)}


def fit(sums: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> QualityModel:
    n = {k: sums[k][0] for k in (0, 1)}
    if not n[0] or not n[1]:
        return QualityModel(None, None, alone=float(n[1] / (n[0] + n[1])) if n[0] + n[1] else 0.5)
    mean = {k: sums[k][1] / n[k] for k in (0, 1)}
    own = {k: sums[k][2] / n[k] - np.outer(mean[k], mean[k]) for k in (0, 1)}
    pooled = (n[0] * own[0] + n[1] * own[1]) / (n[0] + n[1])
    found = []
    for k in (1, 0):
        mixed = (1 - POOLED) * own[k] + POOLED * pooled
        mixed = (1 - DIAGONAL) * mixed + DIAGONAL * np.diag(np.diag(mixed)) + FLOOR * np.eye(len(mixed))
        found.append(Gaussian.of(mean[k], mixed, n[k] / (n[0] + n[1])))
    return QualityModel(*found)


def rescaled(model: QualityModel, x: np.ndarray, y: np.ndarray) -> QualityModel:
    """Logistic regression of the label on the margin, by Newton's method: calibrated scores."""
    if model.good is None or len(set(y.tolist())) < 2:
        return model
    margin = model.margin(x)
    unit = max(float(np.std(margin)), 1e-9)
    design = np.column_stack([margin / unit, np.ones(len(margin))])
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        weight = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((design * weight[:, None]).T @ design + 1e-3 * np.eye(2), design.T @ (y - p) - 1e-3 * beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    if beta[0] <= 0:
        return model
    return QualityModel(model.good, model.bad, float(beta[0] / unit), float(beta[1]))


def train_quality(stats: DataFrame, labels: DataFrame, files: Files) -> QualityModel:
    """Fit on the rows of ``stats`` (doc_id, stats) that have a label of 0 or 1 in ``labels`` (doc_id, quality).

    Every label row counts; other labels and null ids are left out.
    """
    marks = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", F.col("quality").cast("int").alias("quality"))
    labelled = files.write(stats.join(marks, "doc_id"), "labelled")
    model = fit(class_sums(labelled))
    rows = labelled.count()
    grain = 1_000_000
    rate = min(grain, int(grain * SCALE_ROWS / max(rows, 1)) + 1)
    drawn = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(grain)) < rate)
    table = drawn.select("stats", "quality").toArrow()
    x = np.array(table["stats"].combine_chunks().flatten()).reshape(-1, len(NAMES))
    return rescaled(model, x, np.array(table["quality"]))


def score_quality(stats: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score of each row of ``stats``, as ``score_documents`` says."""
    shared = stats.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([stats.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch["stats"].flatten()).reshape(-1, len(NAMES))
            yield pa.record_batch({"doc_id": batch["doc_id"], "score": pa.array(shared.value.score(x), pa.float64())})

    return stats.select("doc_id", "stats").mapInArrow(make, schema)


def score_documents(docs: DataFrame, labels: DataFrame, files: Files) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): doc_id, score, predicted, learned from ``labels``.

    ``score`` is between 0 and 1, higher for better texts; ``predicted`` is 1
    from ``THRESHOLD`` on. Null texts count as empty, and empty texts are
    scored like others. If the labels hold only one class the score is 1 or 0
    for all texts, without labels 0.5. Repeated rows get equal scores; null
    doc_ids stay null and are never learned from; other columns are ignored;
    an empty table gives an empty result.
    """
    stats = files.write(with_statistics(docs), "stats")
    model = train_quality(stats, labels, files)
    return score_quality(stats, model).select("doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_rejected(docs: DataFrame, labels: DataFrame, files: Files) -> DataFrame:
    """The rows of ``docs`` that are predicted to be good, with all their columns; no row is shuffled.

    Learned from ``labels`` as in ``score_documents``.
    """
    model = train_quality(files.write(with_statistics(docs), "stats"), labels, files)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(table: pa.Table) -> Iterator[pa.Table]:
        texts = pc.fill_null(table["text"].cast(pa.large_string()), "").to_pylist()
        score = shared.value.score(np.array([statistics(text) for text in texts], np.float64).reshape(-1, len(NAMES)))
        yield table.filter(pa.array(score >= THRESHOLD))

    return docs.mapInArrow(in_batches(make, BATCH_BYTES), docs.schema)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(crc(F.col("doc_id")), F.lit(5)) == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out)
    scored = score_documents(documents(spark, sf_dir), labels, Files(spark, "quality"))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")

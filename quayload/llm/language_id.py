"""Language identification from averaged hashed subword embeddings.

A text's bytes in lower case, with everything but letters made a space, give
n-grams; each is hashed to a bucket with a small vector, and the mean of the
vectors goes through a linear softmax. Vectors and weights are trained by
stochastic gradient descent in numpy on a bounded sample. A temperature fitted
on rows kept from training calibrates the scores, and a score below the limit
found there is marked as rejected.

As the mean is linear, a trained model is one table of logits per bucket; tasks
only gather and average.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.llm.common import crc, documents, in_batches, only

BUCKETS, WIDTH, GRAMS = 1 << 16, 16, (2, 3, 4)
#: Rows the model is fitted on, in expectation; divided evenly among the languages.
SAMPLE_ROWS = 4000
#: Part of the sample kept for calibration.
CALIBRATION = 0.2
#: Share of rightly identified calibration rows that may be rejected.
REJECTED = 0.005
BATCH_BYTES = 1 << 20
UNKNOWN = "und"

#: ASCII letters in lower case, everything else in ASCII a space; other bytes stay.
LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
HAS_LETTER = regex.compile(r"\p{L}").search


def buckets(data: bytes) -> list[np.ndarray]:
    """Bucket of the n-gram that begins at each byte, for each n."""
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    out, rolled = [], raw + 1
    for n in range(2, max(GRAMS) + 1):
        m = max(0, len(raw) - n + 1)
        rolled = rolled[:m] * np.uint32(0x01000193) + raw[n - 1 :][:m] + np.uint32(1)
        if n in GRAMS:
            mixed = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            out.append((mixed >> np.uint32(16)).astype(np.uint32) & np.uint32(BUCKETS - 1))
    return out


def prepared(text: str) -> bytes:
    return b" " + text.lower().encode("utf-8", "replace").translate(LETTERS) + b" "


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    table: np.ndarray
    """Logits of each bucket, BUCKETS x languages."""
    temperature: float
    reject_below: float

    def logits(self, texts: list[str]) -> np.ndarray:
        parts = [prepared(text) for text in texts]
        ends = np.cumsum([0, *map(len, parts)])
        total = np.zeros((len(texts), len(self.languages)))
        count = np.zeros(len(texts))
        for n, found in zip(GRAMS, buckets(b"".join(parts)), strict=True):
            # n-grams that run into the next text are left out
            first, last = ends[:-1], np.maximum(ends[1:] - n + 1, ends[:-1])
            whole = last > first
            if not whole.any():
                continue
            sums = np.add.reduceat(self.table[found], np.column_stack([first, np.minimum(last, len(found) - 1)])[whole].ravel(), axis=0, dtype=np.float64)[::2]
            edge = last[whole] == len(found)
            sums[edge] += self.table[found[-1]]
            total[whole] += sums
            count += last - first
        return total / np.maximum(count, 1)[:, None]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is rejected; ``und`` with score 0 for texts without a letter."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        scores = _softmax(self.logits(texts) / self.temperature)
        best = scores.argmax(axis=1)
        top = scores[np.arange(len(texts)), best]
        none = np.array([HAS_LETTER(text) is None for text in texts], bool)
        top = np.where(none, 0.0, top)
        names = [UNKNOWN if n else self.languages[b] for n, b in zip(none, best, strict=True)]
        return names, top, none | (top < self.reject_below)


def _softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def fit(texts: list[str], languages: list[str], epochs: int = 5, rate: float = 0.5, seed: int = 3) -> LanguageModel:
    """Train on texts with their languages; without any row the model knows no language."""
    names = tuple(sorted(set(languages)))
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1, 1, (BUCKETS, WIDTH)).astype(np.float32) / WIDTH
    weights = np.zeros((WIDTH, len(names)), np.float32)
    rows = []
    for text, language in zip(texts, languages, strict=True):
        found, times = np.unique(np.concatenate(buckets(prepared(text))), return_counts=True)
        if len(found):
            rows.append((found, (times / times.sum()).astype(np.float32), names.index(language)))
    order = random.permutation(len(rows))
    cut = int(len(rows) * CALIBRATION)
    held, train = order[:cut], order[cut:]
    steps, step = max(1, epochs * len(train)), 0
    for _ in range(epochs):
        for i in random.permutation(train):
            found, share, right = rows[i]
            mean = share @ vectors[found]
            error = _softmax((mean @ weights)[None])[0]
            error[right] -= 1
            pace = np.float32(rate * (1 - step / steps))
            back = weights @ error
            weights -= pace * np.outer(mean, error)
            vectors[found] -= (pace * len(names) * 20) * share[:, None] * back[None]
            step += 1
    table = (vectors @ weights).astype(np.float32)
    logits = np.array([rows[i][1] @ table[rows[i][0]] for i in held]).reshape(len(held), len(names))
    truth = np.array([rows[i][2] for i in held], int)
    temperature, limit = calibrate(logits, truth)
    return LanguageModel(names, table, temperature, limit)


def calibrate(logits: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Temperature of least log loss, and the score that all but few right rows reach."""
    if not len(truth):
        return 1.0, 0.0
    at = np.arange(len(truth))
    tried = np.geomspace(0.02, 20, 61)
    losses = [-np.log(np.maximum(_softmax(logits / t)[at, truth], 1e-12)).mean() for t in tried]
    temperature = float(tried[int(np.argmin(losses))])
    scores = _softmax(logits / temperature)
    right = scores.argmax(axis=1) == truth
    top = scores.max(axis=1)[right]
    return temperature, float(np.quantile(top, REJECTED)) if len(top) else 0.0


def train_language_model(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Fit on a sample of ``rows`` (doc_id, text, lang) with both text and lang, about ``sample_rows`` of them.

    Rows are drawn by a hash of doc_id, equally many for each language as far
    as it has them, so the same table always gives the same model.
    """
    known = only(rows, "doc_id", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return fit([], [])
    grain = 1_000_000
    each = sample_rows / len(counts)
    pairs = [F.lit(x) for lang, n in counts.items() for x in (lang, min(grain, int(grain * each / n) + 1))]
    drawn = known.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(11)), F.lit(grain)) < F.create_map(*pairs)[F.col("lang")])
    table = drawn.select("text", "lang", "doc_id").toArrow().sort_by([("doc_id", "ascending")])
    return fit(table["text"].to_pylist(), table["lang"].to_pylist())


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): doc_id, lang_pred, score, rejected.

    ``lang_pred`` is the likeliest learned language, or ``und`` with score 0 if
    the text is null, empty or without a letter, or nothing was learned.
    ``rejected`` marks scores below the calibrated limit; it is true for
    ``und``. Texts of any length count whole. Repeated rows get equal results,
    null doc_ids stay null, other columns are ignored, and an empty table gives
    an empty result. Ties go to the language first in alphabetical order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )

    def make(table: pa.Table) -> Iterator[pa.Table]:
        texts = pc.fill_null(table["text"].cast(pa.large_string()), "").to_pylist()
        names, scores, rejected = shared.value.predict(texts)
        yield pa.table(
            {
                "doc_id": table["doc_id"],
                "lang_pred": pa.array(names, pa.string()),
                "score": pa.array(scores, pa.float64()),
                "rejected": pa.array(rejected, pa.bool_()),
            }
        )

    return only(docs, "doc_id", "text").mapInArrow(in_batches(make, BATCH_BYTES), schema)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.pmod(crc(F.col("doc_id")), F.lit(4)) == 2
    model = train_language_model(docs.where(~held_out))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")

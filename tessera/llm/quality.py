"""Quality classifier by compression (operator 1).

Two zstandard dictionaries are trained, one from good and one from bad labelled text.  A text is cut into blocks,
every block is compressed with either dictionary, and the difference of the total compressed sizes over the text's
length (positive: the good dictionary fits better) becomes a probability by logistic calibration on labelled rows
that did not go into the dictionaries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import columns, excerpt, fold, table, utf8

#: The fit's bound: so many labelled rows of either class (lowest hash of the id first), of each an excerpt of FIT_CHARS.
FIT_ROWS, FIT_CHARS = 1500, 40_000
DICT_BYTES, BLOCK, LEVEL = 112_640, 512, 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float


class Meter:
    """Normalised difference of compressed sizes."""

    def __init__(self, good: bytes, bad: bytes):
        self._z = [zstandard.ZstdCompressor(level=LEVEL, dict_data=self._ready(d), write_content_size=False,
                                            write_checksum=False, write_dict_id=False) for d in (good, bad)]

    @staticmethod
    def _ready(raw: bytes) -> zstandard.ZstdCompressionDict:
        d = zstandard.ZstdCompressionDict(raw)
        d.precompute_compress(level=LEVEL)
        return d

    def __call__(self, text: bytes) -> float:
        if not text:
            return 0.0
        good, bad = (sum(len(z.compress(text[i:i + BLOCK])) for i in range(0, len(text), BLOCK)) for z in self._z)
        return (bad - good) / (len(text) + 16)


def _dictionary(texts: list[bytes]) -> bytes:
    samples = [t[i:i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:                                                     # too little text for training
        return b"".join(samples)[-DICT_BYTES:] or b" " * 8


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
    a = np.stack([x, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + ridge * w
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        w -= np.linalg.solve(h, g)
    return float(w[0]), float(w[1])


def fit(rows: list[tuple[bytes, int]]) -> Model:
    """Fit from (text, label) rows: two thirds make the dictionaries, the rest the calibration.

    Without rows of both classes there is nothing to tell apart: every score is the share of label 1 (0.5 if no rows).
    """
    texts = {k: [t for t, y in rows if y == k and t] for k in (0, 1)}
    if not texts[0] or not texts[1]:
        p = (len(texts[1]) + 1) / (len(texts[0]) + len(texts[1]) + 2)
        return Model(b" " * 8, b" " * 8, 0.0, float(np.log(p / (1 - p))))
    held = {k: v[2::3] or v for k, v in texts.items()}
    used = {k: [t for i, t in enumerate(v) if i % 3 != 2] or v for k, v in texts.items()}
    size = min(sum(map(len, v)) for v in used.values())                             # as much text for either dictionary
    for k, v in used.items():
        ends = np.cumsum([len(t) for t in v])
        used[k] = v[:max(1, int(np.searchsorted(ends, size, "right")))]
    good, bad = _dictionary(used[1]), _dictionary(used[0])
    meter = Meter(good, bad)
    x = np.array([meter(t) for k in (0, 1) for t in held[k]])
    y = np.array([float(k) for k in (0, 1) for _ in held[k]])
    weights = {k: len(y) / 2 / len(held[k]) for k in (0, 1)}                        # rare classes count as much
    scale = max(float(np.abs(x).std()), 1e-6)
    rep = np.repeat(np.arange(len(y)), [max(1, round(weights[int(k)])) for k in y])
    slope, offset = _logistic(x[rep] / scale, y[rep])
    return Model(good, bad, slope / scale, offset)


def training_rows(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, fit_chars: int = FIT_CHARS) -> list:
    """A bounded sample of (text, label): ``fit_rows`` of each class by the hash of the id, fold 1 held out.

    ``docs`` has id and text, ``labels`` has id and label.  Rows without id, text or a label of 0 or 1 are left out.
    """
    usable = labels.where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & (fold(F.col("id")) != 1))
    one = usable.groupBy("id").agg(F.min("label").alias("label"))
    order = [F.xxhash64("id"), F.col("id")]
    chosen = None
    for k in (0, 1):
        part = one.where(F.col("label") == k).orderBy(*order).limit(2 * fit_rows)  # spare ids: some have no texts
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = (docs.where(F.col("text").isNotNull()).select("id", excerpt("text", fit_chars).alias("text"))
             .join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text")))
    rows = texts.orderBy(*order).collect()                                          # at most 4 * fit_rows rows of fit_chars
    return [(r["text"].encode(), r["label"]) for k in (0, 1) for r in [r for r in rows if r["label"] == k][:fit_rows]]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(id, text) to (id, score): every whole text by its own, without any exchange; null counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meter = Meter(model.good, model.bad)
        for b in batches:
            x = np.array([meter(t) for t in utf8(b.column(1))])
            p = 1 / (1 + np.exp(-np.clip(model.slope * x + model.offset, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64())], ["id", "score"])

    return docs.select("id", "text").mapInArrow(run, "id bigint, score double")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document: doc_id, held_out, score, predicted.

    Null and empty texts get the calibrated score of a difference of zero.  Repeated rows are scored each.  A null id
    stays null and is not held out.  Empty tables give no rows; without labels every score is 0.5.
    """
    docs = columns(table(spark, sf_dir, "documents", "doc_id", "text"), id="doc_id", text="text")
    labels = columns(table(spark, sf_dir, "labels", "doc_id", "quality"), id="doc_id", label="quality")
    scored = score(docs, fit(training_rows(docs, labels)))
    return scored.select(F.col("id").alias("doc_id"), F.coalesce(fold(F.col("id")) == 1, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

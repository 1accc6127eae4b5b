"""Quality by naive Bayes support vectors.

A text's features are indicators of hashed n-grams: its byte trigrams, and how
much of it repeats the words 1 to 8 places before, by twentieths. Each indicator
is scaled by its log-count ratio between the labels, rows are brought to length
1, and a linear hinge-loss model is fitted on them by dual coordinate descent.
The sample it is fitted on is bounded (`LABELLED` documents of each label); all
documents are scored, whole.

NULL and empty texts have no features and get the score of the model's offset.
With labels of one kind only, or none, the score is that label, or 0.5. Repeated
rows are scored one by one; extra columns are passed on, and columns named like
an output are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from assayer.llm import common, labelled

BITS = 18
LAGS, SHARES = 8, 20
LABELLED = 4000
COST, EPOCHS = 1.0, 8
# Smoothing of the counts behind the ratios.
SMOOTH = 1.0

_SPREAD = np.uint32(2_654_435_761)


def _places(keys: np.ndarray) -> np.ndarray:
    return (keys * _SPREAD) >> np.uint32(32 - BITS)


def features(text: str | None) -> np.ndarray:
    """Sorted distinct features of a text."""
    raw = np.frombuffer((text or "").encode(), np.uint8).astype(np.uint32)
    parts = []
    if len(raw) >= 3:
        grams = raw[:-2] | raw[1:-1] << np.uint32(8) | raw[2:] << np.uint32(16)
        parts.append(_places(np.unique(grams)))
    words = (text or "").split()
    if len(words) > 1:
        codes: dict[str, int] = {}
        ids = np.array([codes.setdefault(w, len(codes)) for w in words])
        lags = range(1, min(LAGS, len(ids) - 1) + 1)
        same = [int(SHARES * (ids[lag:] == ids[:-lag]).mean()) for lag in lags]
        marks = [(1 << 24) + lag * (SHARES + 1) + s for lag, s in zip(lags, same, strict=True)]
        parts.append(_places(np.array(marks, np.uint32)))
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint32)


class Model:
    """Weights of the features, by which a document's margin is a ratio of two sums."""

    def __init__(self, rows: list[np.ndarray], labels: np.ndarray) -> None:
        size, positive = 1 << BITS, labels == 1
        self.constant = float(labels.mean()) if len(labels) else 0.5
        self.fitted = 0 < positive.sum() < len(labels)
        if not self.fitted:
            return
        counts = np.full((2, size), SMOOTH)
        for row, label in zip(rows, labels, strict=True):
            counts[label][row] += 1
        totals = np.array([(~positive).sum(), positive.sum()]) + 2 * SMOOTH
        self.ratio = np.log(counts[1] / totals[1]) - np.log(counts[0] / totals[0])
        scaled = [(row, self.ratio[row] / self._length(row)) for row in rows]
        signs = np.where(positive, 1.0, -1.0)
        weights, self.offset = labelled.linear_hinge(
            scaled, signs, size, labelled.even_cost(signs, COST), EPOCHS
        )
        self.weighted = (weights * self.ratio).astype(np.float32)
        self.ratio = self.ratio.astype(np.float32)

    def _length(self, row: np.ndarray) -> float:
        return float(np.sqrt(np.square(self.ratio[row]).sum() + 1))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.fitted:
            return np.full(len(texts), self.constant)
        margins = []
        for text in texts:
            row = features(text)
            margins.append(float(self.weighted[row].sum()) / self._length(row) + self.offset)
        return labelled.probability(np.array(margins))


def fit(docs: DataFrame, labels: DataFrame, label: str, learn: Column, limit: int = LABELLED) -> Model:
    """A model of a label, from at most `limit` documents of each kind."""
    common.prepare(docs.sparkSession)
    chosen = labelled.sample(docs, labels, label, learn, limit)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from assayer.llm.quality import features

        for batch in batches:
            rows = [features(t).tobytes() for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), pa.array(rows, pa.binary()), batch.column("label")]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "label"])

    kind = chosen.schema["doc_id"].dataType.simpleString()
    found = chosen.mapInArrow(extract, f"doc_id {kind}, row binary, label int").collect()
    found = sorted(found, key=lambda r: (r["doc_id"], r["row"]))
    rows = [np.frombuffer(r["row"], np.uint32) for r in found]
    return Model(rows, np.array([r["label"] for r in found], int))


def score(docs: DataFrame, model, text: str = "text", name: str = "score") -> DataFrame:
    """All rows with the score of their text."""
    spark = common.prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    schema = common.with_columns(docs, [T.StructField(name, T.DoubleType())])
    kept = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, text):
                found = shared.value.scores(part.column(text).to_pylist())
                columns = [*(part.column(c) for c in kept), pa.array(found, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, name])

    return docs.mapInArrow(run, schema)

"""Toxicity by a support vector machine on a string kernel with Nyström landmarks.

The kernel compares words by their gapped subsequences (`string_kernel`), so
insults with other characters in between or a letter too many still resemble the
plain ones. Landmarks are words of the labelled texts: those that speak for
toxicity, and the harmless words most like them. A word speaks for toxicity by its
own evidence (a binomial test with false-discovery control), however rare it is
beside others; of these words the next landmark is the one that explains most toxic
documents reached by the fewest landmarks so far, so that rare languages have theirs. A text is the sentence of its
distinct words: for each landmark it has the largest kernel of any of its words,
and the sum of the three largest, as insults seldom come alone. These values go through the inverse square root of the landmarks' own kernel
matrix, as the Nyström method has it, to a linear hinge-loss model.

A word counts only if it reaches the kernel's floor with a landmark that speaks
for toxicity. The labelled sample is bounded (`LABELLED` documents of each
label); all documents are scored, whole.

NULL and empty texts have no words and get the score of the model's offset. With
labels of one kind only, or none, the score is that label, or 0.5. Repeated rows
are scored one by one; extra columns are passed on.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from assayer.llm import common, labelled
from assayer.llm.string_kernel import Landmarks, gram

LABELLED = 2000
# Landmarks of both kinds, the words they are chosen from, and how unlike they are.
TOXIC, HARMLESS, CHOICE, ALIKE = 64, 32, 1500, 0.7
LEAST_DOCUMENTS = 3
# Share of false discoveries among words for toxicity; kernels that are summed.
FALSE_SHARE, TOP = 0.05, 3
COST, EPOCHS = 10.0, 100


def words(text: str | None) -> list[str]:
    """The distinct words of a text in lower case."""
    return sorted(set((text or "").lower().split()))


def _unlike(choice: list[str], number: int) -> list[str]:
    """The first words of a list that do not resemble an earlier one too much."""
    near, taken = gram(choice, choice), []
    for i in range(len(choice)):
        if len(taken) == number:
            break
        if not taken or near[i, taken].max() < ALIKE:
            taken.append(i)
    return [choice[i] for i in taken]


def _chance(n: int, size: int, share: float) -> float:
    """The chance that of `size` documents `n` or more are toxic."""
    terms = [
        math.lgamma(size + 1) - math.lgamma(k + 1) - math.lgamma(size - k + 1)
        + k * math.log(share) + (size - k) * math.log1p(-share)
        for k in range(n, size + 1)
    ]
    return math.fsum(map(math.exp, terms))


def _covering(choice: list[str], weight: np.ndarray, documents: list[list[str]], number: int) -> list[str]:
    """Words chosen one by one by the documents they explain, each document counting
    less the more words explain it; none resembles an earlier one too much."""
    at = {w: i for i, w in enumerate(choice)}
    holds = np.zeros((len(documents), len(choice)), np.float32)
    for row, own in zip(holds, documents, strict=True):
        row[[at[w] for w in own if w in at]] = 1
    near = gram(choice, choice)
    reached = (holds @ (near >= ALIKE)) > 0
    times, free, taken = np.zeros(len(documents)), np.ones(len(choice), bool), []
    while free.any() and len(taken) < number:
        gain = np.where(free, ((0.5**times) @ reached) * weight, -1.0)
        best = int(gain.argmax())
        taken.append(choice[best])
        times += reached[:, best]
        free &= near[:, best] < ALIKE
        free[best] = False
    return taken


def _pooled(near: Landmarks, documents: list[list[str]]) -> np.ndarray:
    """The largest kernel of any word of a document with each landmark, and the
    sum of the largest `TOP`, for each document."""
    size = len(near.words)
    found = np.zeros((len(documents), 2 * size), np.float32)
    every = sorted(set().union(*documents))
    at, kernels = near.kernels(every)
    row = {every[a]: k for k, a in enumerate(at.tolist())}
    for i, own in enumerate(documents):
        rows = [row[w] for w in own if w in row]
        if rows:
            values = kernels[rows]
            found[i, :size] = values.max(axis=0)
            if len(rows) > TOP:
                values = np.partition(values, len(rows) - TOP, axis=0)[-TOP:]
            found[i, size:] = values.sum(axis=0)
    return found


def landmarks(documents: list[list[str]], labels: np.ndarray) -> tuple[list[str], list[str]]:
    """Words that speak for label 1, and words of label 0 that resemble them."""
    counts = (Counter(), Counter())
    for own, label in zip(documents, labels, strict=True):
        counts[label].update(own)
    total = np.bincount(labels, minlength=2)
    weight = {
        w: n * np.log((n + 0.5) * total[0] / (total[1] * (counts[0][w] + 0.5)))
        for w, n in counts[1].items()
        if n >= min(LEAST_DOCUMENTS, total[1]) and len(w) > 2
    }
    share = total[1] / total.sum()
    chance = {w: _chance(counts[1][w], counts[0][w] + counts[1][w], share) for w, v in weight.items() if v > 0}
    order = sorted(chance, key=lambda w: (chance[w], -weight[w], w))
    # Words that are too rare to speak for anything are tried too.
    tried = len(weight)
    sure = max((k for k, w in enumerate(order, 1) if chance[w] <= FALSE_SHARE * k / tried), default=0)
    choice = order[:sure][:CHOICE]
    ratio = np.array([weight[w] / counts[1][w] for w in choice])
    own = [d for d, label in zip(documents, labels, strict=True) if label == 1]
    toxic = _covering(choice, ratio, own, TOXIC) if choice else []
    if not toxic:
        return [], []
    others = sorted(w for w, n in counts[0].items() if counts[1][w] * total[0] < n * total[1])
    at, near = Landmarks(toxic, len(toxic)).kernels(others)
    order = sorted(range(len(at)), key=lambda k: (-near[k].max(), others[at[k]]))
    return toxic, _unlike([others[at[k]] for k in order][:CHOICE], HARMLESS)


class Model:
    """Landmarks, and the weight of a text's kernels with each."""

    def __init__(self, texts: list[str | None], labels: np.ndarray) -> None:
        self.constant = float(labels.mean()) if len(labels) else 0.5
        documents = [words(t) for t in texts]
        toxic, harmless = landmarks(documents, labels) if 0 < labels.sum() < len(labels) else ([], [])
        self.fitted = bool(toxic)
        if not self.fitted:
            return
        self.landmarks = Landmarks(toxic + harmless, len(toxic))
        values, vectors = np.linalg.eigh(gram(toxic + harmless, toxic + harmless))
        root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
        root = np.kron(np.eye(2), root)
        mapped = _pooled(self.landmarks, documents) @ root
        every, signs = np.arange(mapped.shape[1]), np.where(labels == 1, 1.0, -1.0)
        weights, self.offset = labelled.linear_hinge(
            [(every, row) for row in mapped],
            signs,
            len(every),
            np.full(len(signs), COST),
            EPOCHS,
        )
        self.weights = root @ weights

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.fitted:
            return np.full(len(texts), self.constant)
        margins = _pooled(self.landmarks, [words(t) for t in texts]) @ self.weights + self.offset
        return labelled.probability(margins)


def fit(docs: DataFrame, labels: DataFrame, label: str, learn: Column, limit: int = LABELLED) -> Model:
    """A model of a label, from at most `limit` documents of each kind."""
    common.prepare(docs.sparkSession)
    chosen = labelled.sample(docs, labels, label, learn, limit)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from assayer.llm.toxicity import words

        for batch in batches:
            rows = [" ".join(words(t)) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), pa.array(rows), batch.column("label")]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "label"])

    kind = chosen.schema["doc_id"].dataType.simpleString()
    found = chosen.mapInArrow(extract, f"doc_id {kind}, text string, label int").collect()
    found = sorted(found, key=lambda r: (r["doc_id"], r["text"]))
    return Model([r["text"] for r in found], np.array([r["label"] for r in found], int))

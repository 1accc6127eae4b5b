"""Labelled documents for fitting, and folds that are held out."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document by its id as text; a row without an id is in fold 0 of ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learn: Column,
    limit: int,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """At most `limit` labelled documents (doc_id, text, label) of each label, 0 and 1.

    Only rows for which `learn` holds are taken, those of the smallest hash of
    their id first. The sample is small, so it is joined by broadcast.
    """
    known = labels.filter(learn & F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    known = known.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.distinct()
    taken = [
        known.filter(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
        for v in (0, 1)
    ]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.join(F.broadcast(taken[0].unionByName(taken[1])), "doc_id")


def linear_hinge(
    rows: list[tuple[np.ndarray, np.ndarray]],
    signs: np.ndarray,
    size: int,
    cost: np.ndarray,
    epochs: int,
    seed: int = 0,
) -> tuple[np.ndarray, float]:
    """Weights and offset of a linear hinge-loss model by dual coordinate descent.

    Rows are sparse: positions and values. Each step sets one row's dual variable,
    between 0 and its cost, to its best value while the others stand still.
    """
    weights, offset = np.zeros(size), 0.0
    dual = np.zeros(len(rows))
    squares = [float(v @ v) + 1.0 for _, v in rows]
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in random.permutation(len(rows)):
            at, values = rows[k]
            margin = signs[k] * (weights[at] @ values + offset)
            better = min(max(dual[k] + (1 - margin) / squares[k], 0.0), cost[k])
            step = (better - dual[k]) * signs[k]
            if step:
                weights[at] += step * values
                offset += step
                dual[k] = better
    return weights, offset


def even_cost(signs: np.ndarray, cost: float) -> np.ndarray:
    """A cost for each row so that both labels weigh the same."""
    positive = signs > 0
    share = np.where(positive, positive.sum(), (~positive).sum())
    return cost * len(signs) / (2 * np.maximum(share, 1))


def probability(margin: np.ndarray, slope: float = 3.0) -> np.ndarray:
    """Margins as scores from 0 to 1; a margin of 1 gives 0.95."""
    return 1 / (1 + np.exp(-slope * np.clip(margin, -50, 50)))

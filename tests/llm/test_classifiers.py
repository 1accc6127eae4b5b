"""Held-out accuracy, kernels by their definition, and odd documents."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayer.llm import quality, queries, string_kernel, toxicity

SF = "/root/testdata/sf0.1"


def accuracy(spark, query, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    rows = query(spark, SF).join(labels.filter("y IS NOT NULL"), "doc_id").filter("held_out").collect()
    return np.mean([r.predicted == r.y for r in rows])


def test_quality_on_held_out_documents(spark):
    assert accuracy(spark, queries.op8, "quality") >= 0.97


def test_toxicity_on_held_out_documents(spark):
    assert accuracy(spark, queries.op5, "toxic") >= 0.93


def kernel(one, two):
    def features(word):
        row = [string_kernel.FRONT, *string_kernel.symbols([word])[0][1 : len(word) + 1]]
        found = {}
        for a, b, c in combinations(range(len(row)), 3):
            if c - a < string_kernel.SPAN and row[a] and row[b] and row[c]:
                key = (row[a], row[b], row[c])
                found[key] = found.get(key, 0) + string_kernel.DECAY ** (c - a + 1)
        return found

    x, y = features(one), features(two)
    dot = lambda p, q: sum(v * q.get(k, 0) for k, v in p.items())
    return dot(x, y) / np.sqrt(dot(x, x) * dot(y, y))


def test_kernel_by_definition():
    words = ["idiot", "id-iot", "idioot", "banana", "naïveté", "bananabananabanana"]
    found = string_kernel.gram(words, words)
    want = [[kernel(a, b) for b in words] for a in words]
    assert np.allclose(found, want, atol=1e-5)
    marks = string_kernel.Landmarks(["idiot", "banana"], 2)
    at, near = marks.kernels([*words, "x", "xyzzy"])
    full = string_kernel.gram([*words, "x", "xyzzy"], ["idiot", "banana"])
    full[np.nan_to_num(full) < string_kernel.FLOOR] = 0
    assert at.tolist() == np.flatnonzero(np.nan_to_num(full).any(axis=1)).tolist()
    assert np.allclose(near, full[at], atol=1e-5)


def test_inserted_characters_score_high():
    source = np.random.default_rng(0)
    plain = lambda: [f"w{source.integers(10**5)}ord" for _ in range(20)]
    texts = [" ".join([*plain(), *(["idiot", "moron"] if i % 2 else [])]) for i in range(200)]
    model = toxicity.Model(texts, np.arange(200) % 2)
    scores = model.scores(["you idiot moron", "you i-d-iot mor.on", "you idioot moronn", "a b c"])
    assert (scores[:3] >= 0.3).all() and scores[3] < 0.3


def test_rare_words_of_their_own_evidence_are_landmarks():
    source = np.random.default_rng(1)
    texts = [" ".join(f"w{source.integers(10**5)}ord" for _ in range(10)) for _ in range(1200)]
    texts[:200] = [f"{t} disgusting" for t in texts[:200]]
    texts[200:208] = [f"{t} bocoos" for t in texts[200:208]]
    labels = (np.arange(1200) < 208).astype(int)
    toxic, _ = toxicity.landmarks([toxicity.words(t) for t in texts], labels)
    assert {"disgusting", "bocoos"} <= set(toxic)
    scores = toxicity.Model(texts, labels).scores(["x bocoos", "x y"])
    assert scores[0] >= 0.3 > scores[1]


@pytest.mark.parametrize("kind", [quality, toxicity])
def test_odd_documents_and_labels(spark, odd_docs, no_docs, kind):
    schema = "doc_id long, y int"
    labels = spark.createDataFrame([(1, 1), (2, 1), (6, 0), (7, 0), (None, 1), (8, None), (99, 1)], schema)
    model = kind.fit(odd_docs, labels, "y", F.lit(True))
    rows = quality.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1
    one_kind = kind.fit(odd_docs, labels.filter("y = 1"), "y", F.lit(True))
    assert {r.score for r in quality.score(odd_docs, one_kind).collect()} == {1.0}
    none = kind.fit(no_docs, labels, "y", F.lit(True))
    assert {r.score for r in quality.score(odd_docs, none).collect()} == {0.5}

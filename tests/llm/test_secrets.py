"""Spans against regular expressions, and random strings among words."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from assayer.llm import queries, secret_scan

ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def fixed(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)):
        found += [
            (m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least
        ]
    return sorted(found)


def texts():
    source, letters = random.Random(4), "abcdef0189AKIZ _.='\":-tokensecret"
    made = ["".join(source.choices(letters, k=source.randint(0, 90))) for _ in range(300)]
    words = ["token", "token=", "secret: ", "api_key ", "API-KEY", "ApiKey:", "'", "abc", "abcdef", "=", " ", "password"]
    made += ["".join(source.choices(words, k=source.randint(0, 12))) for _ in range(500)]
    made += ["😀 AKIA" + "A" * 15, "AKIA" + "A" * 16, "f" * 23, "f" * 24 + " " + "0a" * 20, "secret: token: abcdefgh"]
    return made


def test_fixed_spans(spark):
    rows = list(enumerate(texts()))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    spans = frame.select("text", secret_scan.fixed_spans(F.col("text")).alias("s")).collect()
    for text, found in spans:
        assert [tuple(s) for s in found] == fixed(text), text


def test_random_strings_among_words(spark, docs):
    source = random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(source.choices(letters, k=44)) for _ in range(40)]
    plain = ["https://example.com/some/very-long-path_name2020/and-more", "order-2024-01-05-shipment-17"]
    rows = [(10_000 + i, f"here {k} there") for i, k in enumerate(keys + plain)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.unionByName(docs.select("doc_id", "text"))
    found = secret_scan.scan(frame).filter("doc_id >= 10000").orderBy("doc_id").collect()
    hits = [[tuple(s) for s in r.spans] for r in found]
    assert sum(h == [(5, 3, 49)] for h in hits[:40]) >= 36
    assert hits[40:] == [[], []]


def identifier(source):
    """A name of 20 characters or more, of words, numbers and separators."""
    words = "order item shipment invoice customer report backup image Version Final data draft status number".split()
    mark, parts = source.choice(["-", "_", ""]), []
    while len(mark.join(parts)) < 20 or not parts[-1].isdigit():
        number = f"{source.randint(0, 9999):04}"
        parts.append(number if parts and source.random() < 0.4 else source.choice(words))
        if not mark:
            parts[-1] = parts[-1].capitalize()
    name = mark.join(parts)
    return name.upper() if source.random() < 0.2 else name


@pytest.mark.parametrize("ordinary", [0, 2000])
def test_recall_by_encoding_and_length(spark, ordinary):
    source, each, rows, where = random.Random(7), 50, [], {}
    for number, (_, letters) in enumerate(secret_scan.ALPHABETS):
        for size in (20, 32, 64):
            if number or size == 20:  # longer ones are fixed patterns
                for _ in range(each):
                    where[len(rows)] = (number, size)
                    rows.append((len(rows), "see " + "".join(source.choices(letters, k=size)) + " there"))
    keys = len(rows)
    rows += [(keys + i, f"see {identifier(source)} there") for i in range(ordinary)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id for r in secret_scan.scan(frame).collect() if r.spans}
    recall = Counter(where[i] for i in found if i < keys)
    assert {k: recall[k] for k in set(where.values()) if recall[k] < 0.8 * each} == {}
    assert sum(i >= keys for i in found) <= 0.01 * len(found)


def test_odd_documents(odd_docs, no_docs):
    rows = secret_scan.scan(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.spans == [] for r in rows)
    assert secret_scan.scan(no_docs).count() == 0


def test_redaction(spark):
    frame = spark.createDataFrame([("a token=abcdef1 b " + "0f" * 12,), ("x",), (None,)], "text string")
    found = secret_scan.scan(frame)
    texts = [r[0] for r in found.select(secret_scan.redacted(F.col("text"), F.col("spans"))).collect()]
    assert texts == ["a [secret] b [secret]", "x", None]


def test_counts_of_the_query(spark, tmp_path):
    # Spans whose kind is not their place among the spans, and the other way round.
    made = ["AKIA" + "A" * 16, "f" * 24, "token=abcdef " * 3, "f" * 24 + " AKIA" + "A" * 16 + " token=abcdef", "", None]
    rows = list(enumerate(made + texts()))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op7(spark, str(tmp_path)).collect()}
    for i, text in rows:
        spans, r = fixed(text or ""), found[i]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)], text
        joined = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), text

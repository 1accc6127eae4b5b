"""Repeated passages against comparing all strings of 50 bytes, and suffix sorting."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assayer.llm import queries, suffix_dedup
from assayer.llm.suffix_array import equal_to_previous, suffix_order


@pytest.mark.parametrize("letters", [1, 2, 4, 200])
def test_suffixes_are_sorted(letters):
    source = random.Random(letters)
    for _ in range(400):
        text = np.array([source.randint(1, letters) for _ in range(source.randint(0, 90))], np.int64)
        want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert suffix_order(text, 1000).tolist() == want
        depth = source.randint(1, 20)
        prefixes = [text[i : i + depth].tolist() for i in suffix_order(text, depth)]
        assert prefixes == sorted(prefixes)


def test_long_names_are_sorted_too():
    text = np.random.default_rng(1).integers(1, 1 << 40, 5000)
    order = suffix_order(text, 50)
    assert order.tolist() == np.argsort(text).tolist()


def test_prefixes_are_compared_in_full():
    data = np.frombuffer(b"a" * 60 + b"b" + b"a" * 60 + b"c", np.uint8)
    places = np.array([0, 10, 11, 61, 72])
    assert equal_to_previous(data, places, 50).tolist() == [False, True, False, False, False]


def test_minimizers_are_the_smallest_hash_of_the_parts():
    data = np.frombuffer(random.Random(2).randbytes(300), np.uint8)
    parts = suffix_dedup.minimizers(data, 20, 20)
    want = [parts[i : i + 31].min() for i in range(251)]
    assert suffix_dedup.minimizers(data, 50, 20).tolist() == want
    assert (suffix_dedup.minimizers(np.concatenate([data[7:], data]), 50, 20)[:244] == want[7:]).all()


def expected(rows):
    """Spans to remove and bytes to keep, all strings of 50 bytes in a table."""
    least = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, text in texts:
        if i is not None:
            for p in range(len(text) - 49):
                s = text[p : p + 50]
                least[s] = min(least.get(s, i), i)
    found = []
    for i, text in texts:
        gone = bytearray(len(text))
        for p in range(len(text) - 49):
            if i is not None and least[text[p : p + 50]] < i:
                gone[p : p + 50] = b"\x01" * 50
        spans, last = 0, 0
        for g in gone:
            spans, last = spans + (g and not last), g
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        found.append((i, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return collections.Counter(found)


def run(spark, tmp_path, frame):
    frame.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op13(spark, str(tmp_path)).collect()
    return collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


def cases():
    source = random.Random(3)
    words = ["".join(source.choices("abcdefé", k=source.randint(1, 9))) for _ in range(60)]
    passages = [" ".join(source.choices(words, k=source.randint(5, 60))) for _ in range(25)]
    rows = []
    for i in range(240):
        parts = source.choices(passages, k=source.randint(1, 4))
        parts += [" ".join(source.choices(words, k=source.randint(1, 30))) for _ in range(3)]
        source.shuffle(parts)
        text = " ".join(parts)
        if source.random() < 0.4:
            at = source.randrange(len(text))
            text = text[:at] + source.choice("xyz") + text[at + 1 :]
        rows.append((source.randint(0, 300), text))
    rows += [(500 + i, rows[5][1]) for i in range(20)]
    rows += [(None, rows[5][1]), (None, "z" * 80), (600, "z" * 300), (601, "z" * 49), (602, "z" * 50), (602, "z" * 50)]
    rows += [(603, ""), (604, None), (None, None), (605, "ab" * 200), (606, "q" * 10 + "ab" * 30), (607, rows[9][1][:60])]
    source.shuffle(rows)
    return rows


def test_query_against_a_table_of_all_strings(spark, tmp_path):
    rows = cases()
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"block": F.lit("x"), "id": F.lit(1), "spans": F.lit(2), "digest": F.lit(3)}
    )
    assert run(spark, tmp_path, frame.repartition(3)) == expected(rows)


def test_given_documents(spark, tmp_path, docs):
    few = docs.filter("length(text) < 4000").select("doc_id", "text")
    want = expected(few.collect())
    assert run(spark, tmp_path, few) == want and sum(k[2] for k in want) > 10_000


def test_blocks_of_any_size_give_the_same(spark):
    frame = spark.createDataFrame(cases(), "doc_id long, text string")
    one, two = (
        sorted(suffix_dedup.repeated_spans(frame, block_bytes=b).drop("spans").collect(), key=str)
        for b in (3000, 1 << 20)
    )
    assert one == two


def test_often_met_minimizers_are_dealt_on(monkeypatch):
    """The same passages are found if a minimizer's suffixes are sorted in many places."""
    rows = [(i, t) for i, t in cases() if i is not None]

    def found(often, chunk):
        monkeypatch.setattr(suffix_dedup, "OFTEN", often)
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
        blocks = []
        for number, part in enumerate((rows[:100], rows[100:])):
            texts = [t.encode() if t else b"" for _, t in part]
            import zstandard

            packed = zstandard.compress(b"".join(texts))
            row = {"block": number, "ids": [i for i, _ in part], "sizes": list(map(len, texts)), "packed": packed}
            blocks.append(suffix_dedup.Block(row))
        named = []
        for b in blocks:
            names, counts = b.names()
            named.append({"block": b.number, "bucket": 0, "names": names.tobytes(), "counts": counts.astype("<u2").tobytes()})
        codes = {r["block"]: np.frombuffer(r["codes"], np.uint8) for r in suffix_dedup.code_names(pa.Table.from_pylist(named))}
        pieces = [b.pieces(codes[b.number], 3) for b in blocks]
        groups = collections.defaultdict(list)
        for b, p in zip(blocks, pieces, strict=True):
            for r in p.rows(b.number):
                groups[r["bucket"], r["sub"]].append(r)
        later = [r for g in groups.values() for r in suffix_dedup.find_later(pa.Table.from_pylist(g))]
        out = []
        for b, p in zip(blocks, pieces, strict=True):
            mine = sorted((r for r in later if r["block"] == b.number), key=lambda r: (r["bucket"], r["sub"]))
            out += [r for batch in suffix_dedup.finished(b, p, mine) for r in batch.to_pylist()]
        return out, len(groups)

    (one, few), (two, many) = found(8192, 1 << 20), found(4, 300)
    assert one == two and few <= 3 < many
    want = expected(rows)
    got = collections.Counter(
        (r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest())
        for r in one
    )
    assert got == want


def test_none(spark, no_docs):
    assert suffix_dedup.repeated_spans(no_docs).count() == 0

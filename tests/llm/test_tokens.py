"""Tokenizers against their libraries, and files against what was written."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from assayer.llm import common, distinct, pieces, queries, token_files

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def noise(count):
    letters = list("ab é日  　\u0085▁  \n\t\r\x0b\x1c'slltveredm.,!0٣́²ⅣǅK​😀_-")
    source = random.Random(5)
    return ["".join(source.choices(letters, k=source.randint(0, 14))) for _ in range(count)]


@pytest.mark.parametrize("extra", [[], ["a\x00b c"], ["x <|endoftext|> y"]])
def test_ids_are_the_libraries(extra):
    texts = noise(5000) + extra
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids, decoded = pieces.Pieces.of(PIECES).encode(pa.array(texts, pa.string()))
    want = [[*e, 2] for e in model.encode(texts)]
    assert ids.to_pylist() == want
    assert decoded.to_pylist() == [model.decode(e) for e in want]
    library = Tokenizer.from_file(BYTES)
    want = [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    found = token_files.WordIds.of(BYTES).encode(pa.array(texts, pa.string()), 2)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == want


@pytest.mark.parametrize("most", [0, 40, 10_000])
def test_ids_kept_across_batches_are_the_same(most):
    words = token_files.WordIds.of(BYTES)
    known = distinct.Known(words.words, most)
    for seed in range(5):
        batch = sorted(set(noise(300)) | {f" word{i}" for i in range(seed, seed + 9)})
        for found, want in zip(known(batch), words.words(batch), strict=True):
            assert found.tolist() == want.tolist()
        assert len(known.place) <= max(most, len(batch))
    assert [len(x) for x in known([])] == [0, 0]


def test_query_checksums(spark, docs):
    """Every document's ids against the library's, all in ascending order of the ids."""
    library, at = Tokenizer.from_file(BYTES), 0
    texts = dict(docs.select("doc_id", "text").collect())
    rows = sorted(queries.op9(spark, "/root/testdata/sf0.001").collect(), key=lambda r: r.doc_id)
    assert len(rows) == len(texts)
    for row in rows:
        ids = [*library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids, 2]
        assert (row.start, row.n_tokens) == (at, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_pieces_keep_rows_and_columns(odd_docs, no_docs):
    found = pieces.encode_decode(odd_docs, PIECES)
    assert sorted(found.columns) == sorted([*odd_docs.columns, "decoded"])
    rows = found.select("text", "ids", "decoded").collect()
    assert len(rows) == odd_docs.count()
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text, ids, decoded in rows:
        assert ids == [*model.encode(text or ""), 2] and decoded == model.decode(ids)
    assert pieces.encode_decode(no_docs, PIECES).count() == 0


def test_query_digests(spark, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = dict(docs.select("doc_id", "text").collect())
    for row in queries.op2(spark, "/root/testdata/sf0.001").collect():
        ids = [*model.encode(texts[row.doc_id] or ""), 2]
        assert row.n_tokens == len(ids)
        assert row.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def written(spark, docs):
    folder = common.scratch(common.prepare(spark), "tokens")
    return token_files.write_token_files(docs, BYTES, 2, folder)


def test_files_hold_all_documents(spark, odd_docs):
    found = token_files.fetch(token_files.frames(written(spark, odd_docs))).collect()
    rows = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, None, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9]
    library, at = Tokenizer.from_file(BYTES), 0
    texts = dict(odd_docs.filter("doc_id IS NOT NULL").select("doc_id", "text").collect())
    for row in rows:
        assert row.start == at and len(row.payload) == 4 * row.n_tokens
        at += row.n_tokens
        if row.doc_id is not None:
            ids = [*library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids, 2]
            assert row.payload == np.array(ids, "<u4").tobytes()


def test_files_are_plain_zstandard_and_checked(spark, docs):
    import zstandard

    manifest = written(spark, docs)
    frames = token_files.frames(manifest)
    one = frames.filter("doc_id = 7")
    whole = token_files.fetch(frames).filter("doc_id = 7").first()
    assert token_files.fetch(one).first() == whole
    path = manifest.first()["path"].removeprefix("file:")
    content = open(path, "rb").read()
    parts = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
    rows = token_files.fetch(frames.filter(F.col("path") == manifest.first()["path"])).collect()
    rows.sort(key=lambda r: r.start)
    assert parts == b"".join(r.payload for r in rows)
    wrong = one.withColumn("checksum", F.col("checksum") + 1)
    with pytest.raises(Exception, match="wrong checksum"):
        token_files.fetch(wrong).collect()
    assert zlib.crc32(whole.payload) == token_files.fetch(one).select(F.crc32("payload")).first()[0]


def test_no_documents_no_files(spark, no_docs):
    assert token_files.fetch(token_files.frames(written(spark, no_docs))).count() == 0

"""Alignment of two tokenizers against counting overlaps one by one."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from assayer.llm import alignment, queries

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    """Tokens of whole texts by the libraries, and their overlaps by definition."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        letters = alignment.byte_letters()
        self.a_bytes = {i: bytes(letters.get(c, 0) for c in t) for t, i in self.a.get_vocab().items()}

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def spans(self, ids, content):
        at, found = 0, []
        for i in ids:
            found.append((at, at + len(content(i)), i))
            at += len(content(i))
        return found

    def align(self, text):
        """Links as id pairs and groups as text; nothing for texts without tokens."""
        if not text:
            return [], 0, 0, ""
        a_ids = self.a.encode(" " + text, add_special_tokens=False).ids
        b_ids = self.b.encode(text)
        want = (" " + text).encode()
        if b"".join(map(self.a_bytes.get, a_ids)) != want or b"".join(map(self.b_bytes, b_ids)) != want:
            return [], 0, 0, ""
        a, b = self.spans(a_ids, self.a_bytes.get), self.spans(b_ids, self.b_bytes)
        links = [(x, y) for s, e, x in a for t, f, y in b if s < f and t < e]
        ends = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups, last = [], 0
        for end in ends:
            inside = [[str(i) for s, e, i in side if last <= s and e <= end] for side in (a, b)]
            groups.append("|".join(",".join(ids) for ids in inside))
            last = end
        return links, len(a), len(b), ";".join(groups)


def expected(texts):
    plain = Plain()
    found = [plain.align(t) for t in texts]
    counts = collections.Counter(p for links, *_ in found for p in links)
    most = collections.defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for links, n_a, n_b, groups in found:
        yield (
            n_a,
            n_b,
            groups.count(";") + 1 if groups else 0,
            len(links),
            sum(counts[p] == most[p[1]] for p in links),
            sum(counts[p] for p in links),
            hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )


COLUMNS = [*alignment.COUNTS, "n_best", "count_sum"]


def test_query_against_overlaps_one_by_one(spark, tmp_path, odd_docs, docs):
    odd = [
        "<|endoftext|> and <s> </s> <unk>", "tab\tand\n newline \n\n  end  ", " ", "  ", "▁", "a ▁b", "naïve café",
        "don't 'tis x's", "🙂🙂 🙂", "ﬁ ligature Å K", "é​  x　y", "\x00", "a \x00 b c", "﻿bom", "1234567 89.10",
    ]
    few = docs.filter("length(text) < 2000").limit(60).select("doc_id", "text")
    rows = few.unionByName(odd_docs.filter("coalesce(doc_id, 0) <> 7").select("doc_id", "text"))
    rows = rows.unionByName(spark.createDataFrame([(500 + i, t) for i, t in enumerate(odd)], rows.schema))
    rows = rows.withColumn("doc_id", F.monotonically_increasing_id())
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    texts = dict(spark.read.parquet(f"{tmp_path}/documents.parquet").collect())
    found = {r.doc_id: tuple(r[c] for c in [*COLUMNS, "groups_sha256"]) for r in queries.op11(spark, str(tmp_path)).collect()}
    assert found == dict(zip(texts, expected(texts.values()), strict=True))


def test_blocks_of_any_size_give_the_same(spark, docs):
    def totals(size):
        rows = alignment.aligned(docs.select("doc_id", "text"), A, B, block_bytes=size)
        rows = alignment.with_totals(rows, A, B)
        return sorted(map(tuple, rows.select("doc_id", "groups", *COLUMNS).collect()))

    assert totals(10_000) == totals(alignment.BLOCK_BYTES)


def test_odd_rows_columns_and_none(spark, odd_docs, no_docs):
    rows = odd_docs.withColumns({"n_a": F.lit("x"), "groups": F.lit(1), "n_best": F.lit("y")})
    found = alignment.with_totals(alignment.aligned(rows, A, B), A, B)
    assert sorted(found.columns) == sorted(set(rows.columns) | set(COLUMNS) | {"groups"})
    found = found.collect()
    assert len(found) == rows.count()
    plain = Plain()
    for row in found:
        if row.doc_id != 7:
            links, n_a, n_b, groups = plain.align(row.text)
            assert (row.n_links, row.n_a, row.n_b, row.groups) == (len(links), n_a, n_b, groups)
    long = next(r for r in found if r.doc_id == 7)
    assert long.n_links >= long.n_b > 10_000 and long.count_sum > long.n_links
    assert alignment.with_totals(alignment.aligned(no_docs, A, B), A, B).count() == 0


def test_coalescing():
    a, b = alignment.coalesce(np.array([2, 2, 1, 3]), np.array([1, 3, 2, 2]))
    assert a.tolist() == [0, 0, 1, 1] and b.tolist() == [0, 0, 1, 1]
    left, right = alignment.overlaps(np.array([2, 2, 1, 3]), np.array([1, 3, 2, 2]))
    assert list(zip(left.tolist(), right.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 1), (2, 2), (3, 2), (3, 3)]

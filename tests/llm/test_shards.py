"""Differencing by hand and over documents."""

import zlib
from collections import Counter, defaultdict

from assayer.llm import queries, shard


def test_difference_evens_sums():
    places, sums = shard.difference([[8, 0], [7, 0], [6, 0], [5, 0], [4, 0]])
    # Differencing gives 16 and 14 here, where taking the least each time gives 17 and 13.
    assert sorted(sums) == [14, 16]
    found = [0, 0]
    for value, place in zip((8, 7, 6, 5, 4), places, strict=True):
        found[place[0]] += value
    assert found == list(sums)


def test_levels_agree_with_sums(spark):
    groups = spark.range(500).selectExpr("id", "id * id % 997 + 1 AS bytes")
    parts = shard.balance(groups, 4, bucket=40).join(groups, "id")
    sums = [r[0] for r in parts.groupBy("part").agg({"bytes": "sum"}).select("sum(bytes)").collect()]
    assert len(sums) == 4 and max(sums) - min(sums) <= 2


def test_rows_groups_and_slots(odd_docs, no_docs):
    rows = shard.shard_by_bytes(odd_docs, 3).collect()
    assert len(rows) == odd_docs.count()
    for number in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == number)
        assert slots == list(range(len(slots)))
    # NULL and empty texts are one group of size 1 each.
    empty = [r for r in rows if r.size == 1]
    assert len(empty) == 3 and len({r.shard for r in empty}) == 1
    assert len({r.shard for r in rows if r.doc_id == 2}) == 1
    assert shard.shard_by_bytes(no_docs, 8).count() == 0


def test_query_against_the_texts(spark, docs):
    """Sizes, checksums, groups, slots and balance of the query's rows, from the texts."""
    texts = dict(docs.select("doc_id", "text").collect())
    rows = queries.op1(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    shard_of, total, groups, slots = {}, Counter(), Counter(), defaultdict(list)
    for row in rows:
        body = (texts[row.doc_id] or "").encode()
        assert (row.size, row.text_crc32) == (len(body) + 1, zlib.crc32(body))
        assert row.law == "bytes" and 0 <= row.shard < 8 and row.grown_shard is None
        assert shard_of.setdefault(body, row.shard) == row.shard
        total[row.shard] += row.size
        groups[body] += row.size
        slots[row.shard].append(row.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # No other dealing of whole groups comes closer than the largest group allows.
    assert max(total.values()) <= max(max(groups.values()), sum(total.values()) / 8 * 1.001)

"""Sharding by bytes with Karmarkar-Karp differencing; equal texts stay together.

Documents of one text form a group that is not divided. Differencing starts with
a partial partition for each group (its bytes in one shard, nothing in the
others) and again and again combines the two partial partitions of largest
spread, the largest shards of one onto the smallest of the other, until one is
left. Its spread is far below the size of a single group.

Groups are dealt into buckets of bounded number, each bucket is differenced by a
task, and the partial partitions that come out, one row of sums per bucket, are
differenced the same way on the next level, until one bucket is left. No task
sees more than a bucket, and the driver sees none of it.

A group larger than a fair share stays whole: its shard is then as large as the
group, and the others are even among themselves.

NULL texts count as empty ones, of size 1. Rows without an id, repeated rows and
repeated ids are placed like all others. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm import common

# Partial partitions that one task combines, on average.
BUCKET = 16_384


def difference(sums: Sequence[Sequence[int]]) -> tuple[np.ndarray, list[int]]:
    """Combine partial partitions; where each one's parts go, and the sums there.

    Row i of the result maps the parts of partition i to the parts of the whole.
    """
    parts = len(sums[0])
    heap = []
    orders = []  # of each partition, which of its parts is at a place by size
    for i, own in enumerate(sums):
        order = sorted(range(parts), key=lambda p: (-own[p], p))
        ranked = [own[p] for p in order]
        orders.append(order)
        heap.append((ranked[-1] - ranked[0], i, ranked))
    heapq.heapify(heap)
    merges = []
    while len(heap) > 1:
        _, a, first = heapq.heappop(heap)
        spread, b, second = heap[0]
        both = [x + y for x, y in zip(first, reversed(second), strict=True)]
        order = sorted(range(parts), key=both.__getitem__, reverse=True)
        ranked = [both[p] for p in order]
        merges.append((a, b, order))
        heapq.heapreplace(heap, (ranked[-1] - ranked[0], len(sums) + len(merges) - 1, ranked))
    _, last, ranked = heap[0]
    # Back from the whole to the partitions it was made of.
    where: dict[int, list[int]] = {last: list(range(parts))}
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        here = where.pop(len(sums) + k)
        of = [0] * parts
        for place, came_from in enumerate(order):
            of[came_from] = here[place]
        where[a] = of
        where[b] = of[::-1]
    places = np.empty((len(sums), parts), np.int32)
    for i, order in enumerate(orders):
        places[i, order] = where[i]
    return places, ranked


def _level(items: DataFrame, parts: int, buckets: int) -> DataFrame:
    """Difference the items of each bucket: (bucket, id, places, sums of the bucket once)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        from assayer.llm.shard import difference

        rows = rows.sort_values("id", ignore_index=True)
        places, sums = difference([list(map(int, s)) for s in rows["sums"]])
        whole = [None] * len(rows)
        whole[0] = sums
        return pd.DataFrame(
            {"bucket": rows["bucket"], "id": rows["id"], "places": list(places), "sums": whole}
        )

    dealt = items.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)))
    return common.settle(
        dealt.groupBy("bucket").applyInPandas(
            run, "bucket long, id long, places array<int>, sums array<long>"
        )
    )


def balance(groups: DataFrame, parts: int, bucket: int = BUCKET) -> DataFrame:
    """The part of each group, for groups (`id` long, `bytes` long) with unique ids."""
    common.prepare(groups.sparkSession)
    none = [F.lit(0).cast("long")] * (parts - 1)
    items = groups.select("id", F.array(F.col("bytes"), *none).alias("sums"))
    count, levels = groups.count(), []
    while True:
        buckets = max(1, math.ceil(count / bucket))
        levels.append(_level(items, parts, buckets))
        if buckets == 1:
            break
        items = levels[-1].filter("sums IS NOT NULL").select(F.col("bucket").alias("id"), "sums")
        count = buckets
    placed = levels[0].select("id", "bucket", F.col("places")[0].alias("part"))
    for level in levels[1:]:
        above = level.select(
            F.col("id").alias("bucket"), F.col("bucket").alias("above"), "places"
        )
        placed = placed.join(above, "bucket").select(
            "id", F.col("above").alias("bucket"), F.expr("places[part]").alias("part")
        )
    return placed.select("id", "part")


def number_rows(df: DataFrame, group: str, number: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps; groups may be of any size.

    Rows are numbered in the partitions they lie in and get the number of rows
    of their group in the partitions before. Those offsets are one row for each
    partition and group at most, so `group` should have few values.
    """
    df = common.settle(df).withColumn("__part", F.spark_partition_id())
    earlier = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy("__part", group)
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__part", group, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__first"))
    )
    schema = df.drop("__part").schema.add("__part", "integer").add("__own", "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            groups = batch.column(group).to_numpy(zero_copy_only=False)
            own = np.empty(len(groups), np.int64)
            for value in np.unique(groups).tolist():
                here = np.flatnonzero(groups == value)
                own[here] = seen.get(value, 0) + np.arange(len(here))
                seen[value] = seen.get(value, 0) + len(here)
            columns = [batch.column(c) for c in schema.names[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(own)], names=schema.names)

    numbered = df.mapInArrow(count, schema)
    joined = numbered.join(F.broadcast(offsets), ["__part", group])
    return joined.withColumn(number, F.col("__own") + F.col("__first")).drop(
        "__part", "__own", "__first"
    )


def shard_by_bytes(
    docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Each document with its size, the CRC-32 of its text, its shard and its slot there."""
    body = common.text_of(text)
    rows = common.settle(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.xxhash64(body).alias("id"),
        )
    )
    groups = common.settle(rows.groupBy("id").agg(F.sum("size").alias("bytes")))
    parts = balance(groups, shards).withColumnRenamed("part", "shard")
    placed = rows.join(parts, "id").drop("id")
    return number_rows(placed, "shard", "slot")

"""Hard negatives by Hilbert-ordered Parquet blocks with zone maps.

Rows are sorted by length of vector, label and place on a Hilbert curve through
the dimensions of largest variance, and written to Parquet files. A row group is
a block: some rows of one length and one label that lie next to each other on
the curve. Beside each file stands its zone map, the smallest and largest value
of each dimension in each block, and a manifest has the same for each run of
blocks of one label in a file.

An anchor's inner product with any row of a block lies in an interval that
follows from the block's zones (interval arithmetic). First an anchor looks for
its positives, the best rows of its own label; each positive opens a window of
scores, and the best rows of other labels in it are the negatives. In both steps
an anchor reads a block only if its interval reaches above the last of the best
rows found so far, and into a window; runs and blocks come in the order of their
largest bound, so that this soon shuts out what is far away. Nothing else is
left out: the result is that of comparing all pairs.

A task holds a few anchors, the manifest and zones in pieces, and some blocks;
blocks are read from the shared folder, not shuffled. A label of any size is many
blocks. Files carry the name of the attempt that wrote them, and the manifest
names those of the attempt that counts, so lost executors do no harm.

Rows without id, label or vector, with an empty vector, or with NULL or
non-finite components (after scaling, too) take no part. Only vectors of one
length meet. An anchor takes no row of its own id; otherwise rows that repeat an
id or are equal are rows of their own, and so are anchors. Scores beyond a long
count as the largest or smallest long. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm import common

# Dimensions of the curve, and bits of each.
AXES, BITS = 16, 8
# Rows of a block, anchors that search together, blocks and files a task keeps.
BLOCK, GROUP, KEPT, FILES = 512, 64, 128, 16
# Runs whose bounds are computed at once.
RUNS = 4096
# Standard deviations to both sides of the mean that the curve tells apart.
REACH = 3.0

LAST = np.iinfo(np.int64).max
_MANIFEST = (
    "path string, length int, label long, first int, groups int, low array<double>, high array<double>"
)
_ZONES = pa.schema([("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))])
_ROWS = pa.schema([("id", pa.int64()), ("vector", pa.list_(pa.float64()))])
FOUND = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


def hilbert_keys(places: np.ndarray, bits: int) -> np.ndarray:
    """Keys, as rows of bytes, that sort cells of a grid along the Hilbert curve.

    From the top bit down, a cell's coordinates are turned and mirrored into the
    frame of the sub-cube it lies in; what is left is the Gray code of the place.
    """
    x = places.astype(np.int64).T.copy()
    for level in (1 << b for b in range(bits - 1, 0, -1)):
        low = level - 1
        for axis in range(len(x)):
            mirrored = (x[axis] & level) != 0
            turned = np.where(mirrored, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(mirrored, low, turned)
            x[axis] ^= turned
    x = np.bitwise_xor.accumulate(x, axis=0)
    carry = np.zeros(x.shape[1], np.int64)
    for level in (1 << b for b in range(bits - 1, 0, -1)):
        carry ^= np.where((x[-1] & level) != 0, level - 1, 0)
    x ^= carry
    planes = [(x >> b) & 1 for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def scaled(
    rows: DataFrame, scale: float, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding"
) -> DataFrame:
    """`id`, `label` and `vector` of the rows that take part, components as floor(scale * x)."""
    values = F.transform(F.col(vector).cast("array<double>"), lambda x: F.lit(float(scale)) * x)
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    chosen = rows.select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), values.alias("vector")
    )
    chosen = chosen.filter("id IS NOT NULL AND label IS NOT NULL AND size(vector) > 0").filter(good)
    # Rounded in double precision: the largest values do not fit a long.
    whole = F.transform("vector", lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x))
    return chosen.withColumn("vector", whole)


def axes_of(rows: DataFrame) -> list:
    """Dimensions of largest variance over all rows, with mean and deviation."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            # Far values do not overflow their squares.
            values = np.clip(column.flatten().to_numpy(), -1e150, 1e150)
            sizes = np.diff(column.offsets.to_numpy())
            at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            columns = [np.bincount(at), np.bincount(at, values), np.bincount(at, values * values)]
            names = ["n", "total", "squares"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(columns[0]))), *map(pa.array, columns)], names=["at", *names]
            )

    parts = rows.mapInArrow(sums, "at long, n long, total double, squares double")
    each = parts.groupBy("at").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")])
    each = each.select("at", "n", (F.col("total") / F.col("n")).alias("mean"), "squares")
    variance = F.col("squares") / F.col("n") - F.col("mean") * F.col("mean")
    each = each.withColumn("spread", F.greatest(variance, F.lit(0.0)) * F.col("n"))
    chosen = each.orderBy(F.desc("spread"), "at").limit(AXES).collect()
    return [(r["at"], r["mean"], math.sqrt(r["spread"] / r["n"])) for r in chosen]


def on_curve(rows: DataFrame, axes: list) -> DataFrame:
    """Rows of `scaled` with their `length` and their place on the curve."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from assayer.llm.hard_negatives import curve_places, hilbert_keys

        for batch in batches:
            column = batch.column("vector")
            keys = hilbert_keys(curve_places(column, axes), BITS)
            names = ["id", "label", "vector", "length", "curve"]
            columns = [batch.column(c) for c in names[:3]]
            columns.append(pa.array(np.diff(column.offsets.to_numpy()).astype(np.int32)))
            columns.append(pa.array([k.tobytes() for k in keys], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "id long, label long, vector array<double>, length int, curve binary"
    return rows.mapInArrow(place, schema)


def curve_places(column: pa.ListArray, axes: list) -> np.ndarray:
    """Cells of the curve's grid; dimensions a vector does not have lie at 0."""
    ends = column.offsets.to_numpy()
    values, first, sizes = column.values.to_numpy(), ends[:-1], np.diff(ends)
    cells = np.zeros((len(column), len(axes)), np.int64)
    for k, (at, mean, spread) in enumerate(axes):
        has = sizes > at
        x = (values[first[has] + at] - mean) / (spread or 1.0) / REACH
        cells[has, k] = ((np.clip(x, -1, 1) + 1) / 2 * ((1 << BITS) - 1)).astype(np.int64)
    return cells


def matrix(column: pa.ListArray) -> np.ndarray:
    """Vectors of one length."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def zone_matrix(table: pa.Table, column: str) -> np.ndarray:
    return matrix(pa.concat_arrays(table.column(column).chunks))


def write_blocks(rows: DataFrame, folder: str, block: int = BLOCK) -> DataFrame:
    """Write rows of `on_curve` to files of blocks; the manifest, computed once."""
    spark = rows.sparkSession
    order = ["length", "label", "curve", "id"]
    dealt = rows.repartitionByRange(common.partitions(spark), *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from assayer.llm.hard_negatives import BlockWriter

        task = TaskContext.get()
        out = BlockWriter(f"{folder}/{task.partitionId():06d}-{task.taskAttemptId()}", block)
        for batch in batches:
            out.add(batch)
        yield from out.close()

    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)
    return common.settle(dealt.mapInArrow(write, _MANIFEST))


class BlockWriter:
    """Writes sorted rows as one file of blocks, with its zone map beside it."""

    def __init__(self, path: str, block: int) -> None:
        self.path, self.block = path, block
        self.held: list[pa.RecordBatch] = []
        self.rows = self.groups = 0
        self.out = None
        self.runs: list[dict] = []
        self.zones: list[dict] = []

    def add(self, batch: pa.RecordBatch) -> None:
        kind = np.stack([batch.column(c).to_numpy() for c in ("length", "label")])
        cuts = np.flatnonzero((kind[:, 1:] != kind[:, :-1]).any(axis=0)) + 1
        for i, j in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
            while i < j:
                now = tuple(kind[:, i].tolist())
                if self.held and (now != self.kind or self.rows >= self.block):
                    self._flush()
                self.kind = now
                size = min(j - i, self.block - self.rows)
                self.held.append(batch.slice(i, size))
                self.rows, i = self.rows + size, i + size

    def _flush(self) -> None:
        import pyarrow.parquet as pq
        from pyarrow import fs

        if self.out is None:
            files, name = fs.FileSystem.from_uri(self.path)
            self.out = pq.ParquetWriter(f"{name}.parquet", _ROWS, filesystem=files)
        rows = pa.Table.from_batches(self.held).select(["id", "vector"]).combine_chunks().cast(_ROWS)
        self.out.write_table(rows, row_group_size=self.block)
        values = matrix(rows.column("vector").chunk(0))
        low, high = values.min(axis=0), values.max(axis=0)
        length, label = self.kind
        self.zones.append({"low": low, "high": high})
        last = self.runs[-1] if self.runs else None
        if last and (last["length"], last["label"]) == self.kind:
            last["groups"] += 1
            last["low"], last["high"] = np.minimum(last["low"], low), np.maximum(last["high"], high)
        else:
            run = {"path": self.path, "length": length, "label": label, "first": self.groups, "groups": 1}
            self.runs.append({**run, "low": low, "high": high})
        self.held, self.rows, self.groups = [], 0, self.groups + 1

    def close(self) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        if self.held:
            self._flush()
        if self.out is not None:
            self.out.close()
            files, name = fs.FileSystem.from_uri(f"{self.path}.zones")
            pq.write_table(pa.Table.from_pylist(self.zones, _ZONES), name, filesystem=files)
        types = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.list_(pa.float64())] * 2]
        names = ["path", "length", "label", "first", "groups", "low", "high"]
        for run in self.runs:
            yield pa.RecordBatch.from_pylist([run], pa.schema(list(zip(names, types, strict=True))))


def opened(path: str):
    import pyarrow.parquet as pq
    from pyarrow import fs

    files, name = fs.FileSystem.from_uri(path)
    return pq.ParquetFile(name, filesystem=files)


class Store:
    """Reads the manifest, zone maps and blocks, and keeps the last of them."""

    def __init__(self, manifest: str) -> None:
        self.manifest = manifest
        self.opened = functools.lru_cache(FILES)(opened)
        self.zones = functools.lru_cache(FILES)(self._zones)
        self.block = functools.lru_cache(KEPT)(self._block)

    def runs(self, length: int) -> Iterator[pa.Table]:
        """The runs of vectors of a length, a bounded number at a time."""
        from pyarrow import dataset, fs

        files, name = fs.FileSystem.from_uri(self.manifest)
        wanted = dataset.dataset(name, filesystem=files, format="parquet")
        batches = wanted.to_batches(filter=dataset.field("length") == length, batch_size=RUNS)
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= RUNS:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
        if rows:
            yield pa.Table.from_batches(held)

    def _zones(self, path: str) -> pa.Table:
        return self.opened(f"{path}.zones").read().combine_chunks()

    def _block(self, path: str, group: int) -> tuple[np.ndarray, np.ndarray]:
        found = self.opened(f"{path}.parquet").read_row_group(group).combine_chunks()
        return found.column("id").to_numpy(), matrix(found.column("vector").chunk(0))


def interval(vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner products of vectors with what lies in each zone."""
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    # What the sums may lose to rounding.
    slack = np.abs(vectors) @ np.maximum(np.abs(low), np.abs(high)).T * 1e-9
    least, most = up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack
    # Sums beyond a double bound nothing; scores end where a long does.
    least, most = np.nan_to_num(least, nan=-np.inf), np.nan_to_num(most, nan=np.inf)
    return np.clip(least, -LAST, LAST), np.clip(most, -LAST, LAST)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers held as doubles."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    exact = [np.array([[int(x) for x in v] for v in m], object) for m in (a, b)]
    found = exact[0] @ exact[1].T
    return np.array([[min(max(s, -LAST), LAST) for s in row] for row in found], np.int64)


class Best:
    """The first k of what is offered to each slot, by score, then by id."""

    def __init__(self, floors: np.ndarray, k: int) -> None:
        self.k, self.floors, self.last = k, floors, floors.copy()
        self.slot, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        slot, score, ids = (
            np.concatenate(p) for p in ((self.slot, slot), (self.score, score), (self.id, ids))
        )
        order = np.lexsort((ids, -score, slot))
        slot = slot[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        order = order[rank < self.k]
        full = slot[rank == self.k - 1]
        self.slot, self.score, self.id = slot[rank < self.k], score[order], ids[order]
        self.last[full] = self.score[np.searchsorted(self.slot, full, "right") - 1]


class Search:
    """Positives and negatives of a few anchors of one length."""

    def __init__(self, store: Store, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        self.store, self.ids, self.labels, self.vectors = store, ids, labels, vectors

    def positives(self, k: int) -> Best:
        best = Best(np.full(len(self.ids), -LAST), k)
        slots, open_to = np.arange(len(self.ids)), np.full(len(self.ids), LAST)
        self._scan(best, slots, open_to, own=True)
        return best

    def negatives(self, k: int, slots: np.ndarray, low: np.ndarray, high: np.ndarray) -> Best:
        """Given are the anchor and the bounds of each window."""
        best = Best(low, k)
        self._scan(best, slots, high, own=False)
        return best

    def _scan(self, best: Best, anchor: np.ndarray, high: np.ndarray, own: bool) -> None:
        """Read the blocks whose bounds reach a slot above its last row and below its end."""

        def needs(bounds: tuple[np.ndarray, np.ndarray], label: int) -> np.ndarray:
            fits = (self.labels[anchor] == label) == own
            low, up = bounds[0][anchor], bounds[1][anchor]
            return fits & (low <= high) & (up >= best.last) & (best.last <= high)

        def bounds_of(low: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
            least, most = interval(self.vectors, low, top)
            return least, most, np.argsort(-most.max(axis=0), kind="stable").tolist()

        for runs in self.store.runs(self.vectors.shape[1]):
            low, top = (zone_matrix(runs, c) for c in ("low", "high"))
            keys = runs.select(["path", "label", "first", "groups"]).to_pylist()
            least, most, order = bounds_of(low, top)
            for r in order:
                run = keys[r]
                if not needs((least[:, r], most[:, r]), run["label"]).any():
                    continue
                for start in range(0, run["groups"], RUNS):
                    first = run["first"] + start
                    zones = self.store.zones(run["path"]).slice(first, min(RUNS, run["groups"] - start))
                    b_least, b_most, b_order = bounds_of(*(zone_matrix(zones, c) for c in ("low", "high")))
                    for g in b_order:
                        wanted = needs((b_least[:, g], b_most[:, g]), run["label"])
                        if wanted.any():
                            self._read(best, anchor, high, np.flatnonzero(wanted), run["path"], first + g)

    def _read(self, best: Best, anchor: np.ndarray, high: np.ndarray, slots: np.ndarray, path: str, group: int) -> None:
        ids, vectors = self.store.block(path, group)
        anchors, place = np.unique(anchor[slots], return_inverse=True)
        score = products(self.vectors[anchors], vectors)[place]
        good = (score >= best.last[slots][:, None]) & (score <= high[slots][:, None])
        good &= self.ids[anchor[slots]][:, None] != ids
        at, row = np.nonzero(good)
        if len(at):
            best.offer(slots[at], score[at, row], ids[row])


def windows(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores from `low` to `high` percent of a score."""
    return -(-low * score // 100), high * score // 100


def search(store: Store, anchors: pa.RecordBatch, positives: int, negatives: int, low: int, high: int) -> pa.RecordBatch:
    """The rows of the result for anchors of one length."""
    ids, labels = anchors.column("id").to_numpy(), anchors.column("label").to_numpy()
    work = Search(store, ids, labels, matrix(anchors.column("vector")))
    found = work.positives(positives)
    bounds = [windows(int(s), low, high) for s in found.score]
    least, most = np.array(bounds, np.int64).reshape(-1, 2).T
    best = work.negatives(negatives, found.slot, least.copy(), most.copy())
    rank = np.arange(len(best.slot)) - np.searchsorted(best.slot, best.slot) + 1
    columns = {
        "anchor_id": ids[found.slot[best.slot]],
        "positive_id": found.id[best.slot],
        "rank": rank.astype(np.int32),
        "negative_id": best.id,
        "positive_score": found.score[best.slot],
        "negative_score": best.score,
    }
    return pa.RecordBatch.from_pydict(columns)


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    block: int = BLOCK,
) -> DataFrame:
    """Negatives of each anchor and positive, for rows and anchors as `scaled` gives them.

    Their scores are from `low` to `high` percent of the positive's, and `rank`
    counts them from 1.
    """
    spark = common.prepare(rows.sparkSession)
    folder = common.scratch(spark, "blocks")
    rows = common.settle(rows)
    axes = axes_of(rows)
    write_blocks(common.settle(on_curve(rows, axes)), folder, block).write.parquet(f"{folder}/manifest")
    # Anchors that lie together want the same blocks.
    order = ["length", "label", "curve", "id"]
    placed = common.settle(on_curve(anchors, axes))
    dealt = placed.repartitionByRange(common.partitions(spark), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from assayer.llm.hard_negatives import Store, search

        store = Store(f"{folder}/manifest")
        for batch in batches:
            length = batch.column("length").to_numpy()
            cuts = np.flatnonzero(np.diff(length)) + 1
            for i, j in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
                for k in range(i, j, GROUP):
                    part = batch.slice(k, min(GROUP, j - k))
                    yield search(store, part, positives, negatives, low, high)

    return dealt.mapInArrow(run, FOUND)

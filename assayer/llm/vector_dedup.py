"""Near duplicates of vectors by an inverted multi-index.

Vectors are split into halves, and each half has a codebook of its own, fitted
by k-means on a bounded sample. A pair of centroids is a cell of the product
grid; every vector is indexed in its cell. A vector looks for others in its
nearest cells, in the order of the summed distances of both halves (the
multi-sequence order), and what it meets there is verified by cosine in double
precision. The number of cells is set by the target recall: for vectors of the
sample and partners drawn exactly at the threshold, so that one of both meets
the other. Closer pairs are met more often.

Equal vectors form one class and are indexed once. Cells of any size are
compared in blocks of bounded size, and a block gives counts and the smallest
linked id for each vector in it, never pairs. A pair that only one side meets
counts for both, which the block can tell from the cells the other one visits.

Vectors of different lengths do not link. Each length that many vectors have gets an
index of its own; vectors of any other length lie in one cell and are all compared.

NULL and empty vectors, zero vectors and those with NULL or non-finite components
link with nothing. Rows without an id link with nothing and have no component.
Repeated rows are vectors of their own; of rows of one id with different vectors the
largest number of links counts.
Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm import common
from assayer.llm.components import components

# Vectors the codebooks are fitted on, at most; those of smallest hash.
SAMPLE = 20_000
# Vectors per cell on average, and centroids of a codebook at most.
CELL, CENTROIDS = 64, 1024
TARGET_RECALL = 0.98
# Vectors of the sample whose partners set the number of cells.
TRIALS = 1500
STEPS = 12
SEED = 7
# Indexed and looking vectors of a block, on average.
BLOCK = 512

# Vectors of a length that are all compared, without an index.
FEW = 4096

_INDEXED = "length int, id long, copies long, vector binary, cell int, probes array<int>"
_FOUND = "id long, n long, linked long"


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt(np.square(vectors).sum(axis=1))[:, None]


def stacked(blobs) -> np.ndarray:
    """Vectors of equal length from their bytes."""
    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)


class Grid:
    """Two codebooks, and the cells a vector visits."""

    def __init__(self, sample: np.ndarray, size: int, threshold: float, recall: float) -> None:
        self.middle = sample.shape[1] // 2
        random = np.random.default_rng(SEED)
        self.books = [_k_means(half, size, random) for half in self.halves(sample)]
        self.size = [len(b) for b in self.books]
        # Partners at the threshold: a vector turned by its angle in a random direction.
        own = sample[:TRIALS]
        turn = random.normal(size=own.shape)
        turn -= (turn * own).sum(axis=1)[:, None] * own
        turn /= np.maximum(np.sqrt(np.square(turn).sum(axis=1)), 1e-12)[:, None]
        partner = threshold * own + math.sqrt(1 - threshold**2) * turn
        met = np.minimum(self._ranks(own, partner), self._ranks(partner, own))
        self.visits = min(int(np.quantile(met, recall, method="higher")) + 1, math.prod(self.size))

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return vectors[:, : self.middle], vectors[:, self.middle :]

    def _far(self, vectors: np.ndarray) -> list[np.ndarray]:
        return [_distances(h, b) for h, b in zip(self.halves(vectors), self.books, strict=True)]

    def _cells(self, far: list[np.ndarray]) -> np.ndarray:
        return (far[0].argmin(axis=1) * self.size[1] + far[1].argmin(axis=1)).astype(np.int32)

    def _ranks(self, looking: np.ndarray, met: np.ndarray) -> np.ndarray:
        """How many cells come before that of the other vector."""
        ranks, cells = [], self._cells(self._far(met))
        for i in range(0, len(looking), 100):
            first, second = self._far(looking[i : i + 100])
            total = (first[:, :, None] + second[:, None, :]).reshape(len(first), -1)
            mine = np.take_along_axis(total, cells[i : i + 100, None].astype(np.int64), axis=1)
            ranks.append((total < mine).sum(axis=1))
        return np.concatenate(ranks)

    def place(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each vector, and the cells it visits, nearest first.

        The v nearest cells pair centroids of which the ranks i and j in their
        halves, from 1, have i * j <= v, so only these pairs are sorted.
        """
        far = self._far(vectors)
        orders = [np.argsort(f, axis=1, kind="stable")[:, : self.visits] for f in far]
        sorted_far = [np.take_along_axis(f, o, axis=1) for f, o in zip(far, orders, strict=True)]
        pairs = [
            (i, j)
            for i in range(orders[0].shape[1])
            for j in range(min(orders[1].shape[1], self.visits // (i + 1)))
        ]
        i, j = np.array(pairs).T
        total = sorted_far[0][:, i] + sorted_far[1][:, j]
        nearest = np.argsort(total, axis=1, kind="stable")[:, : self.visits]
        cells = orders[0][:, i] * self.size[1] + orders[1][:, j]
        probes = np.take_along_axis(cells, nearest, axis=1).astype(np.int32)
        return self._cells(far), probes


def _distances(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.square(points).sum(axis=1)[:, None] + np.square(book).sum(axis=1) - 2 * points @ book.T


def _k_means(points: np.ndarray, size: int, random: np.random.Generator) -> np.ndarray:
    book = points[random.choice(len(points), min(size, len(points)), replace=False)].copy()
    for _ in range(STEPS):
        nearest = np.concatenate(
            [_distances(points[i : i + 2000], book).argmin(axis=1) for i in range(0, len(points), 2000)]
        )
        count = np.bincount(nearest, minlength=len(book))
        total = np.zeros_like(book)
        np.add.at(total, nearest, points)
        book = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], book)
    return book


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Ids and vectors, as bytes of doubles, of the rows that can link."""
    values = F.col(vector).cast("array<double>")
    good = rows.select(F.col(vec_id).cast("long").alias("id"), values.alias("values")).filter(
        F.col("id").isNotNull()
        & (F.size("values") > 0)
        & F.forall("values", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
        & F.exists("values", lambda x: x != 0)
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("values")
            ends = values.offsets.to_numpy()
            flat = values.values.to_numpy().tobytes()
            places = itertools.pairwise((8 * ends.astype(np.int64)).tolist())
            blobs = pa.array([flat[i:j] for i, j in places], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), blobs], names=["id", "vector"])

    return good.mapInArrow(pack, "id long, vector binary")


def fit(classes: DataFrame, count: int, threshold: float, recall: float = TARGET_RECALL) -> Grid:
    """Codebooks from the sample, on the driver."""
    sample = classes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").collect()
    size = max(1, min(CENTROIDS, round(math.sqrt(count / CELL))))
    return Grid(unit(stacked([r["vector"] for r in sample])), size, threshold, recall)


def _indexed(classes: DataFrame, grid: Grid) -> DataFrame:
    """Vectors of one length with their cell and the cells they visit."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from assayer.llm.vector_dedup import stacked, unit

        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                cells, probes = grid.place(unit(stacked(part.column("vector").to_pylist())))
                columns = [part.column(c) for c in ("length", "id", "copies", "vector")]
                columns += [pa.array(cells), pa.array(list(probes), pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["length", "id", "copies", "vector", "cell", "probes"]
                )

    return classes.select("length", "id", "copies", "vector").mapInArrow(place, _INDEXED)


def _index(classes: DataFrame, threshold: float) -> DataFrame:
    """All vectors, those of each frequent length by a grid of their own."""
    sizes = classes.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    # There are at most as many of them as vectors divided by FEW.
    many = sizes.filter(F.col("n") > FEW).orderBy("length").collect()
    lengths = [r["length"] for r in many]
    rest = classes if not lengths else classes.filter(~F.col("length").isin(lengths))
    index = rest.select(
        "length", "id", "copies", "vector",
        F.lit(0).alias("cell"), F.array(F.lit(0)).alias("probes"),
    )
    for row in many:
        own = classes.filter(F.col("length") == row["length"])
        index = index.unionByName(_indexed(own, fit(own, row["n"], threshold)))
    return common.settle(index)


def _compare(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Counts and smallest linked ids of the vectors of one block."""
    flags = rows["looks"].to_numpy(bool)
    looking, own = rows[flags], rows[~flags]
    if not len(looking) or not len(own):
        return pd.DataFrame({"id": [], "n": [], "linked": []}, dtype="int64")
    a, b = looking["id"].to_numpy(), own["id"].to_numpy()
    near = unit(stacked(looking["vector"].tolist())) @ unit(stacked(own["vector"].tolist())).T
    linked = (near >= threshold) & (a[:, None] != b)
    a_some, b_some = linked.any(axis=1), linked.any(axis=0)
    linked, looking, own = linked[a_some][:, b_some], looking[a_some], own[b_some]
    a, b = a[a_some], b[b_some]
    a_count = linked @ own["copies"].to_numpy()
    # Pairs that the indexed vector does not meet from its side.
    probes, cells = list(own["probes"]), looking["cell"].to_numpy()
    missed = np.array([~np.isin(cells, p) for p in probes], bool).reshape(len(b), len(a)).T
    b_count = looking["copies"].to_numpy() @ (linked & missed)
    a_least, b_least, last = a.copy(), b.copy(), None
    while last is None or not np.array_equal(last, np.concatenate([a_least, b_least])):
        last, big = np.concatenate([a_least, b_least]), np.iinfo(np.int64).max
        if len(a):
            b_least = np.minimum(b_least, np.where(linked, a_least[:, None], big).min(axis=0))
            a_least = np.minimum(a_least, np.where(linked, b_least, big).min(axis=1))
    return pd.DataFrame(
        {
            "id": np.concatenate([a, b]),
            "n": np.concatenate([a_count, b_count]),
            "linked": np.concatenate([a_least, b_least]),
        }
    )


def _found(index: DataFrame, threshold: float) -> DataFrame:
    """Counts and links of all blocks: (id, n, linked), several rows for an id."""
    looks = index.select(
        "length", "id", "copies", "vector", F.col("cell").alias("from"), F.explode("probes").alias("cell")
    )
    at = ["length", "cell"]
    sizes = index.groupBy(*at).agg(F.count(F.lit(1)).alias("indexed"))
    visits = looks.groupBy(*at).agg(F.count(F.lit(1)).alias("looking"))
    blocks = common.settle(
        sizes.join(visits, at).select(
            *at,
            F.ceil(F.col("indexed") / BLOCK).cast("int").alias("parts"),
            F.ceil(F.col("looking") / (4 * BLOCK)).cast("int").alias("groups"),
        )
    )
    part, group = (F.pmod(F.xxhash64("id"), F.col(c).cast("long")) for c in ("parts", "groups"))
    none = F.lit(None).cast("array<int>")
    left = looks.join(blocks, at).select(
        *at,
        F.explode(F.expr("sequence(0L, parts - 1L)")).alias("part"),
        group.alias("group"),
        F.lit(True).alias("looks"),
        "id",
        "copies",
        "vector",
        "from",
        none.alias("probes"),
    )
    right = index.join(blocks, at).select(
        *at,
        part.alias("part"),
        F.explode(F.expr("sequence(0L, groups - 1L)")).alias("group"),
        F.lit(False).alias("looks"),
        "id",
        "copies",
        "vector",
        F.col("cell").alias("from"),
        "probes",
    )

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        from assayer.llm.vector_dedup import _compare

        return _compare(rows.rename(columns={"cell": "block", "from": "cell"}), threshold)

    both = left.unionByName(right)
    return both.groupBy(*at, "part", "group").applyInPandas(compare, _FOUND)


def linked_vectors(
    rows: DataFrame, threshold: float = 0.9, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Each vector with its number of links, its component and whether it stays."""
    common.prepare(rows.sparkSession)
    vectors = common.settle(usable(rows, vec_id, vector))
    classes = common.settle(
        vectors.groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    )
    count = classes.count()
    names = rows.select(F.col(vec_id).cast("long").alias("vec_id"))
    if not count:
        none = F.lit(None).cast("long")
        return _result(names.withColumns({"n_links": none, "component": none}))
    index = _index(classes.withColumn("length", (F.octet_length("vector") / 8).cast("int")), threshold)
    found = common.settle(
        _found(index, threshold).groupBy("id", "linked").agg(F.sum("n").alias("n"))
    )
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    members = vectors.join(classes.withColumnRenamed("id", "class"), "vector").select(
        "id", "class", "copies"
    )
    own = members.select(F.col("id").alias("a"), F.col("class").alias("b"))
    joined = components(
        found.select(F.col("id").alias("a"), F.col("linked").alias("b")).unionByName(own)
    )
    links = members.join(counts.withColumnRenamed("id", "class"), "class", "left").select(
        F.col("id").alias("vec_id"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    # An id with different vectors has the links of the one that has most.
    links = links.groupBy("vec_id").agg(F.max("n_links").alias("n_links"))
    return _result(
        names.join(links, "vec_id", "left")
        .join(joined.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    )


def _result(df: DataFrame) -> DataFrame:
    component = F.coalesce("component", "vec_id")
    return df.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )

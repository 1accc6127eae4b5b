"""Near duplicates by MinHash: universal hash minima, banding, verification, components.

A document's set holds its distinct word shingles as 64-bit hashes. 200 hash
functions of the family (a x + b) mod 2^64, with odd a, give its signature of
minima; 40 bands of 5 minima each put it into 40 buckets. Two sets of similarity
0.8 share no bucket with a probability of 1e-7.

Work is kept from growing with the square of a group of copies:

* Documents of one set are one class, named by its smallest id; only classes go on.
* In each bucket every class is compared with the smallest one only. What these
  links connect needs no further comparison, so groups of copies drop out.
* Buckets that still hold several components are then compared in full: pair by
  pair where they are small, and in blocks where they are not, each task getting
  the sets of two blocks and giving back the links only.

A pair is compared by its signatures first (an estimate more than 7 standard
deviations below the threshold drops it) and then on the full sets. Where sets
and signatures come together, they do so in joins that adaptive execution can
split; nothing is gathered by group.

Words are runs of other characters than blank, tab and line ends, letters A to Z
in lower case. NULL, empty and blank texts have an empty set and link with
nothing. Rows without an id link with nothing and have no component. Rows of one
id are one document: what one of them links to, all do. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm import common
from assayer.llm.components import components

BANDS, ROWS = 40, 5
PERMUTATIONS = BANDS * ROWS
SEED = 20_240_817
# Standard deviations of a signature's estimate below the threshold that drop a pair.
DEVIATIONS = 7
# Entries of a worker's table of word hashes; a full one is emptied.
TABLE_WORDS = 150_000
# Ids that are broadcast at most, to fetch their texts.
BROADCAST_IDS = 2_000_000
# Members of buckets that are compared pair by pair, at most.
SMALL = 32
# Documents and shingles of a block on average, and shingles compared at once.
BLOCK_DOCS, BLOCK_SHINGLES, COLUMNS = 256, 1_000_000, 8192
# Shingles hashed at once; with all functions they fit a processor's cache.
BLOCK = 256

SKETCH = "doc_id long, n_shingles long, high long, low long, bands array<long>, signature binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _draw(count: int, stream: int) -> np.ndarray:
    random = np.random.Generator(np.random.PCG64([SEED, stream]))
    return random.integers(0, 2**64, count, dtype=np.uint64)


class Shingler:
    """Sets of shingle hashes, and their minima."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.table: dict[bytes, int] = {}
        self.weights = _draw(words, 1) | np.uint64(1)
        self.short = _draw(words + 1, 2)
        self.a = (_draw(PERMUTATIONS, 3) | np.uint64(1))[:, None]
        self.b = _draw(PERMUTATIONS, 4)[:, None]
        self.band = _draw(ROWS, 5) | np.uint64(1)
        self.bands = _draw(BANDS, 6)

    def hashes(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        new = [w for w in set(words) if w not in self.table]
        if new:
            if len(self.table) + len(new) > TABLE_WORDS:
                self.table = {}
                new = list(set(words))
            self.table.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
        return np.fromiter(map(self.table.__getitem__, words), np.uint64, len(words))

    def set_of(self, text: str | None) -> np.ndarray:
        """The sorted distinct shingle hashes of a text."""
        # On bytes, lower() and split() know the ASCII letters and blanks only.
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        own = self.hashes(words)
        k = min(self.words, len(own))
        total = np.zeros(len(own) - k + 1, np.uint64)
        for i in range(k):
            total += own[i : len(own) - k + 1 + i] * self.weights[i]
        if k < self.words:
            total += self.short[k]
        return np.unique(_mixed(total))

    def minima(self, own: np.ndarray) -> np.ndarray:
        """The upper halves of the smallest value of each hash function over a set."""
        least = np.full(PERMUTATIONS, 2**64 - 1, np.uint64)
        for i in range(0, len(own), BLOCK):
            values = self.a * own[None, i : i + BLOCK]
            values += self.b
            np.minimum(least, values.min(axis=1), out=least)
        return least >> np.uint64(32)

    def keys(self, minima: np.ndarray) -> np.ndarray:
        """A key for each band."""
        rows = (minima.reshape(BANDS, ROWS) * self.band).sum(axis=1, dtype=np.uint64)
        return _mixed(_mixed(rows) + self.bands).view(np.int64)


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def sketches(docs: DataFrame, words: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Set size, set hash, band keys and signature of each document."""
    common.prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        from assayer.llm.neardup import Shingler, _signed

        make = Shingler(words)
        for batch in batches:
            for part in common.slices(batch, "text"):
                rows = []
                for body in part.column("text").to_pylist():
                    own = make.set_of(body)
                    if not len(own):
                        rows.append((0, 0, 0, None, None))
                        continue
                    name = xxhash.xxh3_128_intdigest(own.tobytes())
                    minima = make.minima(own)
                    halves = (_signed(name >> 64), _signed(name & (2**64 - 1)))
                    short = minima.astype(np.uint16).tobytes()
                    rows.append((len(own), *halves, make.keys(minima), short))
                kinds = [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                names = ["doc_id", "n_shingles", "high", "low", "bands", "signature"]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=names)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, SKETCH)


def _shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """The sets of documents (doc_id, text) as sorted 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from assayer.llm.neardup import Shingler

        make = Shingler(words)
        for batch in batches:
            for part in common.slices(batch, "text"):
                sets = [make.set_of(t).tobytes() for t in part.column("text").to_pylist()]
                columns = [part.column("doc_id"), pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "members"])

    return docs.mapInArrow(run, "doc_id long, members binary")


def _with_both(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """Pairs with a value of their ends as `of_a` and `of_b`."""
    for end in ("a", "b"):
        own = values.select(F.col("doc_id").alias(end), F.col(name).alias(f"of_{end}"))
        pairs = pairs.join(own, end)
    return pairs


def _kept_pairs(pairs: DataFrame, enough) -> DataFrame:
    """The pairs whose two values pass a test, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = zip(batch.column("of_a"), batch.column("of_b"), strict=True)
            kept = pa.array([enough(x.as_buffer(), y.as_buffer()) for x, y in values], pa.bool_())
            yield batch.select(["a", "b"]).filter(kept)

    return pairs.select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long").distinct()


def verified(
    pairs: DataFrame, signatures: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """The pairs whose full sets have at least `percent` of their union in common."""
    near = percent / 100
    least = near - DEVIATIONS * (near * (1 - near) / PERMUTATIONS) ** 0.5

    def alike(x: pa.Buffer, y: pa.Buffer) -> bool:
        same = np.frombuffer(x, np.uint16) == np.frombuffer(y, np.uint16)
        return bool(same.mean() >= least)

    def linked(x: pa.Buffer, y: pa.Buffer) -> bool:
        one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = np.concatenate([one, two])
        both.sort(kind="stable")
        common_size = int((both[1:] == both[:-1]).sum())
        return 100 * common_size >= percent * (len(both) - common_size)

    likely = _kept_pairs(_with_both(pairs, signatures, "signature"), alike)
    return common.settle(_kept_pairs(_with_both(likely, sets, "members"), linked))


def _semi_join(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents of some ids; few enough ids are broadcast, so that no text is shuffled."""
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")


def _mixed_buckets(members: DataFrame, joined: DataFrame) -> DataFrame:
    """The members of buckets with several components: (key, id, size, component).

    `held` is the number of members in the bucket, and `family` its largest component.
    """
    placed = members.join(joined.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", "size", F.coalesce("component", "id").alias("component")
    )
    own = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    buckets = own.groupBy("key").agg(
        F.count(F.lit(1)).alias("kinds"),
        F.sum("n").alias("held"),
        F.max(F.struct("n", (-F.col("component")).alias("component"))).alias("most"),
    )
    mixed = buckets.filter("kinds > 1").select(
        "key", "held", (-F.col("most.component")).alias("family")
    )
    return common.settle(placed.join(mixed, "key"))


def _small_buckets(mixed: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a < b) of different components whose sizes allow the similarity."""
    small = mixed.filter(F.col("held") <= SMALL)
    one = small.select("key", F.col("id").alias("a"), F.col("size").alias("of_a"), F.col("component").alias("in_a"))
    two = one.toDF("key", "b", "of_b", "in_b")
    least, most = F.least("of_a", "of_b"), F.greatest("of_a", "of_b")
    near = (F.col("a") < F.col("b")) & (F.col("in_a") != F.col("in_b")) & (100 * least >= percent * most)
    return one.join(two, "key").filter(near).select("a", "b").distinct()


def _linked_blocks(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links of the documents of two blocks, as the smallest linked id of each."""
    sets = [np.frombuffer(m, np.uint64) for m in rows["members"]]
    size = np.array([len(s) for s in sets])
    tokens, column = np.unique(np.concatenate(sets), return_inverse=True)
    doc = np.repeat(np.arange(len(sets)), size)
    first, second = (np.flatnonzero(rows[c].to_numpy(bool)) for c in ("first", "second"))
    both = np.zeros((len(first), len(second)), np.float32)
    by_column = np.argsort(column, kind="stable")
    column, doc = column[by_column], doc[by_column]
    for start in range(0, len(tokens), COLUMNS):
        low, high = np.searchsorted(column, [start, start + COLUMNS])
        held = np.zeros((len(sets), min(COLUMNS, len(tokens) - start)), np.float32)
        held[doc[low:high], column[low:high] - start] = 1
        both += held[first] @ held[second].T
    component, ids = rows["component"].to_numpy(), rows["id"].to_numpy()
    total = size[first][:, None] + size[second]
    near = (100 + percent) * both.astype(np.int64) >= percent * total
    near &= component[first][:, None] != component[second]
    a, b = np.nonzero(near)
    a, b = ids[first[a]], ids[second[b]]
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()


def _large_buckets(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components in buckets of more members, compared in blocks.

    Buckets with the same largest component are one family, so a group of copies
    that shares many buckets is compared once. A family is dealt into blocks of
    bounded size, and each two blocks are compared by a task.
    """
    family = mixed.filter(F.col("held") > SMALL).select("family", "id", "size", "component").distinct()
    family = common.settle(family)
    count, total = F.count(F.lit(1)) / BLOCK_DOCS, F.sum("size") / BLOCK_SHINGLES
    blocks = family.groupBy("family").agg(F.ceil(F.greatest(count, total)).alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt = family.join(blocks, "family").select("family", "id", "component", own.alias("own"), every)
    dealt = dealt.join(sets.withColumnRenamed("doc_id", "id"), "id").select(
        "family",
        F.least("own", "other").alias("x"),
        F.greatest("own", "other").alias("y"),
        (F.col("own") <= F.col("other")).alias("first"),
        (F.col("own") >= F.col("other")).alias("second"),
        "id",
        "component",
        "members",
    )

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        from assayer.llm.neardup import _linked_blocks

        return _linked_blocks(rows, percent)

    return dealt.groupBy("family", "x", "y").applyInPandas(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Each document with its set's size, its component and whether it stays.

    Components are named by their smallest id, whose document stays.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = common.settle(sketches(rows, words))
    known = found.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = common.settle(known.groupBy("high", "low").agg(F.min("doc_id").alias("class")))
    named = known.join(
        classes.withColumnRenamed("class", "doc_id"), ["high", "low", "doc_id"], "left_semi"
    )
    buckets = named.select(
        F.explode("bands").alias("key"), F.col("doc_id").alias("id"), F.col("n_shingles").alias("size")
    )
    shared = buckets.groupBy("key").agg(F.min("id").alias("star"), F.max("id").alias("last"))
    members = buckets.join(shared.filter("star < last").select("key", "star"), "key")
    members = common.settle(members)
    ids = common.settle(members.select(F.col("id").alias("doc_id")).distinct())
    signatures = named.join(ids, "doc_id", "left_semi").select("doc_id", "signature")
    signatures = common.settle(signatures)
    sets = common.settle(_shingle_sets(_semi_join(rows, ids), words))

    stars = members.filter("id > star").select(F.col("star").alias("a"), F.col("id").alias("b"))
    links = verified(stars.distinct(), signatures, sets, percent)
    mixed = _mixed_buckets(members, common.settle(components(links)))
    links = links.unionByName(verified(_small_buckets(mixed, percent), signatures, sets, percent))
    links = links.unionByName(_large_buckets(mixed, sets, percent))

    # A class links its members; rows of one id in several classes link these.
    own = known.join(classes, ["high", "low"]).select(F.col("class").alias("a"), F.col("doc_id").alias("b"))
    joined = components(links.unionByName(own.filter("a <> b").distinct()))
    return (
        found.select("doc_id", "n_shingles")
        .join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .withColumn("component_id", F.coalesce("component", "doc_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .drop("component")
    )


def one_of_each(
    docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of each group of near duplicates, and all rows without words.

    Rows are told apart by the hash of their id and text, so only texts decide: rows
    that share an id or have none are compared like all others. Of rows alike in both
    one stays.
    """
    key = common.free_name(docs, "key")
    keyed = docs.withColumn(key, F.xxhash64(doc_id, text))
    found = common.settle(near_duplicates(keyed, words, percent, key, text))
    # Of a group the row of the smallest id stays; one without an id only if none has one.
    ids = keyed.select(key, F.col(doc_id).cast("long").alias("id")).distinct()
    groups = found.select(F.col("doc_id").alias(key), "component_id").distinct().join(ids, key)
    place = F.struct(F.col("id").isNull(), "id", key)
    first = groups.groupBy("component_id").agg(F.min(place)[key].alias("stays"), F.count("*").alias("n"))
    gone = groups.join(first.filter("n > 1"), "component_id").filter(F.col(key) != F.col("stays"))
    gone = common.settle(gone.select(key))
    kept = common.without(keyed, gone, key)
    own = found.filter("n_shingles > 0").groupBy(F.col("doc_id").alias(key)).count()
    repeated = common.settle(own.filter("count > 1").select(key))
    if repeated.isEmpty():
        return kept.drop(key)
    single = common.without(kept, repeated, key)
    several = kept.join(repeated, key, "left_semi").dropDuplicates([key])
    return single.unionByName(several).drop(key)

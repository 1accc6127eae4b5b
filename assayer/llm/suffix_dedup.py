"""Removal of passages that repeat across documents, by distributed suffix sorting.

A passage is a string of `size` bytes (50). Documents lie in blocks, compressed,
in the shared folder. Strings that are equal have the same minimizer (the
smallest hash among their 20-byte parts), so all places of a passage meet if
suffixes are dealt by the minimizer of their first 50 bytes:

1. Each block gives its distinct minimizers, sorted and named by their rank;
   each range of them is merged over all blocks, and a block hears which of its
   minimizers occur in another document. Suffixes of all others are discarded.
2. Of what is left, runs of suffixes with one minimizer travel as one piece of
   text, each distinct piece of a block once. The texts of a range of minimizers
   are sorted as suffixes by difference covers (`suffix_array`), and adjacent
   prefixes of 50 bytes are compared byte by byte. A block hears of each suffix
   whether it starts in a document of smaller id.
3. Blocks put the passages together to spans of bytes.

What blocks hear is written to the shared folder by block, so texts never move:
only minimizers and pieces of repeated text are shuffled. A minimizer that
occurs very often is dealt on by the passages themselves, each distinct one of a
block once. Documents equal to one of smaller id are told by a digest of the
whole text before all this and do not take part.

NULL texts are empty. Rows without an id are left as they are and do not count.
Rows of one id do not remove each other's text, as none has the smaller id;
repeated rows are kept one to one. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from assayer.llm import common
from assayer.llm.suffix_array import equal_to_previous, suffix_order

SIZE = 50
# Bytes of the parts of a passage that the minimizer is chosen from.
PART = 20
# Text bytes of a block; of input for each range of minimizers and of pieces.
BLOCK_BYTES, NAME_BYTES, PIECE_BYTES = 8 << 20, 8 << 20, 2 << 20
# Bytes hashed at once, suffixes of a piece, bytes sorted at once.
STRIDE, RUN, CHUNK = 1 << 20, 64, 1 << 18
# Runs of a minimizer that are sorted in one place; more are dealt on.
OFTEN = 8192
# Parts that the documents of one text are dealt to.
SALTS = 8
MANY = 0x8000

# Rows that the workers make, as Arrow and as Spark types.
_LONG, _BINARY = pa.int64(), pa.binary()
_PACKED = pa.schema(
    [
        ("block", _LONG),
        ("ids", pa.list_(_LONG)),
        ("sizes", pa.list_(_LONG)),
        ("digests", pa.list_(_BINARY)),
        ("packed", _BINARY),
    ]
)
_NAMES = pa.schema([("block", _LONG), ("bucket", _LONG), ("names", _BINARY), ("counts", _BINARY)])
_CODES = pa.schema([("part", _LONG), ("block", _LONG), ("bucket", _LONG), ("codes", _BINARY)])
_KEY = [("block", _LONG), ("bucket", _LONG), ("sub", _LONG)]
_PIECES = pa.schema([*_KEY, *[(c, _BINARY) for c in ("names", "owners", "lengths", "content")]])
_LATER = pa.schema([("part", _LONG), *_KEY, ("later", _BINARY)])
_SPAN = pa.struct([("start", _LONG), ("end", _LONG)])
SPANS = pa.schema(
    [("doc_id", _LONG), ("n_bytes", _LONG), ("spans", pa.list_(_SPAN)), ("kept", _BINARY)]
)


def _letters() -> np.ndarray:
    """A number for each byte, mixed."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def minimizers(data: np.ndarray, size: int, part: int) -> np.ndarray:
    """The smallest hash of the parts of each string of `size` bytes.

    Hashes of 2, 4, ... bytes come from two of half the length, and so do minima.
    """
    value, length, found, taken = _letters()[data], 1, None, 0
    factor, all_bits = 0x9E3779B97F4A7C15 | 1, (1 << 64) - 1
    while True:
        if part & length:
            if found is None:
                found = value
            else:
                found = found[: len(value) - taken] + value[taken:][: len(found)] * np.uint64(
                    pow(factor, taken, 1 << 64) & all_bits
                )
            taken += length
        if 2 * length > part:
            break
        value = value[:-length] + value[length:] * np.uint64(pow(factor, length, 1 << 64))
        length *= 2
    found = (found ^ (found >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    found ^= found >> np.uint64(29)
    width, length = size - part + 1, 1
    while 2 * length <= width:
        found = np.minimum(found[:-length], found[length:])
        length *= 2
    rest = width - length
    return np.minimum(found[: len(found) - rest], found[rest:]) if rest else found


class Runs:
    """Runs of suffixes with one minimizer, for the documents of a block.

    `names` (minimizers), `starts` (places in the block), `counts` (suffixes) and
    `docs` (row of the document) of all runs, in the order of their places.
    """

    def __init__(self, data: np.ndarray, sizes: np.ndarray, takes_part: np.ndarray) -> None:
        ends, row = np.cumsum(sizes), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        # The last place of a document that a passage can start at.
        last = np.where(takes_part, ends - SIZE, -1)
        parts = []
        for low in range(0, len(data), STRIDE):
            value = data[low : low + STRIDE + SIZE - 1]
            if len(value) < SIZE:
                break
            value = minimizers(value, SIZE, PART)
            place = np.arange(low, low + len(value))
            doc = row[low : low + len(value)]
            good = place <= last[doc]
            value, place, doc = value[good], place[good], doc[good]
            new = np.ones(len(value), bool)
            new[1:] = (value[1:] != value[:-1]) | (place[1:] != place[:-1] + 1)
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(value)))
            # Runs of a constant text have no end of their own.
            pieces = -(-count // RUN)
            inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first, count = np.repeat(first, pieces) + inner * RUN, np.repeat(count, pieces) - inner * RUN
            parts.append((value[first], place[first], np.minimum(count, RUN), doc[first]))
        columns = zip(*parts, strict=True) if parts else [[np.empty(0, t)] for t in ("u8", "i8", "i8", "i8")]
        self.names, self.starts, self.counts, self.docs = (np.concatenate(c) for c in columns)


def bucket_of(names: np.ndarray, buckets: int) -> np.ndarray:
    """The range that a minimizer falls in; ranges keep their order."""
    return ((names >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def ranges(buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Values of a sorted row with where each begins and ends."""
    values, first = np.unique(buckets, return_index=True)
    yield from zip(values.tolist(), first.tolist(), [*first[1:].tolist(), len(buckets)], strict=True)


class Block:
    """The documents of a block. `gone` are the rows of those equal to an earlier one."""

    def __init__(self, row: dict, gone: set[int] = frozenset()) -> None:
        import zstandard

        self.number = row["block"]
        content = zstandard.ZstdDecompressor().decompress(row["packed"]) if row["packed"] else b""
        self.content, self.data = content, np.frombuffer(content, np.uint8)
        self.ids, self.sizes = row["ids"], np.array(row["sizes"], np.int64)
        self.gone = gone
        takes_part = [i is not None and k not in gone for k, i in enumerate(self.ids)]
        self.runs = Runs(self.data, self.sizes, np.array(takes_part, bool))
        self.owner = np.array([0 if i is None else i for i in self.ids], np.int64)

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct minimizers, and how often each occurs, marked if in several documents."""
        owner = self.owner[self.runs.docs]
        order = np.lexsort((owner, self.runs.names))
        names, owner = self.runs.names[order], owner[order]
        values, first, count = np.unique(names, return_index=True, return_counts=True)
        several = owner[first] != owner[first + count - 1]
        return values, np.minimum(count, MANY - 1) | (several * MANY)

    def pieces(self, codes: np.ndarray, buckets: int) -> Pieces:
        return Pieces(self, codes, buckets)


class Pieces:
    """The distinct pieces of repeated text in a block, sorted by where they go.

    Of each run that is left: `piece`, its number. Of each piece: its minimizer,
    the smallest id of a document it occurs in, and its text.
    """

    def __init__(self, block: Block, codes: np.ndarray, buckets: int) -> None:
        runs = block.runs
        ranked = np.sort(runs.names)
        place = np.searchsorted(ranked[np.diff(ranked, prepend=~ranked[:1]) != 0], runs.names)
        left = np.flatnonzero(codes[place] > 0)
        code = codes[place[left]].astype(np.int64)
        # Often met minimizers go by single suffixes.
        count = np.where(code > 1, runs.counts[left], 1)
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        left, code = np.repeat(left, count), np.repeat(code, count)
        self.starts = runs.starts[left] + inner
        self.counts = np.where(code > 1, 1, runs.counts[left])
        self.docs = runs.docs[left]
        ends = self.starts + self.counts + SIZE - 1
        seen: dict[bytes, int] = {}
        texts = [block.content[i:j] for i, j in zip(self.starts.tolist(), ends.tolist(), strict=True)]
        piece = np.array([seen.setdefault(t, len(seen)) for t in texts], np.int64)
        texts = list(seen)
        first = np.unique(piece, return_index=True)[1]
        owner = np.full(len(texts), np.iinfo(np.int64).max)
        np.minimum.at(owner, piece, block.owner[self.docs])
        names = runs.names[left][first]
        code = code[first]
        sub = np.array([zlib.crc32(t) % (1 << c - 1) if c > 1 else 0 for t, c in zip(texts, code.tolist(), strict=True)], np.int64)
        bucket = bucket_of(names, buckets).astype(np.int64)
        order = np.lexsort((np.arange(len(texts)), names, sub, bucket))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.piece = back[piece]
        self.names, self.owner, self.bucket, self.sub = (x[order] for x in (names, owner, bucket, sub))
        self.texts = [texts[i] for i in order.tolist()]
        self.suffixes = np.array([len(t) - SIZE + 1 for t in self.texts], np.int64)

    def rows(self, number: int) -> Iterator[dict]:
        for bucket, i, j in ranges(self.bucket):
            for sub, k, m in ranges(self.sub[i:j]):
                at = slice(i + k, i + m)
                yield {
                    "block": number,
                    "bucket": bucket,
                    "sub": sub,
                    "names": self.names[at].tobytes(),
                    "owners": self.owner[at].tobytes(),
                    "lengths": self.suffixes[at].astype(np.uint8).tobytes(),
                    "content": b"".join(self.texts[at]),
                }


def code_names(table: pa.Table) -> Iterator[dict]:
    """Which minimizers of a range occur in several documents: 0 if not, else 1, or
    more for one that is met so often that it is dealt on to 2 ** (code - 1) places.
    """
    rows = table.to_pylist()
    names = np.concatenate([np.frombuffer(r["names"], "<u8") for r in rows])
    counts = np.concatenate([np.frombuffer(r["counts"], "<u2") for r in rows]).astype(np.int64)
    values, place, blocks = np.unique(names, return_inverse=True, return_counts=True)
    total = np.bincount(place, counts & (MANY - 1), len(values))
    several = (blocks > 1) | (np.bincount(place, counts >= MANY, len(values)) > 0)
    spread = np.ceil(np.log2(np.maximum(total / OFTEN, 1))).astype(np.int64)
    code = np.where(several, np.minimum(1 + spread, 31), 0).astype(np.uint8)[place]
    ends = np.cumsum([len(r["names"]) // 8 for r in rows])
    for row, own in zip(rows, np.split(code, ends[:-1]), strict=True):
        yield {**{k: row[k] for k in ("block", "bucket")}, "part": row["block"] >> 32, "codes": own.tobytes()}


def find_later(table: pa.Table) -> Iterator[dict]:
    """For each suffix of the pieces, whether its passage starts in a document of
    smaller id than the piece's own.
    """
    rows = table.to_pylist()
    names = np.concatenate([np.frombuffer(r["names"], "<u8") for r in rows])
    owners = np.concatenate([np.frombuffer(r["owners"], "<i8") for r in rows])
    counts = np.concatenate([np.frombuffer(r["lengths"], np.uint8) for r in rows]).astype(np.int64)
    data = np.frombuffer(b"".join(r["content"] for r in rows), np.uint8)
    lengths = counts + SIZE - 1
    starts, first = np.cumsum(lengths) - lengths, np.cumsum(counts) - counts
    order = np.argsort(names, kind="stable")
    later = np.zeros(int(counts.sum()), bool)
    # Some minimizers at a time; those of equal names stay together.
    reach = np.cumsum(lengths[order])
    new = np.flatnonzero(np.diff(names[order])) + 1
    cuts, low = [0], 0
    for cut in new.tolist():
        if reach[cut - 1] - low > CHUNK:
            cuts.append(cut)
            low = reach[cut - 1]
    cuts.append(len(order))
    for i, j in zip(cuts, cuts[1:], strict=False):
        own = order[i:j]
        _mark_later(data, starts[own], lengths[own], counts[own], owners[own], first[own], later)
    ends = np.cumsum([int(np.frombuffer(r["lengths"], np.uint8).sum(dtype=np.int64)) for r in rows])
    for row, bits in zip(rows, np.split(later, ends[:-1]), strict=True):
        key = {k: row[k] for k in ("block", "bucket", "sub")}
        yield {**key, "part": row["block"] >> 32, "later": np.packbits(bits).tobytes()}


def expand(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Numbers from each first one on, so many of each."""
    return np.arange(counts.sum()) + np.repeat(first - (np.cumsum(counts) - counts), counts)


def _mark_later(data, starts, lengths, counts, owners, first, later) -> None:
    # The pieces one after the other, a 0 behind each.
    ends = np.cumsum(lengths + 1)
    begins = ends - lengths - 1
    text = np.zeros(int(ends[-1]), np.int64)
    whole = expand(begins, lengths)
    text[whole] = data[expand(starts, lengths)]
    text[whole] += 2
    text[ends - 1] = 1
    places = suffix_order(text, SIZE)
    suffix = np.full(len(text), -1)
    suffix[expand(begins, counts)] = expand(first, counts)
    owner = np.repeat(owners, lengths + 1)
    places = places[suffix[places] >= 0]
    # Bytes as they were, so that the comparison is of what the texts hold.
    group = np.flatnonzero(~equal_to_previous((text - 2).astype(np.uint8), places, SIZE))
    least = np.minimum.reduceat(owner[places], group)
    size = np.diff(np.append(group, len(places)))
    later[suffix[places]] = np.repeat(least, size) < owner[places]


class Heard:
    """What was written for the blocks of a part, read from the shared folder."""

    def __init__(self, folder: str) -> None:
        self.folder = folder
        self.part, self.rows = -1, {}

    def __call__(self, block: int) -> list[dict]:
        from pyarrow import dataset, fs

        if self.part != block >> 32:
            self.part, self.rows = block >> 32, {}
            files, name = fs.FileSystem.from_uri(f"{self.folder}/part={self.part}")
            if files.get_file_info(name).type == fs.FileType.Directory:
                table = dataset.dataset(name, filesystem=files, format="parquet").to_table()
                for row in table.to_pylist():
                    self.rows.setdefault(row["block"], []).append(row)
        return self.rows.get(block, [])


def _tell(rows: DataFrame, folder: str) -> Heard:
    """Write rows so that the blocks of a part find theirs in one place."""
    rows.repartition("part").write.partitionBy("part").parquet(folder)
    return Heard(folder)


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int = 256) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def pack(docs: DataFrame, doc_id: str, text: str, block_bytes: int) -> DataFrame:
    """Documents in compressed blocks, computed once; a block's part is block >> 32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        number, compressor = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in common.slices(batch, "text", block_bytes):
                row = {"block": number, "ids": part.column("id").to_pylist()}
                row["digests"] = part.column("digest").to_pylist()
                texts = part.column("text").cast(pa.binary())
                row["sizes"] = pc.binary_length(texts).to_pylist()
                row["packed"] = compressor.compress(b"".join(texts.to_pylist()))
                yield pa.RecordBatch.from_pylist([row], _PACKED)
                number += 1

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), common.text_of(text).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    return common.settle(rows.mapInArrow(run, from_arrow_schema(_PACKED)))


def _gone(packed: DataFrame, size: int) -> DataFrame:
    """Documents of `size` bytes or more that equal one of smaller id: (part, block, row)."""
    each = packed.select("block", F.posexplode(F.arrays_zip("ids", "sizes", "digests")).alias("row", "d"))
    each = each.select("block", "row", "d.ids", "d.sizes", F.col("d.digests").alias("digest"))
    each = each.filter((F.col("sizes") >= size) & F.col("ids").isNotNull())
    least = each.groupBy(F.col("digest").alias("known")).agg(F.min("ids").alias("least"), F.max("ids").alias("most"))
    # Salted, as very many documents may be the same.
    salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt")
    least = least.filter("least < most").select("known", "least", salts)
    same = (F.col("digest") == F.col("known")) & (F.pmod("row", F.lit(SALTS)) == F.col("salt"))
    found = each.join(least, same & (F.col("ids") > F.col("least")))
    return found.select(F.shiftright("block", 32).alias("part"), "block", "row")


def repeated_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Each document with its size in bytes, the spans of bytes (end exclusive) that
    are removed from it, and the bytes kept.
    """
    spark = common.prepare(docs.sparkSession)
    packed = pack(docs, doc_id, text, block_bytes)
    total = packed.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    name_buckets, buckets = 1 + total // NAME_BYTES, 1 + total // PIECE_BYTES
    folder = common.scratch(spark, "suffixes")
    gone = _tell(_gone(packed, SIZE), f"{folder}/gone")

    def blocks(batches: Iterator[pa.RecordBatch], columns=("block", "ids", "sizes", "packed")):
        from assayer.llm.suffix_dedup import Block

        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).select(list(columns)).to_pylist()[0]
                yield Block(row, {g["row"] for g in gone(row["block"])})

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from assayer.llm.suffix_dedup import bucket_of, ranges

        def rows():
            for block in blocks(batches):
                names, counts = block.names()
                for bucket, i, j in ranges(bucket_of(names, name_buckets).astype(np.int64)):
                    own = {"names": names[i:j].tobytes(), "counts": counts[i:j].astype("<u2").tobytes()}
                    yield {"block": block.number, "bucket": bucket, **own}

        yield from _batches(rows(), _NAMES)

    def code(table: pa.Table) -> pa.Table:
        from assayer.llm.suffix_dedup import code_names

        return pa.Table.from_pylist(list(code_names(table)), _CODES)

    packed_only = packed.drop("digests")
    named = packed_only.mapInArrow(name, from_arrow_schema(_NAMES))
    named = named.groupBy("bucket").applyInArrow(code, from_arrow_schema(_CODES))
    codes = _tell(named, f"{folder}/codes")

    def pieces_of(block):
        from assayer.llm.suffix_dedup import Pieces

        found = sorted(codes(block.number), key=lambda r: r["bucket"])
        return Pieces(block, np.frombuffer(b"".join(r["codes"] for r in found), np.uint8), buckets)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for block in blocks(batches) for row in pieces_of(block).rows(block.number))
        yield from _batches(rows, _PIECES)

    def sort(table: pa.Table) -> pa.Table:
        from assayer.llm.suffix_dedup import find_later

        return pa.Table.from_pylist(list(find_later(table)), _LATER)

    cut_out = packed_only.mapInArrow(cut, from_arrow_schema(_PIECES))
    sorted_pieces = cut_out.groupBy("bucket", "sub").applyInArrow(sort, from_arrow_schema(_LATER))
    later = _tell(sorted_pieces, f"{folder}/later")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from assayer.llm.suffix_dedup import finished

        for block in blocks(batches):
            found = sorted(later(block.number), key=lambda r: (r["bucket"], r["sub"]))
            yield from finished(block, pieces_of(block), found)

    return packed_only.mapInArrow(finish, from_arrow_schema(SPANS))


def finished(block: Block, pieces: Pieces, found: list[dict], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The documents of a block with what is removed and what is kept."""
    bits, at = [], 0
    for _, i, j in ranges(pieces.bucket):
        for _, k, m in ranges(pieces.sub[i:j]):
            count = int(pieces.suffixes[i + k : i + m].sum())
            bits.append(np.unpackbits(np.frombuffer(found[at]["later"], np.uint8), count=count).astype(bool))
            at += 1
    later = np.concatenate([*bits, np.empty(0, bool)])
    # For each suffix of a run: its piece's, or a smaller id met in this block.
    first = np.cumsum(pieces.suffixes) - pieces.suffixes
    own = block.owner[pieces.docs] > pieces.owner[pieces.piece]
    removed = later[expand(first[pieces.piece], pieces.counts)] | np.repeat(own, pieces.counts)
    places = expand(pieces.starts, pieces.counts)[removed]
    # A byte is covered if a removed passage starts at one of the last places.
    begun = np.zeros(len(block.data), bool)
    begun[places] = True
    begun = np.cumsum(begun, dtype=np.int32)
    covered = begun > np.concatenate([np.zeros(SIZE, np.int32), begun[:-SIZE]])[: len(begun)]
    ends = np.cumsum(block.sizes)
    for k, i, j in zip(range(len(ends)), (ends - block.sizes).tolist(), ends.tolist(), strict=False):
        if k in block.gone:
            covered[i:j] = True
    before = np.concatenate([[0], np.cumsum(covered)])
    some = (before[ends] > before[ends - block.sizes]).tolist()

    def documents() -> Iterator[dict]:
        for k, (i, j) in enumerate(zip((ends - block.sizes).tolist(), ends.tolist(), strict=True)):
            spans, kept = [], block.content[i:j]
            if some[k]:
                mine = np.concatenate([[False], covered[i:j], [False]])
                edges = np.flatnonzero(mine[1:] != mine[:-1]).reshape(-1, 2).tolist()
                spans = [{"start": a, "end": b} for a, b in edges]
                kept = block.data[i:j][~mine[1:-1]].tobytes()
            yield {"doc_id": block.ids[k], "n_bytes": j - i, "spans": spans, "kept": kept}

    yield from _batches(documents(), SPANS, rows)

"""Token ids in binary files of independent zstandard frames, and reading them back.

A file holds a range of documents in ascending id order, one frame a document:
its token ids as little-endian unsigned 32-bit integers, the end id last. Behind
the frames stand two skippable frames, so that any zstandard reader can read the
whole file: an index with the document ids, and a seek table in the seekable
format of zstandard (compressed and decompressed size of each frame and the low
half of the XXH64 of its content; then the number of frames, a descriptor and a
magic number, by which it is found from the end). A reader takes the tables and
then just the frames it wants, checking each.

Files are written to a name of their own by each attempt of a task and then
renamed, so a lost executor leaves no half file under a final name.

Texts are cut where no token of a byte-level model crosses, and each distinct
chunk of a batch is encoded once by the library, and only if the worker has not met
it in earlier batches. Batches with a NUL character or
the text of a special token go through the library as they are.

NULL and empty texts have the end id only. Repeated rows and ids are all kept,
those of one id ordered by the hash of their text; rows without an id come
first. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayer.llm import common
from assayer.llm.distinct import CUT, Chunks, Known, close_each, flat

# Fixed values of the zstandard skippable and seekable formats.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

LEVEL = 3
NO_ID = -(2**63)
# Text bytes worked on at once, and words whose ids a worker keeps.
TABLE_BYTES, WORDS = 6 << 20, 300_000
# Words tokenized in one text.
ROW = 200

MANIFEST = "part int, path string, n_docs long, n_tokens long"
FRAMES = (
    "path string, doc_id long, start long, n_tokens long, offset long, size long, checksum long"
)

# Where the usual byte-level pattern always ends a token: before a blank behind
# a character that is none; between a letter and what is no letter; between a
# sign and a letter, but for the apostrophe, which may begin a contraction.
_SPACES = r"\s\pZ\x0b\x{85}\x1c-\x1f"
_CUTS = (
    (f"([^{_SPACES}]) ", f"\\1{CUT} "),
    (f"(\\pL)([^\\pL{CUT}])", f"\\1{CUT}\\2"),
    (f"([^\\pL\\pN{_SPACES}{CUT}'])(\\pL)", f"\\1{CUT}\\2"),
)
_TABLES: dict[str, WordIds] = {}


class WordIds:
    """Token ids of texts by a byte-level tokenizer of the library."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        step = json.loads(self.library.to_str()).get("pre_tokenizer") or {}
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        if (step.get("type"), step.get("add_prefix_space")) != ("ByteLevel", False):
            raise ValueError("the tokenizer does not cut texts by the byte-level pattern")
        self.known = Known(self.words, WORDS)

    @classmethod
    def of(cls, path: str) -> WordIds:
        if path not in _TABLES:
            _TABLES[path] = cls(path)
        return _TABLES[path]

    def whole(self, texts: list[str]) -> list[list[int]]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [f.ids for f in found]

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of words. Blanks with letters behind them, which are tokenized
        one by one also in a row, go through the library many in one text.
        """
        plain = [w[:1] == " " and w[1:].isalpha() for w in words]
        rows = [w for w, p in zip(words, plain, strict=True) if p]
        rows = [rows[i : i + ROW] for i in range(0, len(rows), ROW)]
        found = self.library.encode_batch(["".join(r) for r in rows], add_special_tokens=False)
        counts, parts = [], []
        for row, encoding in zip(rows, found, strict=True):
            number = np.bincount(encoding.word_ids, minlength=len(row))
            if len(number) > len(row):  # a character that only Python takes for a letter
                number, ids = flat(self.whole(row))
            else:
                ids = np.array(encoding.ids, np.uint32)
            counts.append(number)
            parts.append(ids)
        other_counts, other = flat(self.whole([w for w, p in zip(words, plain, strict=True) if not p]))
        sizes = np.empty(len(words), np.int64)
        flags = np.array(plain)
        sizes[flags] = np.concatenate([*counts, np.empty(0, np.int64)])
        sizes[~flags] = other_counts
        values = np.empty(int(sizes.sum()), np.uint32)
        of_plain = np.repeat(flags, sizes)
        values[of_plain] = np.concatenate([*parts, np.empty(0, np.uint32)])
        values[~of_plain] = other
        return sizes, values

    def encode(self, texts: pa.Array, end_id: int) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers, the end id last."""
        odd = [pc.match_substring(texts, s) for s in (CUT, *self.special)]
        if any(pc.any(o).as_py() for o in odd):
            parts = [np.array([*ids, end_id], "<u4") for ids in self.whole(texts.to_pylist())]
            return [p.tobytes() for p in parts]
        chunks = Chunks(texts, _CUTS)
        values, ends = close_each(*chunks.ids(*self.known(chunks.words)), end_id)
        content = values.astype("<u4").tobytes()
        return [content[4 * a : 4 * b] for a, b in itertools.pairwise(ends.tolist())]


class FrameWriter:
    """Writes one file; `add` documents in order, then `close`."""

    def __init__(self, path: str, level: int = LEVEL) -> None:
        import zstandard
        from pyarrow import fs

        self.files, self.path = fs.FileSystem.from_uri(path)
        self.trial = f"{self.path}.{TaskContext.get().taskAttemptId()}.tmp"
        self.out = self.files.open_output_stream(self.trial)
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.ids: list[int] = []
        self.seek: list[bytes] = []
        self.tokens = 0

    def add(self, doc_id: int | None, payload: bytes) -> None:
        import xxhash

        frame = self.compressor.compress(payload)
        self.out.write(frame)
        check = xxhash.xxh64_intdigest(payload) & 0xFFFFFFFF
        self.seek.append(struct.pack("<III", len(frame), len(payload), check))
        self.ids.append(NO_ID if doc_id is None else doc_id)
        self.tokens += len(payload) // 4

    def close(self) -> None:
        index = np.array(self.ids, dtype="<i8").tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        footer = struct.pack("<IBI", len(self.seek), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        table = b"".join(self.seek) + footer
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)
        self.out.close()
        self.files.move(self.trial, self.path)


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    folder: str,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Write all documents to files in a folder; one row per file.

    The frame is computed once, and its rows say which files are complete.
    """
    spark = common.prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.text_of(text).alias("text"))
    # The hash breaks ties, and spreads rows that share an id or have none.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(common.partitions(spark), *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from assayer.llm.token_files import FrameWriter, WordIds

        part = TaskContext.get().partitionId()
        path = f"{folder}/part-{part:06d}.zst"
        words, out = WordIds.of(tokenizer_path), None
        for batch in batches:
            for piece in common.slices(batch, "text", TABLE_BYTES):
                out = out or FrameWriter(path)
                payloads = words.encode(piece.column("text"), end_id)
                for key, payload in zip(piece.column("doc_id").to_pylist(), payloads, strict=True):
                    out.add(key, payload)
        if out:
            out.close()
            row = {"part": part, "path": path, "n_docs": len(out.ids), "n_tokens": out.tokens}
            types = [("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64())]
            yield pa.RecordBatch.from_pylist([row], pa.schema([*types, ("n_tokens", pa.int64())]))

    _make_folder(spark, folder)
    return common.settle(rows.mapInArrow(write, MANIFEST))


def _make_folder(spark: SparkSession, folder: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)


def frames(manifest: DataFrame) -> DataFrame:
    """One row per document: where its frame is, and the ids before it in all files.

    The running total is over the files' rows, one a file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first")
    files = manifest.select("path", first)
    files = files.repartition(common.partitions(manifest.sparkSession), "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from assayer.llm.token_files import read_tables

        for batch in batches:
            for row in batch.to_pylist():
                yield read_tables(row["path"], row["first"])

    return files.mapInArrow(read, FRAMES)


def read_tables(path: str, first: int) -> pa.RecordBatch:
    """The seek table and the index of a file, read from its end."""
    from pyarrow import fs

    files, name = fs.FileSystem.from_uri(path)
    with files.open_input_file(name) as source:
        end = source.size()
        count, flags, magic = struct.unpack("<IBI", source.read_at(9, end - 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError(f"no seek table at the end of {path}")
        at = end - 9 - 12 * count
        seek = np.frombuffer(source.read_at(12 * count, at), "<u4").reshape(count, 3)
        ids = np.frombuffer(source.read_at(8 * count, at - 8 - 8 * count), "<i8")
    sizes, tokens = seek[:, 0].astype(np.int64), seek[:, 1].astype(np.int64) // 4
    columns = [
        pa.array([path] * count),
        pa.array(ids, mask=ids == NO_ID),
        pa.array(first + np.cumsum(tokens) - tokens),
        pa.array(tokens),
        pa.array(np.cumsum(sizes) - sizes),
        pa.array(sizes),
        pa.array(seek[:, 2].astype(np.int64)),
    ]
    names = ["path", "doc_id", "start", "n_tokens", "offset", "size", "checksum"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def fetch(wanted: DataFrame) -> DataFrame:
    """`payload`: the content of the frames that rows of `frames` name, each checked.

    Only these frames are read and decompressed; filter or join `frames` first
    to get a few documents.
    """
    common.prepare(wanted.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard
        from pyarrow import fs

        decompressor, opened, source = zstandard.ZstdDecompressor(), None, None
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part, found = batch.slice(k, 512), []
                for row in part.select(["path", "offset", "size", "checksum"]).to_pylist():
                    if row["path"] != opened:
                        files, name = fs.FileSystem.from_uri(row["path"])
                        opened, source = row["path"], files.open_input_file(name)
                    content = decompressor.decompress(source.read_at(row["size"], row["offset"]))
                    if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != row["checksum"]:
                        raise ValueError(f"wrong checksum in {opened} at {row['offset']}")
                    found.append(content)
                columns = [part.column(c) for c in ("doc_id", "start", "n_tokens")]
                columns.append(pa.array(found, pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "start", "n_tokens", "payload"]
                )

    return wanted.mapInArrow(read, "doc_id long, start long, n_tokens long, payload binary")

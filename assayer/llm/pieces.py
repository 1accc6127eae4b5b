"""SentencePiece encoding and decoding by a table of distinct marked words.

A SentencePiece model marks each blank with U+2581 and then joins characters to
pieces. Where no piece holds a mark behind another character, no piece crosses
the front of a marked word (marks and the characters up to the next mark), and a
text's pieces are those of its marked words, one after the other. So each
distinct marked word of a batch is segmented and decoded once, by the library,
and texts are put together from that table by position. The tables belong to
batches: one table of all words joined to all positions of the corpus would
move several times the input through a shuffle.

NULL and empty texts have the end id only and decode to the empty text. Texts
with a NUL character are encoded whole. Rows, repeated ones too, are kept one to
one; extra columns are passed on, and columns named like an output are replaced
by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.llm import common
from assayer.llm.distinct import CUT, Chunks, close_each, flat, in_calls

MARK = "▁"
# Text bytes whose distinct words make one table.
TABLE_BYTES = 4 << 20

_MODELS: dict[str, Pieces] = {}


class Pieces:
    """A model whose pieces do not cross whitespace marks."""

    def __init__(self, model_path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        count = self.model.get_piece_size()
        pieces = (self.model.id_to_piece(i) for i in range(count))
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError("the model has pieces that cross whitespace marks")
        self.alone = self.model.piece_to_id(MARK)
        self.end = self.model.eos_id()

    @classmethod
    def of(cls, model_path: str) -> Pieces:
        if model_path not in _MODELS:
            _MODELS[model_path] = cls(model_path)
        return _MODELS[model_path]

    def encode(self, texts: pa.Array) -> tuple[pa.ListArray, pa.Array]:
        """Ids of each text, the end id last, and the text they decode to."""
        if pc.any(pc.match_substring(texts, CUT)).as_py():
            return self.whole(texts.to_pylist())
        full = pc.not_equal(texts, "")
        marked = pc.replace_substring(texts.filter(full), " ", MARK)
        marked = pc.binary_join_element_wise(MARK, marked, "")
        chunks = Chunks(marked, [(f"([^{MARK}]){MARK}", f"\\1{CUT}{MARK}")])
        # The library sets the first mark itself, but not before an empty text.
        words, decoded = [w[1:].replace(MARK, " ") for w in chunks.words], []

        def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            encoded = self.model.encode(words, num_threads=1)
            encoded = [e if w else [self.alone] for w, e in zip(words, encoded, strict=True)]
            decoded.extend(" " + t for t in self.model.decode(encoded, num_threads=1))
            return flat(encoded)

        if not words:
            return self.whole(texts.to_pylist())
        values, ends = chunks.ids(*in_calls(words, encode))
        # Empty texts have no chunks: back to one entry for each text.
        row = np.cumsum(full.to_numpy(zero_copy_only=False))
        values, ends = close_each(values, np.concatenate([[0], ends[row]]), self.end)
        back = pc.if_else(full, pa.array(np.maximum(row - 1, 0)), None)
        texts = pc.fill_null(pc.utf8_slice_codeunits(chunks.joined(decoded), 1).take(back), "")
        return list_array(values, ends), texts

    def whole(self, texts: list[str]) -> tuple[pa.ListArray, pa.Array]:
        encoded = self.model.encode(texts, num_threads=1)
        ids = pa.array([[*e, self.end] for e in encoded], pa.list_(pa.int32()))
        return ids, pa.array(self.model.decode(encoded, num_threads=1), pa.string())


def list_array(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.astype(np.int32)))


def encode_decode(
    docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """All rows with the ids of a text, its end id last, and the text decoded from them."""
    common.prepare(docs.sparkSession)
    extra = [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())]
    schema = common.with_columns(docs, extra)
    kept = schema.names[:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from assayer.llm.pieces import Pieces

        model = Pieces.of(model_path)
        for batch in batches:
            for part in common.slices(batch, text, TABLE_BYTES):
                found = model.encode(pc.fill_null(part.column(text), ""))
                columns = [*(part.column(c) for c in kept), *found]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, ids, decoded])

    return docs.mapInArrow(run, schema)


def digests(encoded: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """`n_tokens`, and checksums of the ids in decimal and of the decoded text."""
    written = F.array_join(F.col(ids).cast("array<string>"), " ")
    return encoded.withColumns(
        {
            "n_tokens": F.size(ids).cast("long"),
            "ids_sha256": F.sha2(written.cast("binary"), 256),
            "decoded_sha256": F.sha2(F.col(decoded).cast("binary"), 256),
        }
    ).drop(ids, decoded)

"""Alignment of the tokens of two tokenizers over the same bytes.

A text, with a blank set before it, is cut into tokens by a byte-level model (A)
and by a SentencePiece model (B). Tokens of both are intervals of bytes. They
are coalesced: all intervals are sorted by start, the running maximum of their
ends is taken, and a group breaks where a start reaches the maximum before it.
Within a group every A token is linked with every B token it overlaps.

No token of either model crosses the place between a character and a blank
behind it, so texts are cut there, and the distinct words of a block of texts
are encoded and coalesced once, all in one go; texts are put together from them
by position. A block is some texts of bounded size.

How often two ids are linked is counted over all texts: each block gives its
distinct pairs with their numbers, these are summed up, and a block gets back
the totals of its own pairs, by a join; no table of all pairs is held anywhere.

NULL and empty texts, and those whose tokens do not spell the text (with a
U+2581, say, which B takes for a blank), have no tokens: all counts are 0 and the
groups are the empty text. Rows, repeated ones too, are kept one to one and
count as often as they occur. Extra columns are passed on, and columns named
like an output are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.llm import common
from assayer.llm.distinct import CUT, flat, in_calls
from assayer.llm.pieces import MARK, Pieces
from assayer.llm.token_files import WordIds

# Text bytes of a block.
BLOCK_BYTES = 8 << 20
# What both models' white space is not, then a blank.
_BEHIND = r"([^\s\pZ\x0b\x{85}\x1c-\x1f]) "

COUNTS = ("n_a", "n_b", "n_groups", "n_links")
# Of a block: the pairs of its distinct words with their numbers; for each of
# its words, which pairs it links; and for each text, which words it holds.
BLOCK = "__block"
_OWN = ("__words", "__ends", "__links", "__pairs")
_OWN_TYPES = "binary", "binary", "binary", "array<struct<pair:bigint,n:bigint>>"

_MODELS: dict[tuple[str, str], Aligner] = {}


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the entries of a byte-level model."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def coalesce(a_size: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of two rows of tokens that cover the same bytes, given their lengths.

    The group of each A token and of each B token, numbered from 0.
    """
    ends = np.concatenate([np.cumsum(a_size), np.cumsum(b_size)])
    starts = ends - np.concatenate([a_size, b_size])
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group[: len(a_size)], group[len(a_size) :]


def overlaps(a_size: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an A token and a B token that share a byte, by A token."""
    a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
    first = np.searchsorted(b_end, a_end - a_size, "right")
    count = np.searchsorted(b_end - b_size, a_end, "left") - first
    a = np.repeat(np.arange(len(a_size)), count)
    within = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
    return a, first[a] + within


def lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


class Words:
    """Distinct words, their tokens, groups and links."""

    def __init__(self, model: Aligner, words: list[str]) -> None:
        a_count, a = in_calls(words, model.a_ids)
        b_count, b = in_calls(words, model.b_ids)
        spelled = pa.array(words).cast(pa.binary())
        good = pc.and_(
            pc.equal(pc.binary_join(lists(model.a_bytes.take(pa.array(a)), a_count), b""), spelled),
            pc.equal(pc.binary_join(lists(model.b_bytes.take(pa.array(b)), b_count), b""), spelled),
        )
        self.good = good.to_numpy(zero_copy_only=False)
        # Words that are not spelled by their tokens are left without any.
        a, b = a[np.repeat(self.good, a_count)], b[np.repeat(self.good, b_count)]
        self.a_count, self.b_count = a_count * self.good, b_count * self.good
        a_size, b_size = model.a_size[a], model.b_size[b]
        a_group, b_group = coalesce(a_size, b_size)
        groups = int(a_group[-1]) + 1 if len(a_group) else 0
        # Groups do not cross words, as all words' tokens end together.
        word = np.repeat(np.arange(len(words)), self.a_count)
        first = np.flatnonzero(np.diff(a_group, prepend=-1))
        self.group_count = np.bincount(word[first], minlength=len(words))
        written = (
            pc.binary_join(lists(pa.array(ids).cast(pa.string()), np.bincount(g, minlength=groups)), ",")
            for ids, g in ((a, a_group), (b, b_group))
        )
        groups = pc.binary_join_element_wise(*written, "|")
        self.written = pc.binary_join(lists(groups, self.group_count), ";")
        a_at, b_at = overlaps(a_size, b_size)
        self.pairs = a[a_at].astype(np.int64) * len(model.b_size) + b[b_at]
        self.link_count = np.bincount(word[a_at], minlength=len(words))


class Aligner:
    """Both models with the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = WordIds(a_path), Pieces.of(b_path)
        self.a.library.encode_special_tokens = True
        letters = byte_letters()
        entries = [self.a.library.id_to_token(i) for i in range(self.a.library.get_vocab_size())]
        own = [bytes(letters.get(c, 0) for c in e or "") for e in entries]
        self.a_bytes = pa.array(own, pa.binary())
        model = self.b.model
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        own = [
            bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.b_bytes = pa.array(own, pa.binary())
        self.a_size, self.b_size = (
            pc.binary_length(t).to_numpy().astype(np.int64) for t in (self.a_bytes, self.b_bytes)
        )

    @classmethod
    def of(cls, a_path: str, b_path: str) -> Aligner:
        if (a_path, b_path) not in _MODELS:
            _MODELS[a_path, b_path] = cls(a_path, b_path)
        return _MODELS[a_path, b_path]

    def a_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.a.words(words)

    def b_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library sets the first blank itself, but not before an empty text."""
        found = self.b.model.encode([w[1:] for w in words], num_threads=1)
        alone = [self.b.alone]
        return flat([f if len(w) > 1 else alone for w, f in zip(words, found, strict=True)])

    def block(self, texts: pa.Array) -> tuple[list[pa.Array], list]:
        """Columns of the texts of a block (groups, counts, words), and the block's own."""
        full = pc.binary_join_element_wise(" ", pc.fill_null(texts, ""), "")
        odd = pc.match_substring(full, CUT)
        cut = pc.replace_substring_regex(full, _BEHIND, f"\\1{CUT} ")
        split = pc.split_pattern(cut, CUT)
        if pc.any(odd).as_py():
            # Texts that hold the sign for cuts are one word each.
            whole = lists(full, np.ones(len(full), np.int64))
            split = pc.if_else(odd, whole, split)
        coded = split.flatten().dictionary_encode()
        at, count = coded.indices.to_numpy(), pc.list_value_length(split).to_numpy().astype(np.int64)
        words = Words(self, coded.dictionary.to_pylist())
        ends = np.concatenate([[0], np.cumsum(count)])

        def total(each: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(each[at])])[ends])

        kept = pc.greater(pc.binary_length(texts), 0).fill_null(False)
        kept = kept.to_numpy(zero_copy_only=False) & (total(~words.good) == 0)
        written = pc.binary_join(lists(words.written.take(coded.indices), count), ";")
        columns = [pc.if_else(pa.array(kept), written, "")]
        for each in (words.a_count, words.b_count, words.group_count, words.link_count):
            columns.append(pa.array(total(each.astype(np.int64)) * kept))
        content = [at[i:j].astype("<i4").tobytes() if k else b"" for i, j, k in zip(ends, ends[1:], kept, strict=False)]
        columns.append(pa.array(content, pa.binary()))
        # How often each pair is linked in the block's texts.
        often = np.bincount(at[np.repeat(kept, count)], minlength=len(words.good))
        pairs, place = np.unique(words.pairs, return_inverse=True)
        number = np.bincount(place, np.repeat(often, words.link_count), len(pairs)).astype(np.int64)
        ends = np.cumsum(words.link_count).astype("<i4").tobytes()
        own = [ends, place.astype("<i4").tobytes()]
        own.append([{"pair": p, "n": n} for p, n in zip(pairs.tolist(), number.tolist(), strict=True)])
        return columns, own


def aligned(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    text: str = "text",
    groups: str = "groups",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All rows with their groups of token ids (`a1,a2|b1;a3|b2,b3`) and their counts.

    Besides, one row for each block of texts, with all other columns NULL;
    `with_totals` takes what it needs from them and drops them.
    """
    common.prepare(docs.sparkSession)
    extra = [T.StructField(groups, T.StringType())]
    extra += [T.StructField(c, T.LongType()) for c in COUNTS]
    extra += [T.StructField(BLOCK, T.LongType())]
    own = T._parse_datatype_string(",".join(f"{n} {t}" for n, t in zip(_OWN, _OWN_TYPES, strict=True)))
    schema = common.with_columns(docs, [*extra, *own.fields])
    # A block's row has no values in the columns passed on.
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    kept = schema.names[: -len(extra) - len(_OWN)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from assayer.llm.alignment import Aligner

        model, number = Aligner.of(a_path, b_path), TaskContext.get().partitionId() << 32
        pair_type = pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())]))
        for batch in batches:
            for part in common.slices(batch, text, block_bytes):
                (written, *counts, words), own = model.block(part.column(text))
                rows, none = part.num_rows, pa.nulls
                columns = [*(part.column(c) for c in kept), written, *counts]
                columns += [pa.array([number] * rows, pa.int64()), words]
                columns += [none(rows, pa.binary()), none(rows, pa.binary()), none(rows, pair_type)]
                names = schema.names
                yield pa.RecordBatch.from_arrays(columns, names=names)
                head = [none(1, c.type) for c in columns]
                head[names.index(BLOCK)] = pa.array([number], pa.int64())
                head[-3:] = [pa.array([v], c.type) for v, c in zip(own, columns[-3:], strict=True)]
                yield pa.RecordBatch.from_arrays(head, names=names)
                number += 1

    return docs.mapInArrow(run, schema)


def pair_totals(rows: DataFrame, b_vocabulary: int) -> tuple[DataFrame, DataFrame]:
    """Of settled `aligned` rows: each block's pairs, and the totals of all pairs.

    A pair is `a * b_vocabulary + b`. Totals say, too, whether a pair is the most
    frequent of its B id.
    """
    own = rows.filter(F.col("__pairs").isNotNull())
    of_block = own.select(BLOCK, F.posexplode("__pairs").alias("at", "p")).select(
        BLOCK, "at", "p.pair", "p.n"
    )
    b = F.pmod("pair", F.lit(b_vocabulary)).alias("b")
    totals = of_block.groupBy("pair").agg(F.sum("n").alias("n"))
    totals = common.settle(totals.filter("n > 0"))
    most = totals.groupBy(b).agg(F.max("n").alias("most"))
    totals = totals.select("*", b).join(most, "b")
    return of_block.drop("n"), totals.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def with_totals(aligned_rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The rows of `aligned` with `n_best` and `count_sum` in place of its own columns.

    Columns not needed may be dropped from the rows before, as they are written
    once to the shared folder.
    """
    from assayer.llm.pieces import Pieces

    rows = common.settle(aligned_rows)
    vocabulary = Pieces.of(b_path).model.get_piece_size()
    of_block, totals = pair_totals(rows, vocabulary)
    found = of_block.join(totals, "pair").select(F.col(BLOCK).alias("block"), "at", "n", "best")
    extra = [T.StructField(name, T.LongType()) for name in ("n_best", "count_sum")]
    schema = common.with_columns(rows.drop(BLOCK, *_OWN), extra)
    kept = schema.names[:-2]

    def run(block: pa.Table, pairs: pa.Table) -> pa.Table:
        from assayer.llm.alignment import summed

        return summed(block, pairs, kept)

    return rows.groupBy(BLOCK).cogroup(found.groupBy("block")).applyInArrow(run, schema)


def summed(block: pa.Table, pairs: pa.Table, kept: list[str]) -> pa.Table:
    """The texts of one block with sums over their links."""
    own = pc.is_valid(block.column("__pairs"))
    head = block.filter(own).select(["__ends", "__links"]).to_pylist()[0]
    texts = block.filter(pc.invert(own))
    ends = np.concatenate([[0], np.frombuffer(head["__ends"], "<i4")])
    links = np.frombuffer(head["__links"], "<i4")
    places = pairs.column("at").to_numpy()
    words = texts.column("__words").to_pylist()
    at = np.frombuffer(b"".join(words), "<i4")
    text_ends = np.concatenate([[0], np.cumsum([len(w) // 4 for w in words], dtype=np.int64)])
    columns = [texts.column(c) for c in kept]
    for name in ("best", "n"):
        value = np.zeros(int(links.max(initial=-1)) + 1, np.int64)
        value[places] = pairs.column(name).to_numpy(zero_copy_only=False)
        of_word = np.diff(np.concatenate([[0], np.cumsum(value[links])])[ends])
        columns.append(pa.array(np.diff(np.concatenate([[0], np.cumsum(of_word[at])])[text_ends])))
    return pa.Table.from_arrays(columns, names=[*kept, "n_best", "count_sum"])

"""Secrets in texts: fixed patterns, and a battery of randomness tests with false-discovery control.

Fixed patterns find assignments to names like `password`, access key ids and long
hexadecimal runs. The battery looks at all other runs of 20 or more characters of
the base-64 alphabets. A run's encoding is inferred from its characters: the
smallest alphabet that holds them. It is a candidate if it has letters and
digits, and must pass three tests of randomness over its alphabet: chi-squared
for uniform use, the number of runs above and below the middle, and the serial
correlation of neighbours.

Passing is easy for short strings, so candidates are then tested against ordinary
identifiers. Their null is a chain over the classes of characters (small letters,
capitals, digits, others) with changes as in words, numbers and separators put
together, and letters as frequent as in words; it is taken over the inferred
alphabet, so that each encoding has a null of its own. A candidate's p-value is
its probability by the null over that of a uniform draw from its alphabet: by
Markov's inequality no identifier of the null has a smaller one by chance more
often than that. Within each class of length the Benjamini-Hochberg procedure
keeps the share of false discoveries below a bound.

Everything is Spark expressions over one row per document. The p-values of the
runs of all documents are counted in bins by class; the thresholds are one number
for each class.

Positions count code points, the end exclusive. Spans of one kind never overlap;
a run that overlaps a span of a fixed pattern is no candidate. NULL and empty
texts have no spans; rows, repeated ones too, are kept one to one with all their
columns, and columns named like an output are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm import common

# Patterns and least lengths (of the value, of the match, of the match).
ASSIGN = (
    "(?i:(password|passwd|secret|token|api_?key))"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "random")

RUN = "[A-Za-z0-9+/_=-]{20,}"
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
ALPHABETS = (
    ("^[0-9a-f]+$", DIGITS + "abcdef"),
    ("^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("^[A-Z2-7]+=*$", UPPER + "234567"),
    ("^[0-9a-z]+$", DIGITS + LOWER),
    ("^[0-9A-Z]+$", DIGITS + UPPER),
    ("^[0-9A-Za-z]+$", DIGITS + LOWER + UPPER),
    ("^[0-9A-Za-z+/]+=*$", UPPER + LOWER + DIGITS + "+/"),
    ("^[0-9A-Za-z_-]+=*$", UPPER + LOWER + DIGITS + "-_"),
)
# Standard deviations within which each test of the battery passes.
PASS = 3.0
# Share of false discoveries, and the bins of p-values by powers of ten.
FALSE_SHARE, BINS = 0.01, 10
# The null: how often a class of characters follows another in identifiers (small
# letters, capitals, digits, others), and letters by percent in words, of which
# `EVEN` is spread evenly, for other languages.
FOLLOWS = (
    (0.84, 0.06, 0.04, 0.06),
    (0.40, 0.50, 0.05, 0.05),
    (0.05, 0.05, 0.80, 0.10),
    (0.45, 0.20, 0.30, 0.05),
)
WORD_LETTERS = dict(zip(LOWER, (
    8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4,
    6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074,
), strict=True))
EVEN = 0.1


def _kind_of(letter: str) -> int:
    return 0 if letter in LOWER else 1 if letter in UPPER else 2 if letter in DIGITS else 3


def _null(alphabet: str) -> tuple[list[float], list[float]]:
    """Decimal logarithms of the null over an alphabet: of each of its letters
    within its class, and of each class after each other (16 numbers)."""
    kinds = [_kind_of(c) for c in alphabet]
    raw = [
        (1 - EVEN) * WORD_LETTERS[c.lower()] / 100 + EVEN / 26 if k < 2 else 1.0
        for c, k in zip(alphabet, kinds, strict=True)
    ]
    total = [sum(r for r, k in zip(raw, kinds, strict=True) if k == kind) for kind in range(4)]
    letters = [math.log10(r / total[k]) for r, k in zip(raw, kinds, strict=True)]
    follows = []
    for row in FOLLOWS:
        possible = sum(row[k] for k in set(kinds))
        follows += [math.log10(row[k] / possible) for k in range(4)]
    return letters, follows


def _spans(text: Column, pattern: str, kind: str, values: Column | None = None) -> Column:
    """Matches as (start, kind, end, value), the value's length checked by the caller.

    The text between the matches gives their positions.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    rows = F.arrays_zip(
        F.transform(between, F.length).alias("gap"),
        F.transform(matches, F.length).alias("size"),
        (matches if values is None else values).alias("value"),
    )
    order = F.lit(KINDS.index(kind))

    def step(state: Column, row: Column) -> Column:
        start = state["at"] + row["gap"]
        end = start + row["size"]
        span = F.struct(
            start.alias("start"), order.alias("kind"), end.alias("end"), row["value"].alias("value")
        )
        # The gap behind the last match has none.
        return F.when(row["size"].isNull(), state).otherwise(
            F.struct(end.alias("at"), F.array_append(state["spans"], span).alias("spans"))
        )

    none = F.expr("CAST(array() AS array<struct<start:int,kind:int,end:int,value:string>>)")
    first = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    found = F.aggregate(rows, first, step, lambda state: state["spans"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def fixed_spans(text: Column) -> Column:
    """Spans of the fixed patterns, by start and kind."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    found = [
        _spans(text, ASSIGN, "assign", values),
        # A match of a run of one class of characters takes the whole run, so
        # least lengths may stand in these patterns.
        _spans(text, ACCESS.replace("+", "{%d,}" % (LEAST["access"] - 4)), "access"),
        _spans(text, HEX.replace("+", "{%d,}" % LEAST["hex"]), "hex"),
    ]
    long = F.filter(F.concat(*found), lambda s: (s["kind"] > 0) | (F.length(s["value"]) >= LEAST["assign"]))
    return F.array_sort(F.transform(long, lambda s: F.struct(s["start"], s["kind"], s["end"])))


def _battery(value: Column) -> Column:
    """Length, evidence against the null and whether the randomness tests pass."""
    alphabet, null = F.lit(None).cast("string"), F.lit(None)
    for pattern, letters in reversed(ALPHABETS):
        fits, known = value.rlike(pattern), _null(letters)
        alphabet = F.when(fits, F.lit(letters)).otherwise(alphabet)
        null = F.when(
            fits, F.struct(F.lit(known[0]).alias("letters"), F.lit(known[1]).alias("follows"))
        ).otherwise(null)
    body = F.rtrim(value, F.lit("="))
    parts = F.struct(
        body.alias("body"), F.length(body).cast("double").alias("n"), alphabet.alias("alphabet"),
        F.split(body, "").alias("letters"), null.alias("null"),
    )
    return _let(parts, _statistics)


def _let(value: Column, use) -> Column:
    """`use` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _statistics(p: Column) -> Column:
    n, k = p["n"], F.length(p["alphabet"]).cast("double")

    def used(total: Column, letter: Column) -> Column:
        count = n - F.length(F.replace(p["body"], letter, F.lit("")))
        return total + count * count

    squares = F.aggregate(F.array_distinct(p["letters"]), F.lit(0.0), used)
    middle = (k + 1) / 2
    codes = F.transform(p["letters"], lambda c: F.instr(p["alphabet"], c).cast("double") - middle)
    every = F.lit(LOWER + UPPER + DIGITS)
    kinds = F.transform(
        p["letters"],
        lambda c: _let(F.instr(every, c), lambda i: F.when(i == 0, 3).when(i > 52, 2).when(i > 26, 1).otherwise(0)),
    )

    def evidence(c: Column) -> Column:
        """Decimal logarithm of a uniform draw's probability over the null's."""
        letters = F.aggregate(
            c, F.lit(0.0), lambda s, x: s + F.get(p["null"]["letters"], (x + middle - 1).cast("int"))
        )
        size = (n - 1).cast("int")
        changes = _let(
            kinds,
            lambda a: F.aggregate(
                F.zip_with(F.slice(a, F.lit(1), size), F.slice(a, F.lit(2), size), lambda x, y: x * 4 + y),
                F.lit(0.0),
                lambda s, x: s + F.get(p["null"]["follows"], x),
            ),
        )
        # The class of the first character is free.
        return -n * F.log10(k) - letters - changes

    def tests(c: Column) -> Column:
        size = (n - 1).cast("int")
        left, right = F.slice(c, F.lit(1), size), F.slice(c, F.lit(2), size)
        changes = F.zip_with(left, right, lambda x, y: ((x > 0) != (y > 0)).cast("double"))
        products = F.zip_with(left, right, lambda x, y: x * y)
        total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
        chi = (squares * k / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * (1 - 1 / n))
        runs = (total(changes) - (n - 1) / 2) / F.sqrt((n - 1) / 4)
        serial = total(products) / ((k * k - 1) / 12) / F.sqrt(n - 1)
        return (chi <= PASS) & (F.abs(runs) <= PASS) & (F.abs(serial) <= PASS)

    mixed = p["body"].rlike("[0-9]") & p["body"].rlike("[A-Za-z]")
    random = mixed & p["alphabet"].isNotNull()
    return F.struct(
        n.cast("int").alias("n"),
        F.when(random, _let(codes, evidence)).alias("evidence"),
        F.when(random, _let(codes, tests)).otherwise(False).alias("random"),
        random.alias("tested"),
    )


def candidates(text: Column, fixed: Column) -> Column:
    """Runs outside the fixed spans with their statistics."""
    runs = F.filter(
        _spans(text, RUN, "random"),
        lambda r: ~F.exists(fixed, lambda f: (f["start"] < r["end"]) & (r["start"] < f["end"]))
        & (F.length(F.rtrim(r["value"], F.lit("="))) >= 2),
    )
    return F.transform(
        runs,
        lambda r: F.struct(r["start"], r["kind"], r["end"], _battery(r["value"]).alias("test")),
    )


def _class(n: Column) -> Column:
    """A class of lengths: a quarter of a power of two."""
    return F.floor(F.log2(n) * 4).cast("int")


@dataclass(frozen=True)
class Limits:
    """The least bin of a discovery in each class of lengths."""

    bins: dict[int, int]

    def holds(self, test: Column) -> Column:
        if not self.bins:
            return F.lit(False)
        least = F.create_map(*[F.lit(v) for pair in self.bins.items() for v in pair])
        found = _bin(test["evidence"]) >= least[_class(test["n"])]
        return test["random"] & F.coalesce(found, F.lit(False))


def _bin(evidence: Column) -> Column:
    return F.floor(F.greatest(evidence, F.lit(0.0)) * BINS)


def limits(docs: DataFrame, text: str = "text") -> Limits:
    """Count the runs of all documents; only their statistics are kept."""
    body = common.text_of(text)
    rows = docs.select(body.alias("text"), fixed_spans(body).alias("fixed"))
    tests = rows.select(F.explode(candidates(F.col("text"), F.col("fixed"))["test"]).alias("t"))
    binned = (
        tests.filter("t.tested")
        .groupBy(_class(F.col("t.n")).alias("class"), _bin(F.col("t.evidence")).alias("bin"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    above = Window.partitionBy("class").orderBy(F.desc("bin"))
    every = Window.partitionBy("class")
    held = binned.select(
        "class", "bin", F.sum("c").over(above).alias("found"), F.sum("c").over(every).alias("all")
    ).filter(F.pow(F.lit(10.0), -F.col("bin") / BINS) <= FALSE_SHARE * F.col("found") / F.col("all"))
    # One row for each class of lengths.
    least = held.groupBy("class").agg(F.min("bin").alias("bin")).collect()
    return Limits({r["class"]: r["bin"] for r in least})


def scan(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """All rows with their spans: an array of (start, kind, end), kinds as in `KINDS`.

    Texts are read twice, for the statistics and for the spans, and never written.
    """
    found = limits(docs, text)
    body, kept = common.text_of(text), [c for c in docs.columns if c.lower() != spans.lower()]
    fixed = common.free_name(docs, "fixed")
    rows = docs.select(*kept, fixed_spans(body).alias(fixed))
    random = F.filter(candidates(body, F.col(fixed)), lambda r: found.holds(r["test"]))
    random = F.transform(random, lambda r: F.struct(r["start"], r["kind"], r["end"]))
    return rows.withColumn(spans, F.array_sort(F.concat(F.col(fixed), random))).drop(fixed)


def written(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]),
        ),
        ",",
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """A text with its spans replaced; overlapping spans are replaced together."""

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        mark_here = F.when(span["start"] >= state["at"], F.lit(mark)).otherwise("")
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.concat(state["text"], gap, mark_here).alias("text"),
        )

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    end = lambda s: F.concat(s["text"], F.substring(text, s["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, first, step, end)).otherwise(text)

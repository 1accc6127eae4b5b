"""Small constant maps as expressions."""

from __future__ import annotations

import json
from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_LITERAL_KEYS = 500


def literal_map(values: Mapping) -> Column:
    """A map literal; tuple and list values become arrays.

    Many keys are given as one text, which the optimizer parses once, so that the
    expression does not grow with them.
    """
    if len(values) > MAX_LITERAL_KEYS:
        first = next(iter(values.values()))
        single = not isinstance(first, (tuple, list))
        kind = {float: "double", str: "string", bool: "boolean", int: "bigint"}[
            type(first if single else first[0])
        ]
        text = json.dumps({str(k): v if single else list(v) for k, v in values.items()})
        return F.from_json(F.lit(text), f"map<string,{kind if single else f'array<{kind}>'}>")

    def lit(value):
        if isinstance(value, (tuple, list)):
            return F.array(*[F.lit(v) for v in value])
        return F.lit(value)

    return F.create_map(*chain.from_iterable((F.lit(k), lit(v)) for k, v in values.items()))


def weight_of(source: Column, weights: Mapping[str, float], default: float = 1.0) -> Column:
    """Weight of a source, `default` if it has none."""
    if not weights:
        return F.lit(float(default))
    found = literal_map({k: float(v) for k, v in weights.items()})[source]
    return F.coalesce(found, F.lit(float(default)))

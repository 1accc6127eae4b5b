"""The registered queries: each operator over the given tables, with SQL to check it."""

from catalog import compares, files, frames, jobs, profiles, records, scores, texts  # noqa: F401
from catalog.registry import ORACLES, QUERIES  # noqa: F401

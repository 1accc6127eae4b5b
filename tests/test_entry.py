"""The entry point in an installation without the training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = """
import __spark_entry__ as driver
from catalog import ORACLES, QUERIES
assert driver.queries() == QUERIES and driver.oracle_sql() == ORACLES
"""


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py")])
def test_core_queries_load_alone(tmp_path, left_out):
    for name in ("assayer", "catalog", "__spark_entry__.py", "corpus_pipeline.py"):
        source, target = os.path.join(ROOT, name), tmp_path / name
        if os.path.isdir(source):
            shutil.copytree(source, target, ignore=shutil.ignore_patterns("__pycache__", *left_out))
        elif name not in left_out and os.path.exists(source):
            shutil.copy(source, target)
    subprocess.run([sys.executable, "-c", PROBE], cwd=tmp_path, check=True, timeout=120)

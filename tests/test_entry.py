"""The driver contract without the training-data operators."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["xxhash", "zstandard", "uvlens.llm", "corpus_pipeline"])
def test_analytics_queries_survive_a_missing_package(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; from uvlens.plans import QUERIES, ORACLE; "
            "assert set(QUERIES) == set(e.queries()) and set(ORACLE) == set(e.oracle_sql()); print(len(e.queries()))")
    got = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert got.returncode == 0, got.stderr
    assert int(got.stdout) >= 62
